"""The as-of merge against a plain search, with a hot table and many request times."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from keepsake.operators.asof import newest_before

T0 = dt.datetime(2024, 1, 1)


def _at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


@pytest.mark.parametrize("partitions", [1, 7, 23])
def test_merge_equals_a_plain_search(spark, partitions):
    rng = random.Random(6)
    key = lambda: rng.choice((1, 1, 1, 2, 3, 4, 5))  # noqa: E731 - one key has most rows
    rows = [(key(), rng.randrange(200), i, f"c{i}") for i in range(400)] + [(None, 5, 900, "x"), (1, None, 901, "y"), (6, 10, 902, "z")]
    times = {(key(), rng.randrange(-20, 230)) for _ in range(300)} | {(None, 50), (2, None), (6, 9), (6, 10), (8, 100)}
    # one table is asked for late only, so that what it finds is carried over many partitions
    rows += [(7, 1, 1000, "early")]
    times |= {(7, m) for m in range(150, 200)}
    right = spark.createDataFrame([(k, _at(m), i, n) for k, m, i, n in rows], "k long, created timestamp_ntz, id long, name string")
    left = spark.createDataFrame([(k, _at(m)) for k, m in times], "k long, asked timestamp_ntz")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r["k"], r["asked"]): (r["_row"]["created"], r["_row"]["id"], r["_row"]["name"])
               for r in newest_before(left, right, "k", "asked", "created").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = {}
    for k, m in times:
        found = [(_at(t), i, n) for kk, t, i, n in rows if k is not None and m is not None and kk == k and t is not None and t <= m]
        if found:
            want[k, _at(m)] = max(found)
    assert got == want and len(want) > 200


def test_no_row_is_paired_with_more_than_one(spark):
    left = spark.createDataFrame([(1, _at(i)) for i in range(300)], "k long, asked timestamp_ntz")
    right = spark.createDataFrame([(1, _at(2 * i), i) for i in range(300)], "k long, created timestamp_ntz, id long")
    out = newest_before(left, right, "k", "asked", "created")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert out.count() == 300 and out.agg(F.max("_row.id")).first()[0] == 149


def test_empty_sides(spark):
    left = spark.createDataFrame([(1, _at(3))], "k long, asked timestamp_ntz")
    right = spark.createDataFrame([(1, _at(1), 5)], "k long, created timestamp_ntz, id long")
    assert newest_before(left, right, "k", "asked", "created").count() == 1
    assert newest_before(left.limit(0), right, "k", "asked", "created").count() == 0
    assert newest_before(left, right.limit(0), "k", "asked", "created").count() == 0
