"""Metadata tables: only touched buckets are rewritten, a driver that stops leaves a readable state."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepsake.sources import commit
from keepsake.sources import metadata as M

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("parent_id", T.LongType()), T.StructField("note", T.StringType())])


def _frame(spark, n, note="a"):
    return spark.range(n).select("id", (F.col("id") % 40).alias("parent_id"), F.lit(note).alias("note"))


def _rows(spark, path):
    return sorted(map(tuple, M.read_metadata(spark, path, SCHEMA).collect()))


def _stamps(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_only_touched_buckets_are_written(spark, scratch):
    path = f"{scratch}/meta/backups"
    assert _rows(spark, path) == []
    M.write_metadata(spark, _frame(spark, 400), path)
    first = _stamps(path)
    old = M.read_metadata(spark, path, SCHEMA)
    # the new state derives from the old one: one table's records change, one table is new, one loses a record
    changed = old.filter("id <> 5").withColumn("note", F.when(F.col("parent_id") == 7, "b").otherwise(F.col("note")))
    want = changed.unionByName(spark.createDataFrame([(1000, 77, None)], SCHEMA))
    rows = sorted(map(tuple, want.collect()), key=lambda r: r[0])
    M.write_metadata(spark, want, path)
    assert sorted(_rows(spark, path), key=lambda r: r[0]) == rows
    second = _stamps(path)
    kept = [f for f in first if second.get(f) == first[f]]
    assert len(kept) >= len(first) - 3 and len(set(second) - set(first)) <= 3
    M.write_metadata(spark, M.read_metadata(spark, path, SCHEMA), path)  # nothing changed, nothing is written
    assert _stamps(path) == second
    M.write_metadata(spark, M.read_metadata(spark, path, SCHEMA).limit(0), path)
    assert _rows(spark, path) == [] and _stamps(path) == {}
    M.write_metadata(spark, _frame(spark, 3), path)
    assert len(_rows(spark, path)) == 3


def test_plain_files_become_buckets(spark, scratch):
    path = f"{scratch}/meta/backups"
    _frame(spark, 50).write.parquet(path)
    M.write_metadata(spark, M.read_metadata(spark, path, SCHEMA).filter("id < 20"), path)
    assert [r[0] for r in _rows(spark, path)] == list(range(20))
    assert all(f"{M.BUCKET}=" in f for f in _stamps(path))


class Stopped(BaseException):
    pass


@pytest.mark.parametrize("plain", [True, False])
def test_a_driver_that_stops_leaves_the_old_or_the_new_state(spark, scratch, monkeypatch, plain):
    left, seen = [-1], set()

    def stopping(name):
        real = getattr(commit.FileSystem, name)

        def step(self, *a):
            if left[0] == 0:
                raise Stopped(name)
            left[0] -= 1
            return real(self, *a)
        monkeypatch.setattr(commit.FileSystem, name, step)

    for name in ("rename", "write", "touch"):
        stopping(name)
    k = 0
    while True:
        path = f"{scratch}/stop{k}/backups"
        left[0] = -1
        if plain:
            _frame(spark, 9).coalesce(1).write.parquet(path)
        else:
            M.write_metadata(spark, _frame(spark, 9), path, 2)
        old = _rows(spark, path)
        new = M.read_metadata(spark, path, SCHEMA).withColumn("note", F.lit("b"))
        want = [(i, p, "b") for i, p, _ in old]
        left[0] = k
        try:
            M.write_metadata(spark, new, path, 2)
        except Stopped:
            left[0] = -1
            got = _rows(spark, path)
            assert got in (old, want), k
            seen.add(got == want)
            M.write_metadata(spark, M.read_metadata(spark, path, SCHEMA).withColumn("note", F.lit("b")), path, 2)
            assert _rows(spark, path) == want
            k += 1
        else:
            break
    assert seen == {True, False} and k >= 5
