"""Entities and records stored by table: same rows as the plain frames, no exchange of records."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from keepsake.config import Config
from keepsake.operators import catalog as C
from keepsake.plans.retention import retention_plan, stored_retention_plan
from keepsake.sources import bucketed as B
from keepsake.sources.commit import FileSystem
from tests.helpers import backup, backups_df, live_df, tables_df
from tools.plan_report import physical_plan

D = dt.datetime
AS_OF = D(2024, 1, 30)


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def frames(spark):
    """Forty tables, table 1 with a third of all records; duplicates, gone sources, failed lookups, records without a table."""
    tables = [(i, "p", "d", f"t{i}", None, D(2024, 1, 20) if i % 3 else D(2023, 6, 20)) for i in range(1, 41)]
    recs = []
    for i in range(2, 41):
        recs += [backup(i, AS_OF - dt.timedelta(days=9 * k, hours=k), id=1000 * i + k, deleted=AS_OF if k % 7 == 5 else None) for k in range(30)]
    recs += [backup(1, AS_OF - dt.timedelta(hours=3 * k), id=10 ** 6 + k) for k in range(580)]
    recs += [backup(5, D(2023, 12, 24), table_id="twice", id=1), backup(5, D(2023, 12, 25), table_id="twice", id=2)]
    recs += [backup(99, D(2023, 12, 25), id=3)]
    live = live_df(spark, [("p", "d", f"t{i}", i % 2 == 0, False) for i in range(1, 41) if i % 5])
    live = live.withColumn("lookup_status", F.when(F.col("table_id").isin("t9", "t33"), "error").otherwise(F.col("lookup_status")))
    return tables_df(spark, tables), backups_df(spark, recs), live


def test_same_rows(spark, scratch, frames):
    tables, backups, live = frames
    B.write_parts(spark, tables, backups, f"{scratch}/store", buckets=8)
    parts = B.read_parts(spark, f"{scratch}/store")
    even, hot = parts
    assert [r[0] for r in hot.tables.select("id").collect()] == [1] and hot.backups.count() == 580
    assert rows_of(even.backups.unionByName(hot.backups)) == rows_of(backups)
    assert rows_of(even.tables.unionByName(hot.tables)) == rows_of(tables)
    assert rows_of(B.over_parts(parts, C.last_backup)) == rows_of(C.last_backup(tables, backups))
    refs = tables.filter("id % 2 = 1").select("project_id", "dataset_id", "table_id")
    found = B.over_parts(parts, lambda t, b: C.backups_of_tables(t, b, refs))
    assert rows_of(found.select(*backups.columns)) == rows_of(C.backups_of_tables(tables, backups, refs).select(*backups.columns))
    cfg = Config(as_of=AS_OF)
    want = retention_plan(tables, backups, live, cfg)
    assert {r[0] for r in want.select("reason").distinct().collect()} >= {
        "kept", "duplicate_table_id", "not_newest_of_day", "young_over_limit", "old_not_newest", "source_gone", "lookup_failed"}
    assert rows_of(stored_retention_plan(parts, live, cfg)) == rows_of(want)
    assert rows_of(stored_retention_plan(B.stored_parts(spark, tables, backups, 1), live, cfg)) == rows_of(want)


def test_records_are_not_exchanged(spark, scratch, frames):
    tables, backups, live = frames
    B.write_parts(spark, tables, backups, f"{scratch}/store", buckets=8)
    even = B.read_parts(spark, f"{scratch}/store")[0]
    refs = tables.select("project_id", "dataset_id", "table_id")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = {"q1": physical_plan(stored_retention_plan([even], live, Config(as_of=AS_OF))),
                 "j12": physical_plan(C.backups_of_tables(even.tables, even.backups, refs)), "w7": physical_plan(C.last_backup(even.tables, even.backups)),
                 "plain": physical_plan(C.last_backup(tables, backups))}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    records = r"FileScan parquet [^\n]*\[[^\n]*parent_id"
    for name in ("q1", "j12", "w7"):
        assert len(re.findall(records, plans[name])) == 1, plans[name]  # read once
        at = next(i for i, line in enumerate(plans[name].split("\n")) if re.search(records, line))
        assert "Bucketed: true" in plans[name].split("\n")[at]
        assert not above(plans[name].split("\n"), at, "Exchange"), plans[name]
    assert "Exchange hashpartitioning(parent_id" in plans["plain"]


def above(lines, at, word):
    """Operators between the line `at` of a plan and its root that are `word`."""
    depth = lambda x: re.search(r"\w", re.sub(r"\*\(\d+\)", lambda m: " " * len(m.group()), x)).start()
    found, here = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if line.strip() and re.search(r"\w", line) and depth(line) < here:
            here = depth(line)
            found += [line] if re.search(rf"- (\*\(\d+\) )?{word}\b", line) else []
    return found


def test_versions(spark, scratch, frames):
    """A write that stops before its manifest changes nothing; a later one replaces all rows; another catalog finds them."""
    tables, backups, _ = frames
    path, fs = f"{scratch}/store", FileSystem(spark)
    with pytest.raises(FileNotFoundError):
        B.read_parts(spark, path)
    B.write_parts(spark, tables, backups, path, buckets=4)
    few = backups.filter("parent_id < 10")
    stop = FileSystem.rename
    FileSystem.rename = lambda *a: False
    try:
        with pytest.raises(OSError):
            B.write_parts(spark, tables, few, path, buckets=4)
    finally:
        FileSystem.rename = stop
    count = lambda: sum(p.backups.count() for p in B.read_parts(spark, path))
    assert count() == backups.count()
    old = B.read_parts(spark, path)
    B.write_parts(spark, tables, few, path, buckets=4)
    assert count() == few.count() and sum(p.backups.count() for p in old) == backups.count()
    B.write_parts(spark, tables.limit(0), backups.limit(0), path, buckets=4)
    assert count() == 0 and rows_of(B.over_parts(B.read_parts(spark, path), C.last_backup)) == []
    assert [n for n in fs.names(path) if n.endswith(".json")] == ["1.json", "2.json"]
    fresh = spark.newSession()
    fresh.conf.set("spark.sql.session.timeZone", "UTC")
    for t in spark.catalog.listTables():
        if t.name.startswith("keepsake_"):
            spark.sql(f"DROP TABLE {t.name}")
    assert sum(p.tables.count() for p in B.read_parts(fresh, path)) == 0
