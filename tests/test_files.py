"""Listings, footers and deletions inside tasks."""

import os

from pyspark.sql import functions as F

from keepsake.sources import catalog as C
from keepsake.sources import commit
from keepsake.sources import copy as CP
from keepsake.sources import files

REF = ["project_id", "dataset_id", "table_id"]


def _warehouse(spark, root):
    wh = CP.Warehouse(root)
    spark.range(10, numPartitions=3).write.parquet(wh.path("p", "d", "flat"))
    days = spark.range(12).withColumn(CP.PARTITION_COLUMN, F.concat(F.lit("2024010"), (F.col("id") % 3).cast("string")))
    days.write.partitionBy(CP.PARTITION_COLUMN).parquet(wh.path("p", "d", "days"))
    spark.range(0).write.parquet(wh.path("p", "d2", "empty"))
    os.makedirs(wh.path("q", "d", "bare"))
    os.makedirs(wh.path("q", "d", "_staging_1"))
    os.makedirs(f"{root}/_restores/job-1/p.d.t")
    open(f"{root}/p/d/note.txt", "w").close()
    return wh


def test_catalog_without_the_driver(spark, scratch, monkeypatch):
    wh = _warehouse(spark, scratch)

    def no(*_):
        raise AssertionError("the driver lists a folder")
    for name in ("exists", "folder", "names", "files", "data_files", "size"):
        monkeypatch.setattr(commit.FileSystem, name, no)
    refs = C.warehouse_tables(spark, wh)
    assert sorted(tuple(r) for r in refs.collect()) == [("p", "d", "days"), ("p", "d", "flat"), ("p", "d2", "empty"), ("q", "d", "bare")]
    assert sorted(r["table_id"] for r in C.warehouse_tables(spark, wh, ["p"]).collect()) == ["bare"]
    live, parts = C.warehouse_catalog(spark, wh, refs.unionByName(spark.createDataFrame([("p", "d", "none"), ("p", "d", "flat")], refs.schema)))
    got = {r["table_id"]: (r["lookup_status"], r["table_exists"], r["num_rows"], r["is_empty"], r["is_daily_partitioned"]) for r in live.collect()}
    assert got == {"flat": ("found", True, 10, False, False), "days": ("found", True, 12, False, True), "empty": ("found", True, 0, True, False),
                   "bare": ("found", True, 0, True, False), "none": ("not_found", False, None, None, False)}
    assert live.count() == 5
    assert sorted((r["table_id"], r["partition_id"], r["num_rows"]) for r in parts.collect()) == [("days", f"2024010{i}", 4) for i in range(3)]
    sizes = {r["table_id"]: r["num_bytes"] for r in live.collect()}
    on_disk = sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(wh.path("p", "d", "days")) for f in fs if f.endswith(".parquet"))
    assert sizes["days"] == on_disk and sizes["bare"] == 0
    # modification times as Spark's own file metadata has them
    by_spark = spark.read.parquet(wh.path("p", "d", "flat")).select(F.max(F.col("_metadata.file_modification_time").cast("timestamp_ntz"))).first()[0]
    assert live.filter("table_id = 'flat'").first()["last_modified_time"] == by_spark
    # nothing that is read is a table's data: the plan scans written listings only
    assert scratch not in live._jdf.queryExecution().toString()


def test_footers_are_read_and_rows_are_not(spark, scratch):
    wh = _warehouse(spark, scratch)
    at = spark.createDataFrame([(1, wh.path("p", "d", "days"))], "n int, path string")
    found = files.footers(files.files_below(at))
    assert "FileScan" not in found._jdf.queryExecution().toString()
    assert [tuple(r) for r in found.groupBy("n").agg(F.sum("num_rows")).collect()] == [(1, 12)]
    assert files.files_below(at.limit(0)).count() == 0


def test_deletions_in_tasks(spark, scratch, monkeypatch):
    wh = CP.Warehouse(scratch)
    for i in range(40):
        folder = wh.path("backup", f"b{i % 3}", f"c{i}")
        os.makedirs(folder)
        open(f"{folder}/part-0.parquet", "w").close()

    def no(*_):
        raise AssertionError("the driver touches a folder")
    for name in ("exists", "delete"):
        monkeypatch.setattr(commit.FileSystem, name, no)
    rows = [(i, f"b{i % 3}", f"c{i}") for i in range(30)] + [(100, "b0", "gone"), (101, None, "c1"), (102, "b0", ""), (103, "b0", None)]
    todo = spark.createDataFrame(rows, "id long, dataset_id string, table_id string")
    out = CP.delete_copies(spark, todo, wh, "backup")
    want = {i: "deleted" for i in range(30)} | {100: "not_found", 101: "error", 102: "error", 103: "error"}
    assert {r["id"]: r["outcome"] for r in out.collect()} == want
    assert {r["id"]: r["outcome"] for r in out.collect()} == want  # read again, removed once
    left = sorted(int(t[1:]) for d in ("b0", "b1", "b2") for t in os.listdir(f"{scratch}/backup/{d}"))
    assert left == list(range(30, 40))
    again = CP.delete_copies(spark, todo, wh, "backup")
    assert {r["outcome"] for r in again.filter("id < 100").collect()} == {"not_found"}
    assert CP.delete_copies(spark, todo.limit(0), wh, "backup").count() == 0


def test_a_folder_that_cannot_be_read_is_an_error(spark, scratch, monkeypatch):
    at = spark.createDataFrame([("nowhere://x/y",)], "path string")
    assert [r["status"] for r in files.children(at).collect()] == [files.ERROR]
    assert [r["outcome"] for r in files.remove(at).collect()] == [files.ERROR]
