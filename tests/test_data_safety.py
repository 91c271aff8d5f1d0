"""Jobs that move data must not merge, lose or duplicate any: versions on one
target, half-written copies, empty tables, failed lookups, entities asked for
again, whole keys, and verification that tells different data apart."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from keepsake.config import Config
from keepsake.operators import restore as RS
from keepsake.operators import retention as R
from keepsake.plans import jobs as J
from keepsake.plans import restore as PR
from keepsake.plans.retention import retention_plan
from keepsake.schemas import BACKUPS, TABLES
from keepsake.sources import copy as CP
from keepsake.sources.catalog import warehouse_catalog
from tests.helpers import backup, backups_df, tables_df

AS_OF = dt.datetime(2024, 1, 30)
ITEM = ("id long, source_table struct<project_id:string,dataset_id:string,table_id:string,partition_id:string>, "
        "target_table struct<project_id:string,dataset_id:string,table_id:string,partition_id:string>, "
        "create_disposition string, write_disposition string")


def _versions(spark, wh, *sizes):
    for i, n in enumerate(sizes):
        spark.range(n).write.parquet(wh.path("backup", "bk", f"v{i}"))


def _items(spark, write, parts, create="CREATE_IF_NEEDED"):
    rows = [(i, ("backup", "bk", f"v{i}", p), ("r", "d", "t", p), create, write) for i, p in enumerate(parts)]
    return spark.createDataFrame(rows, ITEM)


@pytest.mark.parametrize("write, rows, reasons", [("WRITE_EMPTY", 5, [None, "duplicate"]), ("WRITE_TRUNCATE", 7, [None, None]),
                                                  ("WRITE_APPEND", 12, [None, None])])
@pytest.mark.parametrize("part", [None, "20240101"])
def test_two_versions_on_one_target(spark, scratch, write, rows, reasons, part):
    wh = CP.Warehouse(scratch)
    _versions(spark, wh, 5, 7)
    got = CP.restore_copy(spark, _items(spark, write, [part, part]), wh).orderBy("item_id").collect()
    assert [r["error_reason"] for r in got] == reasons
    assert spark.read.parquet(wh.path("r", "d", "t")).count() == rows


def test_a_bad_item_does_not_fail_its_neighbours(spark, scratch):
    wh = CP.Warehouse(scratch)
    _versions(spark, wh, 5, 7, 9)
    spark.range(4).select(F.col("id").cast("string").alias("other")).write.parquet(wh.path("backup", "bk", "v3"))
    CP._FS(spark).delete(wh.path("backup", "bk", "v1"))
    got = CP.restore_copy(spark, _items(spark, "WRITE_TRUNCATE", ["20240101", "20240102", "20240103", "20240104"]), wh)
    reasons = {r["item_id"]: r["error_reason"] for r in got.collect()}
    assert reasons == {0: None, 1: "notFound", 2: None, 3: None}
    sizes = {d: spark.read.parquet(f"{wh.path('r', 'd', 't')}/{CP.PARTITION_COLUMN}={d}").count() for d in ("20240101", "20240103", "20240104")}
    assert sizes == {"20240101": 5, "20240103": 9, "20240104": 4}


def _request(i=0, partition=None, table="src"):
    return dict(project_id="p", dataset_id="d", table_id=table, partition_id=partition, target_dataset_id="bk",
                target_table_id=f"copy{i}")


@pytest.mark.parametrize("partitions", [[None], ["20240101"], ["20240101", "20240102"]])
def test_half_written_copy_is_replaced(spark, scratch, partitions):
    wh = CP.Warehouse(scratch)
    data = spark.range(20).withColumn(CP.PARTITION_COLUMN, F.when(F.col("id") < 8, "20240101").otherwise("20240102"))
    data.write.partitionBy(CP.PARTITION_COLUMN).parquet(wh.path("p", "d", "src"))
    plan = [_request(i, p) for i, p in enumerate(partitions)]
    for r in plan:
        dst = wh.path("backup", "bk", r["target_table_id"])
        spark.range(2).write.parquet(dst)
        CP._FS(spark).delete(dst + "/_SUCCESS")
    expected = {None: 20, "20240101": 8, "20240102": 12}
    got = CP.snapshot_copy(spark, plan, wh, "backup").collect()
    assert {r["source_partition_id"]: (r["error_reason"], r["num_rows"]) for r in got} == {p: (None, expected[p]) for p in partitions}
    for r in plan:
        assert spark.read.parquet(wh.path("backup", "bk", r["target_table_id"])).count() == expected[r["partition_id"]]
    again = CP.snapshot_copy(spark, plan, wh, "backup").collect()
    assert {r["error_reason"] for r in again} == {"duplicate"}


def test_whole_error_text_is_kept(spark, scratch, monkeypatch):
    def broken(*_):
        raise RuntimeError("x" * 5000)
    monkeypatch.setattr(CP, "read_table", broken)
    got = CP.snapshot_copy(spark, [_request()], CP.Warehouse(scratch), "backup").first()
    assert len(got["error_message"]) == 5000


def test_empty_table_exists(spark, scratch):
    wh = CP.Warehouse(scratch)
    spark.range(0).write.parquet(wh.path("p", "d", "empty"))
    live, _ = warehouse_catalog(spark, wh, [("p", "d", "empty"), ("p", "d", "gone")])
    rows = {r["table_id"]: r for r in live.collect()}
    assert rows["empty"]["table_exists"] and rows["empty"]["is_empty"] and rows["empty"]["num_rows"] == 0
    assert not rows["gone"]["table_exists"] and rows["gone"]["lookup_status"] == "not_found"
    old = AS_OF - dt.timedelta(days=235)
    tables = tables_df(spark, [(1, "p", "d", "empty", None, old), (2, "p", "d", "gone", None, old)])
    copies = backups_df(spark, [backup(1, old), backup(2, old)])
    kept = {r["parent_id"] for r in R.grace_filter(copies, tables, live, AS_OF, 7).collect()}
    assert kept == {1}


def test_failed_lookup_keeps_every_copy(spark):
    seen = AS_OF - dt.timedelta(days=230)
    old = [AS_OF - dt.timedelta(days=d) for d in (240, 250, 260, 270)]
    tables = tables_df(spark, [(1, "p", "d", "t", None, seen), (2, "p", "d", "u", None, seen)])
    copies = backups_df(spark, [backup(p, c) for p in (1, 2) for c in old] + [backup(1, old[0] - dt.timedelta(minutes=5))])
    live = spark.createDataFrame([("p", "d", "t", "error", False, False), ("p", "d", "u", "found", True, False)],
                                 "project_id string, dataset_id string, table_id string, lookup_status string, "
                                 "table_exists boolean, has_time_partitioning boolean")
    plan = retention_plan(tables, copies, live, Config(as_of=AS_OF)).collect()
    assert [r["reason"] for r in plan if r["parent_id"] == 1] == ["lookup_failed"] * 5
    assert all(r["retained"] for r in plan if r["parent_id"] == 1)
    assert sorted(r["reason"] for r in plan if r["parent_id"] == 2) == ["kept"] + ["old_not_newest"] * 3


def test_on_demand_copy_of_a_known_table(spark, scratch):
    wh = CP.Warehouse(scratch)
    spark.range(3).write.parquet(wh.path("p", "d", "t"))
    live, _ = warehouse_catalog(spark, wh, [("p", "d", "t")])
    tables = spark.createDataFrame([(77, "p", "d", "t", None, AS_OF - dt.timedelta(days=3))], TABLES)
    req = spark.createDataFrame([("p", "d", "t", None)], "project_id string, dataset_id string, table_id string, partition_id string")
    out = J.on_demand_run(spark, live, req, tables, spark.createDataFrame([], BACKUPS), Config(as_of=AS_OF), wh)
    assert [(r["id"], r["last_checked"]) for r in out.tables.collect()] == [(77, AS_OF)]
    assert [r["parent_id"] for r in out.new_backups.collect()] == [77]


def test_rerun_records_copies_of_a_lost_run(spark, scratch):
    wh = CP.Warehouse(scratch)
    spark.range(3).write.parquet(wh.path("p", "d", "t"))
    live, parts = warehouse_catalog(spark, wh, [("p", "d", "t")])
    none = spark.createDataFrame([], TABLES), spark.createDataFrame([], BACKUPS)
    J.backup_run(spark, live, parts, *none, Config(as_of=AS_OF), wh)  # its metadata is never written
    again = J.backup_run(spark, live, parts, *none, Config(as_of=AS_OF), wh)
    assert again.new_backups.count() == 1 and again.new_backups.first()["num_bytes"] > 0


def test_backup_key_needs_its_parent(spark):
    tables = tables_df(spark, [(1, "p", "d", "t", None, AS_OF), (2, "p", "d", "u", None, AS_OF)])
    copies = backups_df(spark, [backup(1, AS_OF, "a", id=5), backup(2, AS_OF, "b", id=5)])
    key = F.base64(F.encode(F.format_string('"Table", %d, "Backup", 5', F.col("id")), "UTF-8"))
    req = spark.createDataFrame([(1,), (2,), (999,)], "id long").select(
        F.lit(0).alias("list_id"), F.col("id").alias("request_id"), key.alias("backupBqKey"), F.lit(None).cast("string").alias("backupUrlSafeKey"))
    got = {r["request_id"]: r for r in RS.resolve_backup_keys(RS.parse_list_requests(req), copies, tables).collect()}
    assert (got[1]["backup_table_id"], got[2]["backup_table_id"]) == ("a", "b") and len(got) == 3
    assert got[999]["backup_table_id"] is None and "doesn't exist" in got[999]["error"]
    assert RS.duplicate_requests(RS.parse_list_requests(req)).count() == 0


def test_list_restore_decodes_each_key_once(spark):
    tables = tables_df(spark, [(1, "p", "d", "t", None, AS_OF)])
    copies = backups_df(spark, [backup(1, AS_OF, "a", id=5), backup(1, AS_OF, "b", id=6)])
    key = F.base64(F.encode(F.concat(F.lit('"Table", 1, "Backup", '), F.col("copy").cast("string")), "UTF-8"))
    rows = [(0, 1, 5), (0, 2, 5), (0, 3, None), (0, 4, None), (1, 5, 6), (1, 6, None), (1, 7, None), (None, 8, 6), (None, 9, 6), (2, 10, 7)]
    req = spark.createDataFrame(rows, "list_id long, request_id long, copy long").select(
        "list_id", "request_id", key.alias("backupBqKey"), F.lit(None).cast("string").alias("backupUrlSafeKey"))
    parsed = RS.parse_list_requests(req)
    for df in (parsed, RS.duplicate_requests(parsed)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("unbase64") == 1
    assert sorted(map(tuple, RS.duplicate_requests(parsed).collect()), key=str) == [(0, 1, 5, 2), (None, 1, 6, 2)]
    got = {r["request_id"]: r for r in PR.list_restore_plan(req, copies, tables, "backup").collect()}
    assert len(got) == len(rows)
    assert "Duplicated backup item: 5" in got[1]["error"] and "Duplicated backup item: 5" in got[2]["error"]
    assert "missing" in got[3]["error"] and "missing" in got[6]["error"] and "doesn't exist" in got[10]["error"]
    assert [got[i]["source_table"]["table_id"] for i in (5, 8, 9)] == ["b"] * 3 and got[5]["error"] is None


def test_verification_tells_nulls_and_names_apart(spark):
    a = spark.createDataFrame([(1, None), (None, 2)], "a int, b int")
    b = spark.createDataFrame([(None, 1), (2, None)], "a int, b int")
    assert not CP.verify_copy(a, b).first()["equal"]
    assert not CP.verify_copy(a, a.toDF("x", "y")).first()["equal"]
    assert not CP.verify_copy(a, a.withColumn("b", F.col("b").cast("long"))).first()["equal"]
    m = a.select(F.create_map(F.lit("k"), "a", F.lit("j"), "b").alias("m"), F.array("a", "b").alias("l"))
    n = a.select(F.create_map(F.lit("j"), "b", F.lit("k"), "a").alias("m"), F.array("a", "b").alias("l"))
    assert CP.verify_copy(m, n).first()["equal"] and CP.verify_copy(a, a.orderBy("b")).first()["equal"]


def test_the_driver_draws_work_as_it_is_done(spark):
    """At most twice the parallelism is taken ahead of what has finished."""
    drawn, done, worst, lock = 0, 0, 0, threading.Lock()

    def source():
        nonlocal drawn
        for i in range(300):
            drawn += 1
            yield i

    def work(i):
        nonlocal done, worst
        with lock:
            worst = max(worst, drawn - done)
            done += 1
        return [(i, "deleted")]

    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("outcome", T.StringType())])
    out = CP._run_paged(spark, work, source(), 3, schema)
    assert out.count() == 300 and worst <= 7


def test_no_local_checkpoint_folder_on_a_cluster():
    from keepsake.session import checkpoint_root

    class Conf:
        def get(self, _, default=None):
            return default

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        checkpoint_root(Session())
