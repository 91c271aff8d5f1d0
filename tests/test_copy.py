"""End-to-end data movement on real test tables: backup run (Q4), copy
verification (Q19), restore run with dispositions (Q9, S13), deleting
copies (S14 → M4).  restore(backup(t)) = t."""

import datetime as dt

from pyspark.sql import functions as F

from keepsake.config import Config
from keepsake.operators import retention as R
from keepsake.plans import jobs as J
from keepsake.schemas import BACKUPS, TABLES
from keepsake.sources import copy as CP
from keepsake.sources.catalog import warehouse_catalog

SF = "/root/testdata/sf0.001"
AS_OF = dt.datetime(2024, 1, 30)


def _setup(spark, root):
    wh = CP.Warehouse(root)
    orders = spark.read.parquet(f"{SF}/orders.parquet").withColumn(
        CP.PARTITION_COLUMN, F.date_format(F.date_trunc("year", "o_orderdate"), "yyyyMMdd"))
    orders.write.partitionBy(CP.PARTITION_COLUMN).parquet(wh.path("p1", "d1", "orders"))
    spark.read.parquet(f"{SF}/customer.parquet").write.parquet(wh.path("p1", "d1", "customer"))
    return wh


def test_backup_verify_restore_delete(spark, scratch):
    wh = _setup(spark, scratch)
    live, parts = warehouse_catalog(spark, wh, [("p1", "d1", "orders"), ("p1", "d1", "customer"),
                                                ("p1", "d1", "missing")])
    assert parts.count() == 7
    tables = spark.createDataFrame([], TABLES)
    backups = spark.createDataFrame([], BACKUPS)
    cfg = Config(as_of=AS_OF)
    out = J.backup_run(spark, live, parts, tables, backups, cfg, wh)
    assert out.plan.filter("needs_backup").count() == 8
    assert out.results.filter(F.col("error_reason").isNull()).count() == 8
    assert out.new_backups.count() == 8
    assert out.tables.count() == 8
    assert {r["result_class"] for r in out.classes.collect()} == {"done"}

    # Q19: each copy equals its source partition
    for r in out.results.collect():
        src = CP.read_table(spark, wh.path("p1", "d1", r["source_table_id"]), r["source_partition_id"])
        cp = spark.read.parquet(wh.path(cfg.backup_project, r["target_dataset_id"], r["target_table_id"]))
        assert CP.verify_copy(src, cp).first()["equal"]

    # a rerun sees everything up to date: no copies, no duplicates
    again = J.backup_run(spark, live, parts, out.tables, out.new_backups, cfg, wh)
    assert again.plan.filter("needs_backup").count() == 0

    # restore every copy into project r (CREATE_IF_NEEDED + WRITE_EMPTY), then once more with
    # WRITE_EMPTY (fails: not empty) and WRITE_TRUNCATE (replaces only the partition)
    t = out.tables.select(F.col("id").alias("parent_id"), "project_id", "dataset_id", "table_id", "partition_id")
    items = out.new_backups.select("id", "dataset_id", "table_id", "parent_id").join(t, "parent_id").select(
        "id", F.lit("job1").alias("job_id"), F.lit("In Progress").alias("status"),
        F.lit(None).cast("string").alias("status_message"), F.lit(None).cast("timestamp_ntz").alias("completed"),
        F.struct(F.lit(cfg.backup_project).alias("project_id"), out.new_backups.dataset_id.alias("dataset_id"),
                 out.new_backups.table_id.alias("table_id"), t.partition_id.alias("partition_id")).alias("source_table"),
        F.struct(F.lit("r").alias("project_id"), t.dataset_id.alias("dataset_id"), t.table_id.alias("table_id"),
                 t.partition_id.alias("partition_id")).alias("target_table"),
        F.lit(None).cast("string").alias("custom_parameters")).cache()
    jobs = spark.createDataFrame([], "id string, created timestamp_ntz, items_count long, "
                                     "create_disposition string, write_disposition string")
    new_job = spark.createDataFrame([("job1", AS_OF, 0, "CREATE_IF_NEEDED", "WRITE_EMPTY")], jobs.schema)
    empty = spark.createDataFrame([], "project_id string, dataset_id string, location string")
    src_ds = spark.createDataFrame([], "dataset_id string, location string")
    rr = J.restore_run(spark, jobs, new_job, items, empty, live, src_ds, wh)
    assert rr.job.first()["items_count"] == 8
    assert {r["status"] for r in rr.items.collect()} == {"Done"}
    for name, by in (("orders", [CP.PARTITION_COLUMN]), ("customer", [])):
        v = CP.verify_copy(spark.read.parquet(wh.path("p1", "d1", name)),
                           spark.read.parquet(wh.path("r", "d1", name)), by)
        assert all(r["equal"] for r in v.collect())

    # a known job id restores nothing
    rr2 = J.restore_run(spark, new_job, new_job, items, empty, live, src_ds, wh)
    assert rr2.job.count() == 0

    # WRITE_EMPTY into non-empty targets fails per item; WRITE_TRUNCATE succeeds and keeps data equal
    again_items = items.withColumn("job_id", F.lit("job2"))
    j2 = spark.createDataFrame([("job2", AS_OF, 0, "CREATE_NEVER", "WRITE_EMPTY")], jobs.schema)
    rr3 = J.restore_run(spark, new_job, j2, again_items, empty, live, src_ds, wh)
    assert {r["status"] for r in rr3.items.collect()} == {"Failed"}
    j3 = spark.createDataFrame([("job3", AS_OF, 0, "CREATE_NEVER", "WRITE_TRUNCATE")], jobs.schema)
    rr4 = J.restore_run(spark, new_job, j3, items.withColumn("job_id", F.lit("job3")), empty, live, src_ds, wh)
    assert {r["status"] for r in rr4.items.collect()} == {"Done"}
    v = CP.verify_copy(spark.read.parquet(wh.path("p1", "d1", "orders")),
                       spark.read.parquet(wh.path("r", "d1", "orders")), [CP.PARTITION_COLUMN])
    assert all(r["equal"] for r in v.collect())

    # S14 → M4: drop three copies, one already missing
    doomed = out.new_backups.orderBy("id").limit(3).select("id", "dataset_id", "table_id").collect()
    CP._FS(spark).delete(wh.path(cfg.backup_project, doomed[0]["dataset_id"], doomed[0]["table_id"]))
    outcomes = CP.delete_copies(spark, doomed, wh, cfg.backup_project)
    got = sorted(r["outcome"] for r in outcomes.collect())
    assert got == ["deleted", "deleted", "not_found"]
    marked = R.mark_deleted(out.new_backups, outcomes, AS_OF)
    assert marked.filter(F.col("deleted").isNotNull()).count() == 3


def test_export_round_trip_verifies(spark):
    """Every table's backup records against their round trip through the export (S4 shape → S3)."""
    from keepsake.sources import export as X
    from keepsake.sources.testviews import TestViews
    v = TestViews.of(spark, SF)
    src = v.backups.select("id", "parent_id", "created", "deleted", "last_modified", "num_bytes", "table_id", "dataset_id")
    out = X.to_export(v.backups, "Backup")
    back = X.last_backup(out).join(
        out.select(F.col("__key__.id").alias("id"), F.base64(F.encode(F.col("__key__.path"), "UTF-8")).alias("key")),
        "key").select("id", "parent_id", "created", "deleted", "last_modified", F.col("numBytes").alias("num_bytes"),
                      "table_id", "dataset_id")
    got = CP.verify_copy(src, back, ["parent_id"])
    assert got.count() > 0 and got.filter(~F.col("equal")).count() == 0


def test_verification_finds_differing_copies(spark):
    from keepsake.registry import queries
    out = queries()["q19_verify_copy"](spark, SF)
    assert out.filter("equal").count() > 0 and out.filter(~F.col("equal")).count() > 0


def test_load_export_overwrites_one_day(spark, scratch):
    from keepsake.sources import export as X
    from keepsake.sources.testviews import TestViews
    v = TestViews(spark, SF)
    X.load_export(X.to_export(v.backups.limit(5), "Backup"), "Backup", dt.date(2024, 1, 29), scratch)
    X.load_export(X.to_export(v.backups, "Backup"), "Backup", dt.date(2024, 1, 30), scratch)
    X.load_export(X.to_export(v.backups, "Backup"), "Backup", dt.date(2024, 1, 30), scratch)  # rerun replaces
    df = X.read_export(spark, scratch, "Backup")
    assert df.filter(F.col("export_date") == "20240129").count() == 5
    newest = X.latest_export(df)
    assert newest.count() == v.backups.count()
    assert X.latest_shard(spark, scratch, "Backup") == "20240130"
    assert X.read_latest_export(spark, scratch, "Backup").count() == v.backups.count()
    plan = newest._jdf.queryExecution().executedPlan().toString()
    pf = [line for line in plan.split("\n") if "PartitionFilters" in line][0]
    assert "20240130" in pf.split("PartitionFilters:")[1]  # older shards are pruned, never read


def test_sli_history_sink_and_current_views(spark, scratch):
    from keepsake.checks.q_sli import _latency_run
    from keepsake.operators import sli as S
    from keepsake.sources import sli_sink as K
    from keepsake.sources.testviews import TestViews
    v = TestViews(spark, SF)
    path = scratch + "/latency"
    for t in (AS_OF, AS_OF + dt.timedelta(hours=6)):
        K.append_sli(_latency_run(spark, v, t), path, t)
    hist = spark.read.parquet(path)
    markers = hist.filter(F.col("projectId") == "SNAPSHOT_MARKER").count()
    assert markers == 6  # one per run and x
    cur = S.newest_latency_snapshot(hist, AS_OF)
    assert cur.filter(F.col("snapshotTime") != F.lit(AS_OF + dt.timedelta(hours=6))).count() == 0
    assert S.last_snapshot_time(hist, AS_OF).first()["snapshotTime"] == AS_OF + dt.timedelta(hours=6)


def test_retention_apply_and_on_demand(spark, scratch):
    wh = _setup(spark, scratch)
    refs = [("p1", "d1", "orders"), ("p1", "d1", "customer")]
    live, parts = warehouse_catalog(spark, wh, refs)
    cfg = Config(as_of=AS_OF)
    out = J.backup_run(spark, live, parts, spark.createDataFrame([], TABLES), spark.createDataFrame([], BACKUPS),
                       cfg, wh)
    # an extra, older copy of customer taken the same day: W8 keeps only the newest
    cust = out.new_backups.join(out.tables.filter(F.col("table_id") == "customer")
                                .select(F.col("id").alias("parent_id")), "parent_id").first()
    spark.read.parquet(wh.path(cfg.backup_project, cust["dataset_id"], cust["table_id"])) \
        .write.parquet(wh.path(cfg.backup_project, cust["dataset_id"], "older_copy"))
    older = cust["created"] - dt.timedelta(microseconds=1)  # same day, earlier (copies record wall-clock times)
    extra = spark.createDataFrame([(1, cust["parent_id"], older, older, cust["dataset_id"], "older_copy",
                                    cust["num_bytes"], None)], BACKUPS)
    backups = out.new_backups.unionByName(extra)
    res = J.retention_apply(spark, out.tables, backups, live, cfg, wh)
    assert [(r["id"], r["outcome"]) for r in res.outcomes.collect()] == [(1, "deleted")]
    assert res.backups.filter(F.col("deleted").isNotNull()).select("id").first()["id"] == 1
    assert not CP._FS(spark).exists(wh.path(cfg.backup_project, cust["dataset_id"], "older_copy"))

    # Q5: on-demand copies ignore freshness; a day-partitioned table needs a partition
    req = spark.createDataFrame([("p1", "d1", "orders", "19950101"), ("p1", "d1", "orders", None),
                                 ("p1", "d1", "missing", None)],
                                "project_id string, dataset_id string, table_id string, partition_id string")
    cfg2 = Config(as_of=AS_OF + dt.timedelta(hours=3))
    od = J.on_demand_run(spark, live, req, out.tables, res.backups, cfg2, wh)
    actions = {(r["table_id"], r["partition_id"]): (r["action"], r["error"]) for r in od.plan.collect()}
    assert actions[("orders", "19950101")] == ("backup", None)
    assert actions[("orders", None)][0] == "reject"
    assert actions[("missing", None)][1].startswith("NotFound")
    assert od.new_backups.count() == 1


def test_restore_creates_partition_target_for_create_never(spark, scratch):
    wh = _setup(spark, scratch)
    live, parts = warehouse_catalog(spark, wh, [("p1", "d1", "orders")])
    cfg = Config(as_of=AS_OF)
    out = J.backup_run(spark, live, parts, spark.createDataFrame([], TABLES), spark.createDataFrame([], BACKUPS),
                       cfg, wh)
    b = out.new_backups.orderBy("table_id").first()
    t = out.tables.filter(F.col("id") == b["parent_id"]).first()
    items = spark.createDataFrame(
        [(7, "jobN", "In Progress", None, None, (cfg.backup_project, b["dataset_id"], b["table_id"], t["partition_id"]),
          ("fresh", "ds", "orders", t["partition_id"]), None)],
        "id long, job_id string, status string, status_message string, completed timestamp_ntz, "
        "source_table struct<project_id:string,dataset_id:string,table_id:string,partition_id:string>, "
        "target_table struct<project_id:string,dataset_id:string,table_id:string,partition_id:string>, "
        "custom_parameters string")
    jobs = spark.createDataFrame([], "id string, created timestamp_ntz, items_count long, "
                                     "create_disposition string, write_disposition string")
    new_job = spark.createDataFrame([("jobN", AS_OF, 0, "CREATE_NEVER", "WRITE_EMPTY")], jobs.schema)
    rr = J.restore_run(spark, jobs, new_job, items, spark.createDataFrame([], "project_id string, dataset_id string, location string"),
                       live, spark.createDataFrame([], "dataset_id string, location string"), wh)
    assert rr.targets.filter(F.col("action") == "create_table").count() == 1
    assert [r["status"] for r in rr.items.collect()] == ["Done"]
    src = CP.read_table(spark, wh.path("p1", "d1", "orders"), t["partition_id"])
    assert CP.verify_copy(src, spark.read.parquet(wh.path("fresh", "ds", "orders"))).first()["equal"]


def test_incremental_backup_copies_only_changed_partition(spark, scratch):
    import time
    wh = _setup(spark, scratch)
    refs = [("p1", "d1", "orders"), ("p1", "d1", "customer")]
    live, parts = warehouse_catalog(spark, wh, refs)
    cfg = Config(as_of=AS_OF)
    first = J.backup_run(spark, live, parts, spark.createDataFrame([], TABLES), spark.createDataFrame([], BACKUPS),
                         cfg, wh)
    assert first.new_backups.count() == 8
    time.sleep(1.1)  # file times have second resolution on some stores
    extra = (spark.read.parquet(f"{SF}/orders.parquet").limit(3)
             .withColumn(CP.PARTITION_COLUMN, F.lit("19950101")))
    extra.write.mode("append").partitionBy(CP.PARTITION_COLUMN).parquet(wh.path("p1", "d1", "orders"))
    live2, parts2 = warehouse_catalog(spark, wh, refs)
    cfg2 = Config(as_of=AS_OF + dt.timedelta(hours=1))
    second = J.backup_run(spark, live2, parts2, first.tables, first.new_backups, cfg2, wh)
    changed = [(r["table_id"], r["partition_id"]) for r in second.plan.filter("needs_backup").collect()]
    assert changed == [("orders", "19950101")]
    r = second.results.first()
    src = CP.read_table(spark, wh.path("p1", "d1", "orders"), "19950101")
    cp = spark.read.parquet(wh.path(cfg.backup_project, r["target_dataset_id"], r["target_table_id"]))
    assert CP.verify_copy(src, cp).first()["equal"]


def test_dataset_restore_plan_skips_invalid_requests(spark):
    from keepsake.checks.q_restore import backup_datasets, dataset_requests, existing_datasets
    from keepsake.plans import restore as PR
    from keepsake.sources.testviews import BACKUP_PROJECT, TestViews
    v = TestViews.of(spark, "/root/testdata/sf0.01")
    plan = PR.dataset_restore_plan(dataset_requests(v), v.tables, v.backups, existing_datasets(v),
                                   backup_datasets(v), AS_OF, BACKUP_PROJECT)
    bad = {r["request_id"] for r in plan.checks.filter(F.col("error").isNotNull()).collect()}
    got = {r["request_id"] for r in plan.items.select("request_id").distinct().collect()}
    assert bad and not (bad & got) and got


def test_sli_current_from_written_history(spark, scratch):
    from keepsake.checks.q_sli import _latency_run, _quality_run
    from keepsake.plans.sli import sli_current
    from keepsake.sources import sli_sink as K
    from keepsake.sources.testviews import TestViews
    v = TestViews.of(spark, SF)
    for t in (AS_OF, AS_OF + dt.timedelta(hours=6)):
        K.append_sli(_latency_run(spark, v, t), scratch + "/lat", t)
        K.append_sli(_quality_run(spark, v, t), scratch + "/qual", t)
    cur = sli_current(spark.read.parquet(scratch + "/lat"), spark.read.parquet(scratch + "/qual"), AS_OF)
    assert cur["latency_last_snapshot"].first()["snapshotTime"] == AS_OF + dt.timedelta(hours=6)
    assert cur["quality"].filter(F.col("projectId") == "SNAPSHOT_MARKER").count() == 0
    counts = {r["xDays"]: r["count"] for r in cur["latency_by_count"].collect()}
    assert sum(counts.values()) == cur["latency"].count()


def test_retention_apply_writes_back_in_place(spark, scratch):
    from keepsake.sources.testviews import TestViews, default_config
    v = TestViews.of(spark, SF)
    cfg = default_config()
    tables_path, backups_path = scratch + "/meta/tables", scratch + "/meta/backups"
    v.tables.write.parquet(tables_path)
    v.backups.write.parquet(backups_path)
    backups = spark.read.parquet(backups_path)
    res = J.retention_apply(spark, spark.read.parquet(tables_path), backups, v.live, cfg, CP.Warehouse(scratch + "/wh"))
    doomed = res.plan.filter(~F.col("retained")).count()
    assert doomed > 0 and {r["outcome"] for r in res.outcomes.collect()} == {"not_found"}
    J.write_metadata(spark, res.backups, backups_path)  # overwrite the table the job read
    after = spark.read.parquet(backups_path)
    assert after.count() == v.backups.count()
    newly = after.filter(F.col("deleted") == F.lit(cfg.as_of).cast("timestamp_ntz")).count()
    assert newly == doomed


def test_cli_daily_jobs(spark, scratch):
    from keepsake import cli
    from keepsake.sources.testviews import TestViews
    wh = _setup(spark, scratch + "/wh")
    meta = scratch + "/meta"
    assert cli.main(["backup", "--meta", meta, "--warehouse", scratch + "/wh", "--as-of", "2024-01-30T00:00:00"]) == 0
    assert spark.read.parquet(meta + "/backups").count() == 8
    assert spark.read.parquet(meta + "/tables").count() == 8
    # a second run the next day: nothing changed, nothing copied; retention keeps every copy
    assert cli.main(["backup", "--meta", meta, "--warehouse", scratch + "/wh", "--as-of", "2024-01-31T00:00:00"]) == 0
    assert spark.read.parquet(meta + "/backups").count() == 8
    assert cli.main(["retention", "--meta", meta, "--warehouse", scratch + "/wh",
                     "--as-of", "2024-01-31T00:00:00"]) == 0
    assert spark.read.parquet(meta + "/backups").filter(F.col("deleted").isNotNull()).count() == 0
    # SLI runs over a census stored partitioned by snapshot day
    v = TestViews.of(spark, SF)
    census = scratch + "/census"
    v.census_tables.write.partitionBy("snapshot_date").parquet(census + "/census_tables")
    v.census_partitions.write.partitionBy("snapshot_date").parquet(census + "/census_partitions")
    v.census_copies.write.parquet(census + "/census_copies")
    assert cli.main(["sli", "--meta", meta, "--warehouse", scratch + "/wh", "--census", census,
                     "--history", scratch + "/hist", "--as-of", "2024-01-30T00:00:00"]) == 0
    lat = spark.read.parquet(scratch + "/hist/latency")
    assert lat.filter(F.col("projectId") == "SNAPSHOT_MARKER").count() == 3
    # restore status report
    v.restoration_jobs.write.parquet(meta + "/restoration_jobs")
    v.restore_items.write.parquet(meta + "/restore_items")
    assert cli.main(["status", "--meta", meta, "--out", scratch + "/status", "--warnings-only"]) == 0
    assert spark.read.parquet(scratch + "/status/items").filter(F.col("status") == "Done").count() == 0


def test_cli_restore_dataset(spark, scratch):
    from keepsake import cli
    _setup(spark, scratch + "/wh")
    meta = scratch + "/meta"
    args = ["--meta", meta, "--warehouse", scratch + "/wh", "--as-of", "2024-01-30T00:00:00"]
    assert cli.main(["backup"] + args) == 0
    assert cli.main(["restore-dataset"] + args + ["--project", "p1", "--dataset", "d1", "--target-project", "rp",
                                                  "--target-dataset", "rd", "--job-id", "job-1"]) == 0
    items = spark.read.parquet(meta + "/restore_items")
    assert items.count() == 8 and {r["status"] for r in items.collect()} == {"Done"}
    jobs = spark.read.parquet(meta + "/restoration_jobs")
    assert [(r["id"], r["items_count"]) for r in jobs.collect()] == [("job-1", 8)]
    v = CP.verify_copy(spark.read.parquet(scratch + "/wh/p1/d1/orders"), spark.read.parquet(scratch + "/wh/rp/rd/orders"),
                       [CP.PARTITION_COLUMN])
    assert all(r["equal"] for r in v.collect())
    # the same job id again restores nothing; an unknown dataset is rejected by validation
    assert cli.main(["restore-dataset"] + args + ["--project", "p1", "--dataset", "d1", "--target-project", "rp",
                                                  "--job-id", "job-1"]) == 0
    assert spark.read.parquet(meta + "/restore_items").count() == 8
    assert cli.main(["restore-dataset"] + args + ["--project", "p1", "--dataset", "nope", "--target-project", "rp",
                                                  "--job-id", "job-2"]) == 2


def test_cli_export_and_find(spark, scratch):
    from keepsake import cli
    _setup(spark, scratch + "/wh")
    meta, ex = scratch + "/meta", scratch + "/export"
    args = ["--meta", meta, "--warehouse", scratch + "/wh", "--as-of", "2024-01-30T00:00:00"]
    assert cli.main(["backup"] + args) == 0
    assert cli.main(["export", "--meta", meta, "--export-root", ex, "--as-of", "2024-01-29T06:00:00"]) == 0
    assert cli.main(["export", "--meta", meta, "--export-root", ex, "--as-of", "2024-01-30T06:00:00"]) == 0
    assert cli.main(["find-backups", "--meta", meta, "--export-root", ex, "--project", "p1", "--dataset", "d1",
                     "--table", "orders", "--out", scratch + "/found"]) == 0
    found = spark.read.parquet(scratch + "/found")
    assert found.count() == 7 and {r["source_table_id"] for r in found.collect()} == {"orders"}


def test_cli_on_demand_and_table_and_list_restores(spark, scratch):
    import base64
    import json
    from keepsake import cli
    _setup(spark, scratch + "/wh")
    meta = scratch + "/meta"
    args = ["--meta", meta, "--warehouse", scratch + "/wh", "--as-of", "2024-01-30T00:00:00"]
    # on demand: a day-partitioned table needs a partition; with one it is copied regardless of freshness
    assert cli.main(["backup-table"] + args + ["--project", "p1", "--dataset", "d1", "--table", "orders"]) == 2
    assert cli.main(["backup-table"] + args + ["--project", "p1", "--dataset", "d1", "--table", "orders",
                                               "--partition", "19950101"]) == 0
    assert cli.main(["backup-table"] + args + ["--project", "p1", "--dataset", "d1", "--table", "customer"]) == 0
    b = spark.read.parquet(meta + "/backups")
    assert b.count() == 2
    # table restore as of a day, then a list restore of the other copy by its key
    assert cli.main(["restore-table"] + args + ["--project", "p1", "--dataset", "d1", "--table", "customer",
                                                "--date", "2099-01-01", "--target-project", "r1",
                                                "--job-id", "t-1"]) == 0
    cust = spark.read.parquet(scratch + "/wh/r1/d1/customer")
    assert CP.verify_copy(spark.read.parquet(scratch + "/wh/p1/d1/customer"), cust).first()["equal"]
    assert cli.main(["restore-table"] + args + ["--project", "p1", "--dataset", "d1", "--table", "customer",
                                                "--date", "2000-01-01", "--job-id", "t-2"]) == 2
    row = b.filter(F.col("table_id").contains("orders")).first()
    key = base64.b64encode(f'"Table", {row["parent_id"]}, "Backup", {row["id"]}'.encode()).decode()
    with open(scratch + "/req.jsonl", "w") as f:
        f.write(json.dumps({"backupBqKey": key}) + "\n")
    assert cli.main(["restore-list"] + args + ["--requests", scratch + "/req.jsonl", "--target-project", "r2",
                                               "--job-id", "l-1"]) == 0
    src = CP.read_table(spark, scratch + "/wh/p1/d1/orders", "19950101")
    got = CP.read_table(spark, scratch + "/wh/r2/d1/orders", "19950101")
    assert CP.verify_copy(src, got).first()["equal"]


def test_transient_copy_failures_are_retried(spark, scratch, monkeypatch):
    wh = _setup(spark, scratch)
    live, parts = warehouse_catalog(spark, wh, [("p1", "d1", "customer")])
    real = CP.read_table
    calls = {"n": 0}

    def flaky(spark_, path, partition_id=None):
        calls["n"] += 1
        if calls["n"] <= 2:
            raise RuntimeError("backend hiccup")
        return real(spark_, path, partition_id)

    monkeypatch.setattr(CP, "read_table", flaky)
    out = J.backup_run(spark, live, parts, spark.createDataFrame([], TABLES), spark.createDataFrame([], BACKUPS),
                       Config(as_of=AS_OF), wh)
    r = out.results.collect()
    assert len(r) == 1 and r[0]["error_reason"] is None and r[0]["retry_count"] == 2
    assert out.new_backups.count() == 1
    assert {c["result_class"] for c in out.classes.collect()} == {"done"}
