"""Command line for the scheduled jobs (daily backup, retention, SLI runs)
and the restore status report, over parquet metadata tables and a file
warehouse.

    python -m keepsake.cli backup    --meta M --warehouse W --as-of 2024-01-30T00:00:00
    python -m keepsake.cli retention --meta M --warehouse W --as-of ...
    python -m keepsake.cli sli       --meta M --warehouse W --census C --history H --as-of ...
    python -m keepsake.cli status    --meta M --out O [--warnings-only]
    python -m keepsake.cli restore-dataset --meta M --warehouse W --project P --dataset D \
        --target-project TP [--target-dataset TD] [--max-partition-days N] --job-id J
    python -m keepsake.cli backup-table  --meta M --warehouse W --project P --dataset D --table T [--partition X]
    python -m keepsake.cli restore-table --meta M --warehouse W --project P --dataset D --table T [--partition X] \
        [--date YYYY-MM-DD] [--target-project TP] [--target-dataset TD] --job-id J
    python -m keepsake.cli restore-list  --meta M --warehouse W --requests R.jsonl [--target-project TP] --job-id J
    python -m keepsake.cli export       --meta M --export-root E --as-of ...
    python -m keepsake.cli find-backups --meta M --export-root E --project P --dataset D [--table T] --out O

`M` holds the metadata tables `tables/` and `backups/` (and `restoration_jobs/`,
`restore_items/` for status); `C` holds `census_tables/`, `census_partitions/`
(partitioned by `snapshot_date`) and `census_copies/`.  Project filters come
from `--custom-projects` / `--skip-projects`.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from keepsake.config import Config
from keepsake.schemas import BACKUPS, TABLES


def _args(argv):
    p = argparse.ArgumentParser(prog="keepsake")
    p.add_argument("job", choices=["backup", "retention", "sli", "status", "restore-dataset", "export",
                                   "find-backups", "backup-table", "restore-table", "restore-list"])
    p.add_argument("--partition")
    p.add_argument("--date", help="restore as of this day (YYYY-MM-DD, end of day)")
    p.add_argument("--requests", help="JSON lines: backupBqKey / backupUrlSafeKey per line")
    p.add_argument("--export-root")
    p.add_argument("--table")
    p.add_argument("--meta", required=True)
    p.add_argument("--warehouse")
    p.add_argument("--census")
    p.add_argument("--history")
    p.add_argument("--out")
    p.add_argument("--as-of", default=None, help="ISO timestamp (default: now, UTC)")
    p.add_argument("--backup-project", default="backup")
    p.add_argument("--restoration-project", default="restoration")
    p.add_argument("--custom-projects", default="")
    p.add_argument("--skip-projects", default="")
    p.add_argument("--warnings-only", action="store_true")
    p.add_argument("--parallelism", type=int, default=8)
    p.add_argument("--project")
    p.add_argument("--dataset")
    p.add_argument("--target-project")
    p.add_argument("--target-dataset")
    p.add_argument("--max-partition-days", type=int)
    p.add_argument("--job-id")
    p.add_argument("--create-disposition", default="CREATE_IF_NEEDED")
    p.add_argument("--write-disposition", default="WRITE_EMPTY")
    a = p.parse_args(argv)
    needs = {"status": ("out",), "export": ("export_root",), "find-backups": ("export_root", "out"),
             "sli": ("warehouse", "census", "history"), "restore-list": ("warehouse", "requests")}
    missing = [n for n in needs.get(a.job, ("warehouse",)) if getattr(a, n) is None]
    if missing:
        p.error(f"{a.job} needs " + ", ".join("--" + n.replace("_", "-") for n in missing))
    return a


def _item_id(job_id):
    """Of a restore item: the same job, place and copy always give the same id."""
    from pyspark.sql import functions as F
    t, s = "target_table.", "source_table."
    part = F.coalesce(F.col(t + "partition_id"), F.lit(""))
    return F.abs(F.xxhash64(job_id, F.col(t + "project_id"), F.col(t + "dataset_id"), F.col(t + "table_id"), part,
                            F.col(s + "dataset_id"), F.col(s + "table_id")))


def _read_or_empty(spark, path, schema):
    from keepsake.sources.metadata import read_metadata
    return read_metadata(spark, path, schema)


def _run_restore(spark, a, cfg, planned, tables, meta) -> int:
    """Q9 for a planned restore (items with source/target or an error)."""
    from pyspark.sql import functions as F

    from keepsake.plans import jobs as J
    from keepsake.schemas import RESTORATION_JOBS, RESTORE_ITEMS
    from keepsake.sources import copy as CP
    from keepsake.sources.catalog import warehouse_catalog, warehouse_tables
    err = planned.filter("error IS NOT NULL").select("error").first()
    if err is not None:
        print(f"rejected: {err['error']}")
        return 2
    wh = CP.Warehouse(a.warehouse)
    live, _ = warehouse_catalog(spark, wh, warehouse_tables(spark, wh))
    datasets = live.filter("table_exists").groupBy("project_id", "dataset_id").agg(F.min("location").alias("location"))
    bk = live.filter(live.project_id == cfg.backup_project).select("dataset_id", "location").distinct()
    items = planned.select(_item_id(F.lit(a.job_id)).alias("id"), F.lit(a.job_id).alias("job_id"), "status",
                           F.lit(None).cast("string").alias("status_message"),
                           F.lit(None).cast("timestamp_ntz").alias("completed"), "source_table", "target_table",
                           (F.col("custom_parameters") if "custom_parameters" in planned.columns
                            else F.lit(None).cast("string")).alias("custom_parameters"))
    jobs = _read_or_empty(spark, f"{meta}/restoration_jobs", RESTORATION_JOBS)
    new_job = spark.createDataFrame([(a.job_id, cfg.as_of, 0, a.create_disposition, a.write_disposition)],
                                    RESTORATION_JOBS)
    run = J.restore_run(spark, jobs, new_job, items, datasets, live, bk, wh, a.parallelism)
    _record_restore(spark, run, jobs, meta)
    return 0


def _record_restore(spark, run, jobs, meta: str) -> None:
    """Items first: a job is known (and restores nothing again) only once its items are written."""
    from keepsake.plans import jobs as J
    from keepsake.schemas import RESTORATION_JOBS, RESTORE_ITEMS
    old = _read_or_empty(spark, f"{meta}/restore_items", RESTORE_ITEMS)
    items = run.items.select(*RESTORE_ITEMS.fieldNames())
    # items of a run that stopped before its job was written are written again, not twice
    kept = old.join(items.select("id", "job_id"), ["id", "job_id"], "left_anti").select(*RESTORE_ITEMS.fieldNames())
    J.write_metadata(spark, kept.unionByName(items), f"{meta}/restore_items")
    J.write_metadata(spark, jobs.unionByName(run.job.select(*RESTORATION_JOBS.fieldNames())), f"{meta}/restoration_jobs")
    print(f"restore items: {run.items.count()}")


def main(argv=None) -> int:
    a = _args(sys.argv[1:] if argv is None else argv)
    from keepsake.plans import jobs as J
    from keepsake.session import get_session
    from keepsake.sources import copy as CP

    spark = get_session()
    as_of = (dt.datetime.fromisoformat(a.as_of) if a.as_of
             else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    split = lambda s: tuple(x for x in s.split(",") if x)
    cfg = Config(as_of=as_of, backup_project=a.backup_project, restoration_project=a.restoration_project,
                 custom_projects=split(a.custom_projects),
                 projects_to_skip=split(a.skip_projects) + (a.backup_project,))
    meta = a.meta.rstrip("/")
    tables = _read_or_empty(spark, f"{meta}/tables", TABLES)
    backups = _read_or_empty(spark, f"{meta}/backups", BACKUPS)

    if a.job in ("backup", "retention"):
        from keepsake.sources.catalog import warehouse_catalog, warehouse_tables
        wh = CP.Warehouse(a.warehouse)
        live, parts = warehouse_catalog(spark, wh, warehouse_tables(spark, wh, cfg.projects_to_skip))
        if a.job == "backup":
            out = J.backup_run(spark, live, parts, tables, backups, cfg, wh, a.parallelism)
            J.write_metadata(spark, out.tables, f"{meta}/tables")
            J.write_metadata(spark, backups.unionByName(out.new_backups), f"{meta}/backups")
            print(f"copies: {out.results.count()}, recorded: {out.new_backups.count()}")
        else:
            res = J.retention_apply(spark, tables, backups, live, cfg, wh, a.parallelism)
            J.write_metadata(spark, res.backups, f"{meta}/backups")
            gone = res.outcomes.filter(res.outcomes.outcome != "error").count()
            print(f"deleted: {gone}")
    elif a.job == "sli":
        from keepsake.plans import sli as PS
        from keepsake.sources import sli_sink as K
        census = a.census.rstrip("/")
        ct, cp = spark.read.parquet(f"{census}/census_tables"), spark.read.parquet(f"{census}/census_partitions")
        copies = spark.read.parquet(f"{census}/census_copies")
        la = PS.last_available_backups(tables, backups)
        from keepsake.sources.catalog import warehouse_catalog, warehouse_tables
        wh = CP.Warehouse(a.warehouse)
        live, parts = warehouse_catalog(spark, wh, warehouse_tables(spark, wh))
        lc = live.filter(live.project_id == cfg.backup_project).filter("table_exists")\
            .select("dataset_id", "table_id", "num_bytes")
        K.append_sli(PS.latency_run(spark, ct, cp, la, live, parts, as_of, cfg), f"{a.history}/latency", as_of)
        K.append_sli(PS.quality_run(spark, ct, cp, la, copies, live, parts, lc, as_of, cfg),
                     f"{a.history}/quality", as_of)
        print("sli appended")
    elif a.job == "restore-dataset":
        from pyspark.sql import functions as F

        from keepsake.operators import restore as RS
        from keepsake.plans import restore as PR
        from keepsake.schemas import RESTORATION_JOBS, RESTORE_ITEMS
        from keepsake.sources.catalog import warehouse_catalog, warehouse_tables
        wh = CP.Warehouse(a.warehouse)
        refs = warehouse_tables(spark, wh)
        live, _ = warehouse_catalog(spark, wh, refs)
        datasets = live.filter("table_exists").groupBy("project_id", "dataset_id").agg(F.min("location").alias("location"))
        bk = live.filter(live.project_id == cfg.backup_project).select("dataset_id", "location").distinct()
        req = spark.createDataFrame([(a.job_id, a.project, a.dataset, a.target_project, a.target_dataset,
                                      a.max_partition_days)],
                                    "request_id string, project_id string, dataset_id string, target_project_id "
                                    "string, target_dataset_id string, max_partition_days int")
        plan = PR.dataset_restore_plan(req, tables, backups, datasets, bk, as_of, cfg.backup_project)
        err = plan.checks.filter("error IS NOT NULL").select("error").first()
        if err is not None:
            print(f"rejected: {err['error']}")
            return 2
        items = plan.items.select(_item_id(F.col("request_id")).alias("id"), F.col("request_id").alias("job_id"),
                                  "status", F.lit(None).cast("string").alias("status_message"),
                                  F.lit(None).cast("timestamp_ntz").alias("completed"), "source_table",
                                  "target_table", F.lit(None).cast("string").alias("custom_parameters"))
        jobs = _read_or_empty(spark, f"{meta}/restoration_jobs", RESTORATION_JOBS)
        new_job = spark.createDataFrame([(a.job_id, as_of, 0, a.create_disposition, a.write_disposition)],
                                        RESTORATION_JOBS)
        run = J.restore_run(spark, jobs, new_job, items, datasets, live, bk, wh, a.parallelism)
        _record_restore(spark, run, jobs, meta)
    elif a.job == "backup-table":
        from keepsake.sources.catalog import warehouse_catalog
        wh = CP.Warehouse(a.warehouse)
        live, _ = warehouse_catalog(spark, wh, [(a.project, a.dataset, a.table)])
        req = spark.createDataFrame([(a.project, a.dataset, a.table, a.partition)],
                                    "project_id string, dataset_id string, table_id string, partition_id string")
        out = J.on_demand_run(spark, live, req, tables, backups, cfg, wh)
        err = out.plan.filter("error IS NOT NULL").select("error").first()
        if err is not None:
            print(f"rejected: {err['error']}")
            return 2
        J.write_metadata(spark, out.tables, f"{meta}/tables")
        J.write_metadata(spark, backups.unionByName(out.new_backups), f"{meta}/backups")
        print(f"recorded: {out.new_backups.count()}")
    elif a.job in ("restore-table", "restore-list"):
        from keepsake.plans import restore as PR
        if a.job == "restore-table":
            req = spark.createDataFrame([(0, a.project, a.dataset, a.table, a.partition, a.date)],
                                        "request_id long, project_id string, dataset_id string, table_id string, "
                                        "partition_id string, date_text string")
            planned = PR.table_restore_plan(req, tables, backups, as_of, cfg.backup_project, a.target_project,
                                            a.target_dataset)
        else:
            from pyspark.sql import functions as F
            raw = spark.read.json(a.requests)  # every field of a request stays with its item
            for c in ("backupBqKey", "backupUrlSafeKey"):
                raw = raw if c in raw.columns else raw.withColumn(c, F.lit(None).cast("string"))
            req = raw.select(F.lit(0).alias("list_id"), F.monotonically_increasing_id().alias("request_id"), "*")
            planned = PR.list_restore_plan(req, backups, tables, cfg.backup_project, a.target_project,
                                           a.target_dataset)
        return _run_restore(spark, a, cfg, planned, tables, meta)
    elif a.job == "export":
        from keepsake.sources import export as X
        for kind, df in (("Table", tables), ("Backup", backups)):
            X.load_export(X.to_export(df, kind), kind, as_of.date(), a.export_root)
        print(f"exported {as_of:%Y%m%d}")
    elif a.job == "find-backups":
        from pyspark.sql import functions as F

        from keepsake.operators import catalog as C
        from keepsake.sources import export as X
        shard_t = X.read_latest_export(spark, a.export_root, "Table")
        shard_b = X.read_latest_export(spark, a.export_root, "Backup")
        refs = X.last_table(shard_t).filter((F.col("project_id") == a.project) & (F.col("dataset_id") == a.dataset))
        if a.table:
            refs = refs.filter(F.col("table_id") == a.table)
        found = C.all_backups(X.last_backup(shard_b), X.last_table(shard_t)).join(
            refs.select(F.col("id").alias("table_entity_id")), "table_entity_id", "left_semi")
        found.write.mode("overwrite").parquet(a.out)
        print(f"backups: {spark.read.parquet(a.out).count()}")
    else:
        from keepsake.plans import restore as PR
        st = PR.restore_status(spark.read.parquet(f"{meta}/restoration_jobs"),
                               spark.read.parquet(f"{meta}/restore_items"), a.warnings_only)
        out = a.out.rstrip("/")
        st.jobs.write.mode("overwrite").parquet(f"{out}/jobs")
        st.results.write.mode("overwrite").parquet(f"{out}/results")
        st.items.write.mode("overwrite").parquet(f"{out}/items")
        print("status written")
    return 0


if __name__ == "__main__":
    sys.exit(main())
