"""Jobs that move data: Q2 retention_apply, Q4 backup_run, Q5 on-demand
run, Q9 restore_run.  Planning is one Spark plan each; copies and deletes
run through `sources.copy`; the metadata results are DataFrames the caller
writes back (after a reliable checkpoint when it overwrites its input)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepsake.config import Config
from keepsake.operators import backup as B
from keepsake.operators import restore as RS
from keepsake.operators import retention as R
from keepsake.plans.backup import backup_plan, copy_plan, on_demand_entities, on_demand_plan
from keepsake.plans.retention import retention_plan
from keepsake.session import checkpoint_root
from keepsake.sources import copy as CP
from keepsake.sources.metadata import write_metadata  # noqa: F401 - jobs write their results back with it


def materialize(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint
    folder (survives executor loss; needed before overwriting an input)."""
    checkpoint_root(spark)
    return df.checkpoint(eager=True)


@dataclass
class RetentionOutcome:
    plan: DataFrame
    outcomes: DataFrame
    backups: DataFrame


def retention_apply(spark: SparkSession, tables: DataFrame, backups: DataFrame, live: DataFrame,
                    cfg: Config, warehouse: CP.Warehouse, parallelism: int = 8) -> RetentionOutcome:
    """Q2: Q1 → S14 (drop the copies not retained) → M4 (mark them deleted)."""
    plan = materialize(spark, retention_plan(tables, backups, live, cfg))
    doomed = (plan.filter(~F.col("retained")).select("id")
              .join(backups.select("id", "dataset_id", "table_id"), "id"))
    outcomes = materialize(spark, CP.delete_copies(spark, doomed, warehouse, cfg.backup_project, parallelism))
    return RetentionOutcome(plan, outcomes, R.mark_deleted(backups, outcomes, cfg.as_of))


@dataclass
class BackupOutcome:
    plan: DataFrame
    tables: DataFrame
    results: DataFrame
    classes: DataFrame
    new_backups: DataFrame
    unexpire: DataFrame


def backup_run(spark: SparkSession, live: DataFrame, partitions: DataFrame, tables: DataFrame,
               backups: DataFrame, cfg: Config, warehouse: CP.Warehouse, parallelism: int = 4) -> BackupOutcome:
    """Q4: Q3 → M1 → M6 → S12 → P21 → M2 → S17."""
    plan = materialize(spark, backup_plan(live, partitions, tables, backups, cfg))
    new_tables = materialize(spark, B.upsert_last_checked(tables, plan, cfg.as_of))
    requests = copy_plan(plan).withColumn("request_id", F.monotonically_increasing_id())
    requests = B.dedupe_copy_requests(requests, "request_key", "request_id")
    results = copy_with_retries(spark, materialize(spark, requests), warehouse, cfg.backup_project, parallelism)
    classes = B.copy_result_class(CP.as_job_documents(results))
    new = materialize(spark, record_copies(backups, results, new_tables))
    return BackupOutcome(plan, new_tables, results, classes, new, B.unexpire(new, plan))


def record_copies(backups: DataFrame, results: DataFrame, tables: DataFrame) -> DataFrame:
    """M2 over a run's results.  A copy that an earlier, lost run committed
    but did not record comes back as 'duplicate': it is recorded now, since
    its id is the idempotency key of the same copy."""
    there = results.withColumn("error_reason", F.when(F.col("error_reason") != "duplicate", F.col("error_reason")))
    return B.record_backups(backups, CP.as_job_documents(there), tables, CP.copies_catalog(there))


def copy_with_retries(spark: SparkSession, requests: DataFrame, warehouse: CP.Warehouse, backup_project: str,
                      parallelism: int = 4) -> DataFrame:
    """S12 → P21 → S12 …: copies whose result is retryable (backend or
    internal error, quota) are submitted again, at most COPY_RETRY_LIMIT
    times; every other outcome is final.  Returns one final result per
    copy with `retry_count`."""
    from keepsake.config import COPY_RETRY_LIMIT, RETRYABLE_COPY_REASONS
    keys = ["target_dataset_id", "target_table_id"]
    results = materialize(spark, CP.snapshot_copy(spark, requests, warehouse, backup_project, parallelism)
                          .withColumn("retry_count", F.lit(0)))
    for attempt in range(1, COPY_RETRY_LIMIT + 1):
        again = results.filter(F.col("error_reason").isin(*RETRYABLE_COPY_REASONS)).select(*keys)
        if again.isEmpty():
            break
        redo = requests.join(again, keys, "left_semi")
        fresh = CP.snapshot_copy(spark, redo, warehouse, backup_project, parallelism)\
            .withColumn("retry_count", F.lit(attempt))
        results = materialize(spark, results.join(again, keys, "left_anti").unionByName(fresh))
    return results


def on_demand_run(spark: SparkSession, live: DataFrame, requests: DataFrame, tables: DataFrame,
                  backups: DataFrame, cfg: Config, warehouse: CP.Warehouse) -> BackupOutcome:
    """Q5: P3 → S12 → M2 for explicitly requested tables (freshness is
    ignored; rejected requests carry their error)."""
    checked, todo = on_demand_plan(live, requests, cfg)
    todo = materialize(spark, todo)
    new_tables = materialize(spark, on_demand_entities(tables, todo, cfg))
    results = materialize(spark, CP.snapshot_copy(spark, todo, warehouse, cfg.backup_project))
    # materialized: callers overwrite the metadata tables these derive from
    new = materialize(spark, record_copies(backups, results, new_tables))
    return BackupOutcome(materialize(spark, checked), new_tables, results,
                         B.copy_result_class(CP.as_job_documents(results)), new, B.unexpire(new, todo))


@dataclass
class RestoreOutcome:
    job: DataFrame
    items: DataFrame
    targets: DataFrame
    results: DataFrame


def restore_run(spark: SparkSession, jobs: DataFrame, new_job: DataFrame, items: DataFrame,
                datasets: DataFrame, live: DataFrame, source_datasets: DataFrame,
                warehouse: CP.Warehouse, parallelism: int = 4) -> RestoreOutcome:
    """Q9: M5 (a known job id restores nothing) → A6 (items_count) → S15
    (targets to create) → S13 (copies with the job's dispositions) → M3
    (first terminal status per item)."""
    created = materialize(spark, RS.create_job(jobs, new_job))
    # fixed before the copies run: a status must land on the item that was copied
    its = materialize(spark, items.join(created.select(F.col("id").alias("job_id")), "job_id", "left_semi"))
    counts = RS.items_count(its)
    job = created.join(counts.withColumnRenamed("job_id", "id"), "id", "left")\
        .withColumn("items_count", F.coalesce(F.col("items"), F.lit(0)).cast("long")).drop("items")
    targets = materialize(spark, RS.prepare_targets(its, datasets, live, source_datasets))
    CP.create_targets(spark, targets, its, warehouse)
    work = its.join(job.select(F.col("id").alias("job_id"), "create_disposition", "write_disposition"), "job_id")
    results = restore_with_retries(spark, materialize(spark, work), warehouse, parallelism)
    folded = RS.fold_item_status(its, CP.restore_events(results))
    return RestoreOutcome(job, folded, targets, results)


def restore_with_retries(spark: SparkSession, work: DataFrame, warehouse: CP.Warehouse,
                         parallelism: int = 4) -> DataFrame:
    """S13 with the same retry rule as copies: retryable failures are run
    again (at most COPY_RETRY_LIMIT times), other outcomes are final."""
    from keepsake.config import COPY_RETRY_LIMIT, RETRYABLE_COPY_REASONS
    results = materialize(spark, CP.restore_copy(spark, work, warehouse, parallelism)
                          .withColumn("retry_count", F.lit(0)))
    for attempt in range(1, COPY_RETRY_LIMIT + 1):
        again = results.filter(F.col("error_reason").isin(*RETRYABLE_COPY_REASONS)).select("item_id")
        if again.isEmpty():
            break
        redo = work.join(again.withColumnRenamed("item_id", "id"), "id", "left_semi")
        fresh = CP.restore_copy(spark, redo, warehouse, parallelism).withColumn("retry_count", F.lit(attempt))
        results = materialize(spark, results.join(again, "item_id", "left_anti").unionByName(fresh))
    return results
