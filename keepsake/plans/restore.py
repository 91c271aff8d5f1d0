"""User-level restore jobs (planning side): Q6 dataset restore, Q7 table
restore "as of", Q8 restore of a list of backup keys, Q10 restore status.
The copies themselves run in `plans.jobs.restore_run` (Q9)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepsake.config import STATUS_IN_PROGRESS
from keepsake.functions import columns as U
from keepsake.operators import restore as RS
from keepsake.session import written


@dataclass
class DatasetRestorePlan:
    checks: DataFrame   # A7: per request, tables found and the validation error (NULL = valid)
    items: DataFrame    # restore items of the valid requests, 'In Progress'


def dataset_restore_plan(requests: DataFrame, tables: DataFrame, backups: DataFrame, datasets: DataFrame,
                         backup_datasets: DataFrame, as_of: dt.datetime, backup_project: str) -> DatasetRestorePlan:
    """Q6: validate each dataset restore (A7), then one item per table of the
    dataset that has an available copy (P10 when max_partition_days is set
    and not 0; W7; U7).  Requests: request_id, project_id, dataset_id,
    target_project_id, target_dataset_id, max_partition_days."""
    # requests, entities and newest copies meet once; the checks and the items are both read from that frame
    found = written(RS.dataset_tables(requests, tables, backups), "restore-tables")
    checks = RS.dataset_checks(found, datasets, backup_datasets, as_of)
    valid = found.join(checks.filter(F.col("error").isNull()).select("request_id"), "request_id", "left_semi")
    return DatasetRestorePlan(checks, RS.dataset_items(valid, as_of, backup_project))


def table_restore_plan(requests: DataFrame, tables: DataFrame, backups: DataFrame, as_of: dt.datetime,
                       backup_project: str, target_project: str | None = None,
                       target_dataset: str | None = None) -> DataFrame:
    """Q7: J7 → one item per request.  Requests: request_id, project_id,
    dataset_id, table_id, partition_id, date_text ('YYYY-MM-DD' = that day
    23:59:59; NULL = as_of).  Invalid dates, missing tables and missing
    copies are error rows."""
    r = requests.withColumn("not_newer_than", RS.request_time(F.col("date_text"), as_of))
    out = RS.as_of_backup(r, tables, backups)
    date_err = F.when(F.col("date_text").isNotNull() & F.col("not_newer_than").isNull(), RS.WRONG_DATE)
    out = out.withColumn("error", F.coalesce(date_err, F.col("error")))
    ok = F.col("error").isNull()
    tp = F.lit(target_project) if target_project else F.lit(None).cast("string")
    td = F.lit(target_dataset) if target_dataset else F.lit(None).cast("string")
    return out.select("request_id", "error",
                      F.when(ok, U.restore_source(backup_project, "backup_dataset_id", "backup_table_id",
                                                  "partition_id")).alias("source_table"),
                      F.when(ok, U.restore_target(tp, td, "project_id", "dataset_id", "table_id",
                                                  "partition_id")).alias("target_table"),
                      F.when(ok, F.lit(STATUS_IN_PROGRESS)).alias("status"))


def list_restore_plan(requests: DataFrame, backups: DataFrame, tables: DataFrame, backup_project: str,
                      target_project: str | None = None, target_dataset: str | None = None) -> DataFrame:
    """Q8: U4 (parse keys) → U-4 (a list naming a copy twice is rejected
    whole) → J8 (copy → parent table) → U7.  Requests: list_id, request_id,
    backupBqKey, backupUrlSafeKey."""
    # parsed and resolved once: the check for duplicates and the items both read from that frame
    resolved = written(RS.resolve_backup_keys(RS.parse_list_requests(requests), backups, tables), "restore-list")
    return RS.list_restore_items(resolved, backup_project, target_project, target_dataset)


@dataclass
class RestoreStatus:
    jobs: DataFrame      # A4: state and result per job
    results: DataFrame   # A3: item counts per camelCased status (+ unknown)
    items: DataFrame     # item listing (F13, F15, U3), warnings only when asked


def restore_status(jobs: DataFrame, items: DataFrame, warnings_only: bool = False) -> RestoreStatus:
    """Q10: counts are taken before the warnings-only filter (P20)."""
    listed = RS.warnings_only(items) if warnings_only else items
    return RestoreStatus(RS.job_status(jobs, items), RS.item_results(jobs, items), RS.item_listing(listed))
