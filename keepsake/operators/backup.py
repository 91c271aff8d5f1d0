"""Backup planning: which tables and day partitions need a copy, and the
bookkeeping after copies finish.

The reference runs these checks one HTTP task per table; here each is a
column over the frame of all tables, joined once with the live catalog, the
partition listing and the newest copy per table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keepsake.config import COPY_RETRY_LIMIT, RETRYABLE_COPY_REASONS
from keepsake.functions.timeutil import ts_lit
from keepsake.operators.common import latest_by

KEYS = ["project_id", "dataset_id", "table_id", "partition_id"]
UNIT_FLAGS = ["table_exists", "is_schema_defined", "is_external_or_view", "location",
              "has_partition_expiration", "lookup_status"]


def entity_id(project="project_id", dataset="dataset_id", table="table_id",
              partition="partition_id") -> F.Column:
    """Deterministic id for a new table entity: the same reference always
    gets the same id, so a retried job inserts nothing twice."""
    return F.abs(F.xxhash64(F.col(project), F.col(dataset), F.col(table),
                            F.coalesce(F.col(partition), F.lit("\u0000"))))


def keys_match(left: DataFrame, right: DataFrame, prefix: str = "") -> F.Column:
    """Equality on the 4-part table reference, NULL partition = NULL
    partition (the store compares `partition_id == None`)."""
    cond = None
    for k in KEYS:
        c = left[k].eqNullSafe(right[prefix + k])
        cond = c if cond is None else cond & c
    return cond


def route_partitions(sources: DataFrame, partitions: DataFrame) -> DataFrame:
    """Day-partitioned tables are replaced by one row per partition;
    every other table stays whole (a partitioning other than DAY counts as
    not partitioned).  Each row carries the metadata of its own unit:
    partition-level modification time, rows and bytes for partitions."""
    base = sources.select("project_id", "dataset_id", "table_id", *UNIT_FLAGS, "is_daily_partitioned",
                          "has_time_partitioning", "last_modified_time", "num_bytes", "num_rows")
    whole = base.filter(~F.col("is_daily_partitioned")).select(
        "project_id", "dataset_id", "table_id", F.lit(None).cast("string").alias("partition_id"),
        *UNIT_FLAGS, F.col("last_modified_time").alias("unit_last_modified"),
        F.col("num_bytes").alias("unit_num_bytes"), F.col("num_rows").alias("unit_num_rows"),
        (F.col("has_time_partitioning") & ~F.col("is_daily_partitioned")).alias("non_day_partitioning"))
    p = partitions.select(F.col("project_id").alias("p_project"), F.col("dataset_id").alias("p_dataset"),
                          F.col("table_id").alias("p_table"), "partition_id", "last_modified",
                          F.col("num_bytes").alias("p_bytes"), F.col("num_rows").alias("p_rows"))
    daily = base.filter(F.col("is_daily_partitioned"))
    parts = daily.join(p, (daily.project_id == p.p_project) & (daily.dataset_id == p.p_dataset)
                       & (daily.table_id == p.p_table), "inner").select(
        "project_id", "dataset_id", "table_id", "partition_id", *UNIT_FLAGS,
        F.col("last_modified").alias("unit_last_modified"), F.col("p_bytes").alias("unit_num_bytes"),
        F.col("p_rows").alias("unit_num_rows"), F.lit(False).alias("non_day_partitioning"))
    return whole.unionByName(parts)


def copyable(units: DataFrame) -> DataFrame:
    """+ copyable, reason — first failing check wins; an empty table is
    copyable."""
    empty = F.coalesce(F.col("unit_num_rows") == 0, F.lit(False))
    reason = (F.when(~F.coalesce(F.col("table_exists"), F.lit(False)), "Table not found")
              .when(~F.col("is_schema_defined"), "This table is without schema")
              .when(F.col("is_external_or_view"), "This table is external or view type")
              .when(empty, "This table is empty")
              .otherwise("This table is valid"))
    ok = reason.isin("This table is empty", "This table is valid")
    return units.withColumn("copyable", ok).withColumn("reason", reason)


def attach_last_backup(units: DataFrame, tables: DataFrame, backups: DataFrame) -> DataFrame:
    """Units + their table entity (NULL-safe 4-key match) + the entity's
    newest available copy (W7)."""
    t = tables.select(*[F.col(k).alias("e_" + k) for k in KEYS], F.col("id").alias("entity_id"),
                      "last_checked")
    newest = latest_by(backups.filter(F.col("deleted").isNull())
                       .select("parent_id", "created", "id", "last_modified", "num_bytes"),
                       ["parent_id"], "created", ["id"])
    nb = newest.select(F.col("parent_id").alias("lb_parent"), F.col("id").alias("last_backup_id"),
                       F.col("last_modified").alias("last_backup_last_modified"),
                       F.col("num_bytes").alias("last_backup_num_bytes"))
    j = units.join(t, keys_match(units, t, "e_"), "left").drop(*["e_" + k for k in KEYS])
    return j.join(nb, j.entity_id == nb.lb_parent, "left").drop("lb_parent")


def needs_backup(units: DataFrame) -> F.Column:
    """P2 over `attach_last_backup(copyable(...))`: copyable AND (no copy OR
    NOT(empty AND copy has bytes) AND (modified after the copy OR size
    differs)).  Equal timestamps are up to date; a NULL copy size is not
    > 0 but differs from any size."""
    empty = F.coalesce(F.col("unit_num_rows") == 0, F.lit(False))
    newer = F.coalesce(F.col("unit_last_modified") > F.col("last_backup_last_modified"), F.lit(True))
    size_differs = ~F.col("unit_num_bytes").eqNullSafe(F.col("last_backup_num_bytes"))
    had_bytes = F.coalesce(F.col("last_backup_num_bytes") > 0, F.lit(False))
    return F.col("copyable") & (F.col("last_backup_id").isNull()
                                | (~(empty & had_bytes) & (newer | size_differs)))


def on_demand_backup(live: DataFrame, requests: DataFrame) -> DataFrame:
    """Requested tables/partitions are always copied when copyable
    (freshness ignored).  A day-partitioned table without a partition is an
    error, a missing table is 'not found', other failed checks are
    validation errors.  Output: request columns + action, error."""
    lv = live.select(*[F.col(c).alias("lv_" + c) for c in live.columns])
    r = requests.join(lv, (requests.project_id == lv.lv_project_id) & (requests.dataset_id == lv.lv_dataset_id)
                      & (requests.table_id == lv.lv_table_id), "left")
    exists = F.coalesce(F.col("lv_table_exists"), F.lit(False))
    error = (F.when(~exists, "NotFound: table does not exist")
             .when(F.col("lv_is_daily_partitioned") & F.col("partition_id").isNull(),
                   "Partition id is required for a day-partitioned table")
             .when(~F.col("lv_is_schema_defined"), "ParameterValidation: This table is without schema")
             .when(F.col("lv_is_external_or_view"), "ParameterValidation: This table is external or view type"))
    return r.select(*requests.columns, F.when(error.isNull(), "backup").otherwise("reject").alias("action"),
                    error.alias("error"))


def upsert_last_checked(tables: DataFrame, plan: DataFrame, as_of: dt.datetime) -> DataFrame:
    """M1: every existing entity a run looked at gets last_checked = as_of
    (even without a copy); an entity is created only for a unit that is
    copied."""
    seen = plan.filter(F.col("entity_id").isNotNull()).select(F.col("entity_id").alias("_seen")).distinct()
    updated = (tables.join(seen, tables.id == seen._seen, "left")
               .select(*[F.when(F.col("_seen").isNotNull(), ts_lit(as_of)).otherwise(F.col("last_checked"))
                         .alias("last_checked") if c == "last_checked" else F.col(c) for c in tables.columns]))
    new = plan.filter(F.col("entity_id").isNull() & F.col("needs_backup")).select(entity_id().alias("id"), *KEYS).distinct()
    # two references with one hash stay two entities: the later ones in their order hash anew; an id has next to always one row
    nth = F.row_number().over(Window.partitionBy("id").orderBy(*KEYS))
    again = F.abs(F.xxhash64("id", "_nth", *KEYS))
    new = new.withColumn("_nth", nth).withColumn("id", F.when(F.col("_nth") == 1, F.col("id")).otherwise(again))
    return updated.unionByName(new.withColumn("last_checked", ts_lit(as_of)).select(*tables.columns))


def dedupe_copy_requests(requests: DataFrame, key: str = "request_key", order: str = "request_id") -> DataFrame:
    """M6: one copy per idempotency key (the earliest request wins); NULL
    keys are never deduplicated."""
    keyed = requests.filter(F.col(key).isNotNull())
    rest = [c for c in requests.columns if c not in (key, order)]
    first = (keyed.groupBy(key).agg(F.min(F.struct(order, *rest)).alias("_f"))
             .select(key, *[F.col("_f").getField(c).alias(c) for c in [order] + rest]))
    return first.select(*requests.columns).unionByName(requests.filter(F.col(key).isNull()))


def copy_result_class(results: DataFrame) -> DataFrame:
    """Pending (not DONE) / retry (retryable error reason and fewer
    than 6 retries; retry_count + 1) / failed (other errors) / done."""
    reason = F.col("status.errorResult.reason")
    has_errors = F.col("status.errorResult").isNotNull() | (F.coalesce(F.size("status.errors"), F.lit(0)) > 0)
    cls = (F.when(F.col("status.state") != "DONE", "pending")
           .when(has_errors & reason.isin(*RETRYABLE_COPY_REASONS) & (F.col("retry_count") < COPY_RETRY_LIMIT),
                 "retry")
           .when(has_errors, "failed").otherwise("done"))
    return results.withColumn("result_class", cls).withColumn(
        "next_retry_count", F.when(cls == "retry", F.col("retry_count") + 1).otherwise(F.col("retry_count")))


def submit_error_class(errors: DataFrame) -> DataFrame:
    """What to do when submitting a copy job fails: 500 'Deadline
    exceeded' → look the job up; 403 access denied / 404 → final 'Invalid'
    row; 409 → already submitted; anything else is raised."""
    code, msg = F.col("http_status"), F.coalesce(F.col("message"), F.lit(""))
    cls = (F.when((code == 500) & msg.contains("Deadline exceeded"), "lookup_job")
           .when(((code == 403) & msg.contains("Access Denied")) | (code == 404), "invalid")
           .when(code == 409, "already_submitted").otherwise("raise"))
    return errors.withColumn("action", cls)


def record_backups(backups: DataFrame, results: DataFrame, tables: DataFrame,
                   live_copies: DataFrame) -> DataFrame:
    """M2: a finished copy without errors whose target exists becomes a
    backup record (last_modified = copy start, created = copy end, bytes of
    the copy); insert-if-absent on (parent, dataset_id, table_id), deleted
    records count as present.  Returns the new records."""
    ok = results.filter((F.col("status.state") == "DONE") & F.col("status.errorResult").isNull()
                        & (F.coalesce(F.size("status.errors"), F.lit(0)) <= 0))
    src = F.col("configuration.copy.sourceTable")
    dst = F.col("configuration.copy.destinationTable")
    ok = ok.select(src.projectId.alias("project_id"), src.datasetId.alias("dataset_id"),
                   F.split(src.tableId, r"\$").getItem(0).alias("table_id"),
                   F.try_element_at(F.split(src.tableId, r"\$"), F.lit(2)).alias("partition_id"),
                   dst.datasetId.alias("c_dataset_id"), dst.tableId.alias("c_table_id"),
                   F.timestamp_millis(F.col("statistics.startTime").cast("long")).cast("timestamp_ntz")
                   .alias("last_modified"),
                   F.timestamp_millis(F.col("statistics.endTime").cast("long")).cast("timestamp_ntz")
                   .alias("created"))
    lc = live_copies.select(F.col("dataset_id").alias("lc_dataset"), F.col("table_id").alias("lc_table"),
                            F.col("num_bytes").alias("lc_bytes"))
    with_copy = ok.join(lc, (ok.c_dataset_id == lc.lc_dataset) & (ok.c_table_id == lc.lc_table), "inner")
    t = tables.select(*[F.col(k).alias("e_" + k) for k in KEYS], F.col("id").alias("parent_id"))
    rec = with_copy.join(t, keys_match(with_copy, t, "e_"), "inner").select(
        F.abs(F.xxhash64("parent_id", "c_dataset_id", "c_table_id")).alias("id"), "parent_id",
        "last_modified", "created", F.col("c_dataset_id").alias("dataset_id"),
        F.col("c_table_id").alias("table_id"), F.col("lc_bytes").alias("num_bytes"),
        F.lit(None).cast("timestamp_ntz").alias("deleted"))
    rec = latest_by(rec, ["parent_id", "dataset_id", "table_id"], "created", ["id"])
    keys = ["parent_id", "dataset_id", "table_id"]
    # New records are few, the record table is large: narrow it to the new
    # keys first (semi join, the small side is the build side when its
    # measured size allows), so the anti join never shuffles every record.
    existing = backups.select(*keys).join(rec.select(*keys), keys, "left_semi")
    return rec.join(existing, keys, "left_anti").select(*backups.columns)


def unexpire(new_records: DataFrame, plan: DataFrame) -> DataFrame:
    """Copies of tables with partition expiry must never expire: the
    list of copies whose expiration is cleared (expiration_ms = NULL)."""
    exp = plan.filter(F.col("has_partition_expiration")).select(
        F.col("target_dataset_id").alias("dataset_id"), F.col("target_table_id").alias("table_id"))
    return (new_records.join(exp, ["dataset_id", "table_id"], "left_semi")
            .select("dataset_id", "table_id", F.lit(None).cast("long").alias("expiration_ms")))
