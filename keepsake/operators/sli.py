"""Service-level indicators over catalog snapshots (census) and copies.

Latency (Q11): tables modified before x days that have no copy taken after
that change.  Quality (Q13): copies whose bytes/rows differ from their
unchanged source.  Orphans (Q16): copies in the backup project that no
record (or only a deleted record) points to.  Then the per-row live checks
of the reference become joins with the live catalog (P11–P18).

Census scans filter on the `snapshot_date` partition column with DATE
literals computed from `as_of` on the driver, so only the needed snapshot
days are listed and read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepsake.config import NONE_SENTINEL, UNPARTITIONED, Config
from keepsake.functions.timeutil import ts_lit
from keepsake.operators.common import latest_by

EPOCH = dt.datetime(1970, 1, 1)
TABLE_KEYS = ["projectId", "datasetId", "tableId"]
PARTITION_KEYS = TABLE_KEYS + ["partitionId"]
CENSUS_TIES = ["lastModifiedTime", "creationTime", "numRows", "numBytes"]


def partition_day_bounds(lo: dt.datetime, hi: dt.datetime) -> tuple[dt.date, dt.date]:
    """Days whose midnight (`_PARTITIONTIME`) lies in [lo, hi]."""
    first = lo.date() if lo.time() == dt.time(0) else lo.date() + dt.timedelta(days=1)
    return first, hi.date()


def _between_days(df: DataFrame, lo: dt.datetime, hi: dt.datetime) -> DataFrame:
    first, last = partition_day_bounds(lo, hi)
    return df.filter((F.col("snapshot_date") >= F.lit(first)) & (F.col("snapshot_date") <= F.lit(last)))


def latency_days(x: int) -> int:
    """d = 0 for x = 0, else x − 1 (the view of 'x days' looks d days back)."""
    return 0 if x == 0 else x - 1


def census_tables_scan(census_tables: DataFrame, lo: dt.datetime, hi: dt.datetime) -> DataFrame:
    """Plain tables (type TABLE, no time partitioning) of the snapshot
    days in [lo, hi]; partitionId := 'None'."""
    return (_between_days(census_tables, lo, hi)
            .filter((F.col("type") == "TABLE") & F.col("timePartitioning.type").isNull())
            .withColumn("partitionId", F.lit(NONE_SENTINEL)))


def census_partitions_scan(census_partitions: DataFrame, lo: dt.datetime, hi: dt.datetime) -> DataFrame:
    """Partition snapshots of the days in [lo, hi]."""
    return _between_days(census_partitions, lo, hi)


def latest_per_table(df: DataFrame) -> DataFrame:
    """Newest snapshot per table (aggregate form of ROW_NUMBER = 1)."""
    return latest_by(df, TABLE_KEYS, "snapshotTime", CENSUS_TIES)


def latest_per_partition(df: DataFrame) -> DataFrame:
    """Newest snapshot per partition."""
    return latest_by(df, PARTITION_KEYS, "snapshotTime", CENSUS_TIES)


_MODIFIED_COLS = ["projectId", "datasetId", "tableId", "partitionId", "creationTime",
                  "lastModifiedTime", "numRows"]


def _x_windows(x: int, as_of: dt.datetime):
    d = latency_days(x)
    lo = as_of - dt.timedelta(days=d + 2)
    hi = min(as_of, as_of - dt.timedelta(days=d - 2))
    return d, lo, hi, as_of - dt.timedelta(days=d)


def _tag_windows(df: DataFrame, xs, as_of: dt.datetime) -> DataFrame:
    """Keep each snapshot once per x whose window it falls in (snapshot day
    in [lo, hi], modified by the cut-off): one scan serves every x.  The
    scan itself is limited to the union of the windows (partition pruning)."""
    bounds = {x: _x_windows(x, as_of) for x in xs}
    days = [partition_day_bounds(b[1], b[2]) for b in bounds.values()]
    first, last = min(d[0] for d in days), max(d[1] for d in days)
    df = df.filter((F.col("snapshot_date") >= F.lit(first)) & (F.col("snapshot_date") <= F.lit(last)))
    tags = []
    for x, (d, lo, hi, cut) in bounds.items():
        f, l = partition_day_bounds(lo, hi)
        cond = ((F.col("snapshot_date") >= F.lit(f)) & (F.col("snapshot_date") <= F.lit(l))
                & (F.col("lastModifiedTime") <= ts_lit(cut)))
        tags.append(F.when(cond, F.lit(x)))
    tagged = df.withColumn("_x", F.explode(F.array(*tags)))
    return tagged.filter(F.col("_x").isNotNull())


def modified_before_multi(census_tables: DataFrame, census_partitions: DataFrame, xs,
                          as_of: dt.datetime) -> DataFrame:
    """Q11 first half for several x at once (+ `x`): filter first, then the
    newest snapshot per (x, table) and per (x, partition) (W1, W2), UNION ALL
    (U-1)."""
    cols = _MODIFIED_COLS + ["snapshotTime", "numBytes", "_x"]
    t = (_tag_windows(census_tables, xs, as_of)
         .filter((F.col("type") == "TABLE") & F.col("timePartitioning.type").isNull())
         .withColumn("partitionId", F.lit(NONE_SENTINEL)).select(*cols))
    p = _tag_windows(census_partitions, xs, as_of).select(*cols)
    out = (latest_by(t, ["_x"] + TABLE_KEYS, "snapshotTime", CENSUS_TIES).select("_x", *_MODIFIED_COLS)
           .unionByName(latest_by(p, ["_x"] + PARTITION_KEYS, "snapshotTime", CENSUS_TIES)
                        .select("_x", *_MODIFIED_COLS)))
    return out.withColumnRenamed("_x", "x")


def modified_before(census_tables: DataFrame, census_partitions: DataFrame, x: int,
                    as_of: dt.datetime) -> DataFrame:
    """Q11 first half: tables and partitions whose newest snapshot in the
    window shows a modification at least d days old."""
    return modified_before_multi(census_tables, census_partitions, [x], as_of).drop("x")


def latency_sli_multi(modified: DataFrame, last_available: DataFrame, as_of: dt.datetime,
                      cfg: Config) -> DataFrame:
    """Q11 second half for the frame of `modified_before_multi` (J2, one join
    for every x): census ⟕ last available copy on the four keys ('None'
    sentinel on both sides); no copy = epoch 0.  A violation: the newest
    copy is older than the x cut-off and older than the change."""
    lb = last_available.select(
        F.col("source_project_id"), F.col("source_dataset_id"), F.col("source_table_id"),
        F.col("source_partition_id"), F.col("backup_created"), F.col("backup_last_modified"))
    j = modified.join(lb, (modified.projectId == lb.source_project_id)
                      & (modified.datasetId == lb.source_dataset_id)
                      & (modified.tableId == lb.source_table_id)
                      & (modified.partitionId == lb.source_partition_id), "left")
    epoch = ts_lit(EPOCH)
    created = F.coalesce(F.col("backup_created"), epoch)
    last_mod = F.coalesce(F.col("backup_last_modified"), epoch)
    cutoff = ts_lit(as_of) - F.make_dt_interval(days=F.when(F.col("x") == 0, F.lit(0))
                                                 .otherwise(F.col("x") - 1).cast("int"))
    return (j.filter(~F.col("projectId").isin(cfg.backup_project, cfg.restoration_project)
                     & (F.col("partitionId") != UNPARTITIONED)
                     & (F.col("numRows") != 0)
                     & (created < cutoff)
                     & (last_mod < F.col("lastModifiedTime")))
            .select("x", "projectId", "datasetId", "tableId", "partitionId", "creationTime",
                    "lastModifiedTime", created.alias("backup_created"),
                    last_mod.alias("backup_last_modified")))


def latency_sli(modified: DataFrame, last_available: DataFrame, x: int, as_of: dt.datetime,
                cfg: Config) -> DataFrame:
    """Q11 second half for one x (`modified` from `modified_before`)."""
    return latency_sli_multi(modified.withColumn("x", F.lit(x)), last_available, as_of, cfg).drop("x")


def _datediff_ge(as_of: dt.datetime, col: str, days: int) -> F.Column:
    return F.datediff(F.lit(as_of.date()), F.to_date(col)) >= days


_SOURCE_COLS = ["projectId", "datasetId", "tableId", "partitionId", "lastModifiedTime", "numBytes",
                "numRows"]


def quality_sources(census_tables: DataFrame, census_partitions: DataFrame, as_of: dt.datetime,
                    cfg: Config) -> DataFrame:
    """Q13 sources: tables not modified for 3 days.  The table branch ranks
    first, then filters on age (W3) and excludes the backup and restoration
    projects; the partition branch excludes only the backup project."""
    day = dt.datetime.combine(as_of.date(), dt.time(0))
    lo, hi = day - dt.timedelta(days=3), day
    cols = _SOURCE_COLS + ["snapshotTime", "creationTime"]
    t = latest_per_table(census_tables_scan(census_tables, lo, hi).select(*cols))
    t = t.filter(_datediff_ge(as_of, "lastModifiedTime", 3)
                 & ~F.col("projectId").isin(cfg.backup_project, cfg.restoration_project))
    p = latest_per_partition(census_partitions_scan(census_partitions, lo, hi).select(*cols))
    p = p.filter(_datediff_ge(as_of, "lastModifiedTime", 3) & (F.col("projectId") != cfg.backup_project))
    return t.select(*_SOURCE_COLS).unionByName(p.select(*_SOURCE_COLS))


def last_backup_in_census(last_available: DataFrame, census_copies: DataFrame,
                          backup_project: str) -> DataFrame:
    """The last available copy of every table entity with what the
    census sees of that copy (LEFT: NULL when the census has not seen it)."""
    c = (census_copies.filter(F.col("projectId") == backup_project)
         .select(F.col("datasetId").alias("c_dataset"), F.col("tableId").alias("c_table"),
                 F.col("lastModifiedTime").alias("c_last_modified"),
                 F.col("numBytes").alias("c_num_bytes"), F.col("numRows").alias("c_num_rows")))
    lb = last_available
    return lb.join(c, (c.c_dataset == lb.backup_dataset_id) & (c.c_table == lb.backup_table_id), "left")\
        .select("source_project_id", "source_dataset_id", "source_table_id", "source_partition_id",
                F.col("c_last_modified").alias("backup_last_modified"),
                lb.backup_last_modified.alias("backup_entity_last_modified_time"),
                lb.backup_num_bytes.alias("backup_entity_num_bytes"),
                "backup_dataset_id", "backup_table_id",
                F.col("c_num_bytes").alias("backup_num_bytes"), F.col("c_num_rows").alias("backup_num_rows"))


def quality_sli(sources: DataFrame, in_census: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Q13 (J4): sources ⋈ last copy in census.  The WHERE on right-side
    columns makes the reference's LEFT join an inner one."""
    s, c = sources, in_census
    j = s.join(c, (s.projectId == c.source_project_id) & (s.datasetId == c.source_dataset_id)
               & (s.tableId == c.source_table_id) & (s.partitionId == c.source_partition_id), "inner")
    cond = (_datediff_ge(as_of, "backup_entity_last_modified_time", 3)
            & F.col("backup_table_id").isNotNull()
            & (F.col("source_partition_id") != UNPARTITIONED)
            & ((F.col("numBytes") != F.col("backup_num_bytes"))
               | (F.col("numRows") != F.col("backup_num_rows"))
               | F.col("backup_num_bytes").isNull())
            & (F.col("numRows") != 0))
    return j.filter(cond).select(
        F.col("projectId").alias("source_project_id"), F.col("datasetId").alias("source_dataset_id"),
        F.col("tableId").alias("source_table_id"), F.col("partitionId").alias("source_partition_id"),
        "backup_dataset_id", "backup_table_id",
        F.col("lastModifiedTime").alias("source_last_modified"), "backup_last_modified",
        F.col("backup_entity_last_modified_time").alias("backup_entity_last_modified"),
        F.col("numBytes").alias("source_num_bytes"), "backup_num_bytes", "backup_entity_num_bytes",
        F.col("numRows").alias("source_num_rows"), "backup_num_rows")


def _orphan_base(census_copies: DataFrame, as_of: dt.datetime, backup_project: str) -> DataFrame:
    limit = ts_lit(dt.datetime.combine(as_of.date() - dt.timedelta(days=7), dt.time(0)))
    return (census_copies.filter((F.col("projectId") == backup_project)
                                 & F.col("tableId").like("20%")
                                 & (F.col("lastModifiedTime") < limit))
            .select("tableId", "datasetId", "projectId"))


def orphans_deleted(census_copies: DataFrame, all_backups_df: DataFrame, as_of: dt.datetime,
                    backup_project: str) -> DataFrame:
    """Copies still in the census whose record was deleted over a week
    ago (IN subquery → left semi join)."""
    limit = ts_lit(dt.datetime.combine(as_of.date() - dt.timedelta(days=7), dt.time(0)))
    gone = all_backups_df.filter(F.col("backup_deleted").isNotNull() & (F.col("backup_deleted") < limit))\
        .select(F.col("backup_table_id").alias("tableId"))
    return _orphan_base(census_copies, as_of, backup_project).join(gone, "tableId", "left_semi")


def orphans_unrecorded(census_copies: DataFrame, all_backups_df: DataFrame, as_of: dt.datetime,
                       backup_project: str) -> DataFrame:
    """Copies no record points to (NOT IN → left anti; a NULL record id
    never matches)."""
    ids = all_backups_df.select(F.col("backup_table_id").alias("tableId"))
    return _orphan_base(census_copies, as_of, backup_project).join(ids, "tableId", "left_anti")


def orphaned_backups(census_copies: DataFrame, all_backups_df: DataFrame, as_of: dt.datetime,
                     backup_project: str) -> DataFrame:
    """Q16 = J5 UNION ALL J6 (U-2).  The branches exclude each other (J5
    needs a record, J6 none), so both come from one left join of the census
    copies with one row per recorded copy id (`recorded`, `deleted_long_ago`
    — a partial aggregate): one scan and one shuffle instead of two."""
    limit = ts_lit(dt.datetime.combine(as_of.date() - dt.timedelta(days=7), dt.time(0)))
    facts = (all_backups_df.groupBy(F.col("backup_table_id").alias("tableId"))
             .agg(F.max(F.col("backup_deleted").isNotNull() & (F.col("backup_deleted") < limit))
                  .alias("_deleted_long_ago")))
    j = _orphan_base(census_copies, as_of, backup_project).join(facts, "tableId", "left")
    return (j.filter(F.col("_deleted_long_ago").isNull() | F.col("_deleted_long_ago"))
            .select("tableId", "datasetId", "projectId"))


# ----------------------------------------------------------------- live checks
def _live_table_cols(live: DataFrame, prefix: str = "lv_") -> DataFrame:
    keep = ["project_id", "dataset_id", "table_id", "lookup_status", "table_exists", "creation_time",
            "last_modified_time", "num_rows", "is_schema_defined", "has_time_partitioning"]
    return live.select(*[F.col(c).alias(prefix + c) for c in keep])


def with_live(sli: DataFrame, live: DataFrame) -> DataFrame:
    """One left join with the live catalog instead of a lookup per row.
    The candidates are planned once; AQE broadcasts a side by its measured
    size and shuffles both otherwise."""
    lv = _live_table_cols(live)
    return sli.join(lv, (sli.projectId == lv.lv_project_id) & (sli.datasetId == lv.lv_dataset_id)
                    & (sli.tableId == lv.lv_table_id), "left")


def with_partition(sli: DataFrame, partitions: DataFrame, partition_col: str) -> DataFrame:
    """Partition-level lookup: listed? and its last-modified time.

    A partition whose lookup failed has `lookup_status` 'error'; lookups of
    frames without that column never fail."""
    status = F.col("lookup_status") if "lookup_status" in partitions.columns else F.lit("found")
    p = partitions.select(F.col("project_id").alias("lp_project_id"),
                          F.col("dataset_id").alias("lp_dataset_id"),
                          F.col("table_id").alias("lp_table_id"),
                          F.col("partition_id").alias("lp_partition_id"),
                          F.col("last_modified").alias("lp_last_modified"), status.alias("lp_lookup_status"))
    return sli.join(p, (sli.projectId == p.lp_project_id) & (sli.datasetId == p.lp_dataset_id)
                    & (sli.tableId == p.lp_table_id) & (F.col(partition_col) == p.lp_partition_id), "left")


def lookup_error() -> F.Column:
    """The lookup of the table or, where a partition is asked, of its partitions failed."""
    return F.coalesce(F.col("lv_lookup_status") == "error", F.lit(False)) | F.coalesce(
        F.col("lp_lookup_status") == "error", F.lit(False))


def source_exists(partition_col: str) -> F.Column:
    """P14 over a frame joined with live and partitions: exists, has a schema
    and (no partition asked, table not time-partitioned, or partition
    listed)."""
    exists = F.coalesce(F.col("lv_table_exists"), F.lit(False))
    schema = F.coalesce(F.col("lv_is_schema_defined"), F.lit(False))
    part_ok = (F.col(partition_col).isNull()
               | ~F.coalesce(F.col("lv_has_time_partitioning"), F.lit(False))
               | F.col("lp_partition_id").isNotNull())
    return exists & schema & part_ok


def is_recreated() -> F.Column:
    """The live table was created after the census saw it."""
    return F.coalesce(F.col("lv_creation_time") > F.col("creationTime"), F.lit(False))


def has_any_backup() -> F.Column:
    """A copy exists (backupCreated after epoch 0)."""
    return F.col("backupCreated") > ts_lit(EPOCH)


def is_source_empty() -> F.Column:
    """The live table has no rows (table-level lookup)."""
    return F.coalesce(F.col("lv_num_rows") == 0, F.lit(False))


def is_newer(partition_col: str) -> F.Column:
    """Live last-modified (partition-level when a partition is asked)
    after the census' one."""
    live_lm = F.when(F.col(partition_col).isNotNull() & F.coalesce(F.col("lv_has_time_partitioning"), F.lit(False)),
                     F.col("lp_last_modified")).otherwise(F.col("lv_last_modified_time"))
    return F.coalesce(live_lm > F.col("lastModifiedTime"), F.lit(False))


def copy_not_in_census() -> F.Column:
    """P16 (over a frame joined with live copies as `lc_*`): the copy exists,
    the census has no time for it, and its live size equals the record."""
    return (F.coalesce(F.col("lc_exists"), F.lit(False))
            & F.col("backupLastModifiedTime").isNull()
            & F.coalesce(F.col("lc_num_bytes") == F.col("backupEntityNumBytes"), F.lit(False)))


def confirm_latency(sli: DataFrame, live: DataFrame, partitions: DataFrame) -> DataFrame:
    """Keep iff exists ∧ ¬recreated ∧ ¬(has_any_backup ∧ empty); a
    failed lookup keeps the row.  The latency reader keeps 'None' as a
    partition id (it is asked as a partition)."""
    j = with_partition(with_live(sli, live), partitions, "partitionId")
    keep = lookup_error() | (source_exists("partitionId") & ~is_recreated()
                             & ~(has_any_backup() & is_source_empty()))
    return j.filter(keep).select(*sli.columns)


def confirm_quality(sli: DataFrame, live: DataFrame, partitions: DataFrame,
                    live_copies: DataFrame) -> DataFrame:
    """Keep iff exists ∧ ¬newer ∧ ¬copy_not_in_census; a failed lookup of
    the table, its partitions or the copy keeps the row.  The quality reader maps 'None' back to NULL."""
    s = sli.withColumn("_part", F.when(F.col("partitionId") != NONE_SENTINEL, F.col("partitionId")))
    status = F.col("lookup_status") if "lookup_status" in live_copies.columns else F.lit("found")
    lc = live_copies.select(F.col("dataset_id").alias("lc_dataset_id"), F.col("table_id").alias("lc_table_id"),
                            F.lit(True).alias("lc_exists"), (status == "error").alias("lc_failed"), F.col("num_bytes").alias("lc_num_bytes"))
    j = with_partition(with_live(s, live), partitions, "_part")
    j = j.join(lc, (j.backupDatasetId == lc.lc_dataset_id) & (j.backupTableId == lc.lc_table_id), "left")
    failed = lookup_error() | F.coalesce(F.col("lc_failed"), F.lit(False))
    keep = failed | (source_exists("_part") & ~is_newer("_part") & ~copy_not_in_census())
    return j.filter(keep).select(*sli.columns)


# ----------------------------------------------------------------- history views
def newest_latency_snapshot(history: DataFrame, as_of: dt.datetime) -> DataFrame:
    """today's ingest partition, newest snapshot per xDays (dense rank 1
    = all rows at the maximum time, markers included), then markers dropped.
    Written as max-per-xDays + join: a handful of rows per key after the
    aggregate."""
    today = history.filter(F.col("ingest_date") == F.lit(as_of.date()))
    newest = today.groupBy("xDays").agg(F.max("snapshotTime").alias("_newest"))
    return (today.join(newest, "xDays")
            .filter((F.col("snapshotTime") == F.col("_newest")) & (F.col("projectId") != "SNAPSHOT_MARKER"))
            .drop("_newest", "ingest_date"))


def newest_quality_snapshot(history: DataFrame, as_of: dt.datetime) -> DataFrame:
    """DENSE_RANK over all rows = rows at the global maximum snapshot
    time; the maximum is one scalar aggregate joined back (a partitionless
    window would run in a single task)."""
    today = history.filter(F.col("ingest_date") == F.lit(as_of.date()))
    newest = today.agg(F.max("snapshotTime").alias("_newest"))
    return (today.join(newest, F.col("snapshotTime") == F.col("_newest"))
            .filter(F.col("projectId") != "SNAPSHOT_MARKER").drop("_newest", "ingest_date"))


def latency_by_count(current: DataFrame) -> DataFrame:
    """A1: violations per xDays (xDays as integer)."""
    return current.groupBy(F.col("xDays").cast("int").alias("xDays")).agg(F.count(F.lit(1)).alias("count"))


def last_snapshot_time(history: DataFrame, as_of: dt.datetime) -> DataFrame:
    """A2: newest snapshot time of today's partition, markers included."""
    return (history.filter(F.col("ingest_date") == F.lit(as_of.date()))
            .agg(F.max("snapshotTime").alias("snapshotTime")))
