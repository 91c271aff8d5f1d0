"""Retention operators: which stored copies a table keeps.

Everything is set-at-a-time over all tables of the organisation.  The only
steps that see raw backup rows per table are aggregates (partial, map-side
combined), so a table holding a third of all copies never lands whole in one
task.  After `most_recent_daily` a table has at most one row per calendar
day, so the later per-table windows work on bounded groups.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keepsake.functions.timeutil import date_lit, months_before, months_before_date, ts_lit
from keepsake.operators.common import latest_by, newest_id

REASONS = ("kept", "duplicate_table_id", "not_newest_of_day", "young_over_limit",
           "old_not_newest", "source_gone", "lookup_failed")


def available(backups: DataFrame) -> DataFrame:
    """Copies not yet deleted (`deleted IS NULL`)."""
    return backups.filter(F.col("deleted").isNull())


def retention_candidates(tables: DataFrame, as_of: dt.datetime, grace_months: int) -> DataFrame:
    """Tables seen within grace+1 months (datetime precision); older
    tables are never visited by retention again."""
    threshold = months_before(as_of, grace_months + 1)
    return tables.filter(F.col("last_checked") >= ts_lit(threshold))


def duplicate_copies(backups: DataFrame) -> DataFrame:
    """A5: per table, the most frequent physical copy id if it occurs more
    than once (ties: the greatest copy id)."""
    counts = (backups.groupBy("parent_id", "table_id")
              .agg(F.count(F.lit(1)).alias("copies"))
              .filter(F.col("copies") > 1))
    return (counts.groupBy("parent_id")
            .agg(F.max(F.struct("copies", "table_id")).alias("m"))
            .select("parent_id", F.col("m.table_id").alias("table_id"),
                    F.col("m.copies").alias("copies")))


def valid_groups(backups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split available copies into tables retention may process and
    tables it must skip (one physical table id recorded twice; the dataset
    is ignored).  Returns (valid copies, rejected tables with the duplicate)."""
    rejected = duplicate_copies(backups)
    valid = backups.join(rejected.select("parent_id"), "parent_id", "left_anti")
    return valid, rejected


def most_recent_daily(backups: DataFrame) -> DataFrame:
    """Per table and calendar day of `created`, the newest copy (ties:
    greatest id)."""
    with_day = backups.withColumn("_day", F.to_date("created"))
    return latest_by(with_day, ["parent_id", "_day"], "created", ["id"]).drop("_day")


def newest_daily_ids(backups: DataFrame) -> DataFrame:
    """W8 for plans that go on with ids: parent_id, created, id of each
    table's newest copy of a day, aggregated by hashing."""
    with_day = backups.withColumn("_day", F.to_date("created"))
    return newest_id(with_day, ["parent_id", "_day"], "created", "id").drop("_day")


def age_split(backups: DataFrame, as_of: dt.datetime, months: int) -> DataFrame:
    """`young` iff date(created) >= date(as_of) - months (calendar
    months, month-end clamped); the threshold day itself is young."""
    threshold = months_before_date(as_of.date(), months)
    return backups.withColumn("young", F.to_date("created") >= date_lit(threshold))


def _newest_first(df: DataFrame, n: int) -> DataFrame:
    """Newest n rows per table.  A bare `row_number() <= n` filter lets Spark
    insert a partial WindowGroupLimit before the shuffle, so each map task
    forwards at most n rows per table even for a table holding a third of
    all rows."""
    w = Window.partitionBy("parent_id").orderBy(F.col("created").desc(), F.col("id").desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def keep_n_young(backups: DataFrame, n: int) -> DataFrame:
    """The newest n young copies per table and every old one (input
    carries `young`)."""
    young = backups.filter(F.col("young"))
    return _newest_first(young, n).unionByName(backups.filter(~F.col("young")))


def keep_one_old(backups: DataFrame) -> DataFrame:
    """Every young copy and the newest old one per table."""
    old = backups.filter(~F.col("young"))
    return backups.filter(F.col("young")).unionByName(_newest_first(old, 1))


def source_exists_column(partition_id: str = "partition_id") -> F.Column:
    """Existence of a table reference in the live catalog, from a left join
    with it.  A partition asked of a table that is not partitioned does not
    exist.  A failed lookup counts as existing."""
    found = F.coalesce(F.col("table_exists"), F.lit(False)) & (
        F.col(partition_id).isNull() | F.coalesce(F.col("has_time_partitioning"), F.lit(False)))
    return found | F.coalesce(F.col("lookup_status") == "error", F.lit(False))


def grace_keep_tables(retained: DataFrame, tables: DataFrame, live: DataFrame,
                      as_of: dt.datetime, months: int) -> DataFrame:
    """P8 decision per table: `parent_id, keep, lookup_failed`.

    keep iff no remaining copy is older than the threshold, or the source was
    seen on/after the threshold day, or the source still exists.
    lookup_failed: the decision needs the lookup, and the lookup failed; then
    retention of the whole table is abandoned and none of its copies goes."""
    threshold = date_lit(months_before_date(as_of.date(), months))
    per_table = (retained.groupBy("parent_id")
                 .agg(F.max(F.to_date("created") < threshold).alias("has_old")))
    t = tables.select(F.col("id").alias("parent_id"), "project_id", "dataset_id", "table_id",
                      "partition_id", "last_checked")
    lv = live.select("project_id", "dataset_id", "table_id", "lookup_status", "table_exists",
                     "has_time_partitioning")
    j = (per_table.join(t, "parent_id", "left")
         .join(lv, ["project_id", "dataset_id", "table_id"], "left"))
    sure = ~F.col("has_old") | F.coalesce(F.to_date("last_checked") >= threshold, F.lit(False))
    failed = ~sure & F.coalesce(F.col("lookup_status") == "error", F.lit(False))
    return j.select("parent_id", (sure | source_exists_column()).alias("keep"), failed.alias("lookup_failed"))


def grace_lookup(tables: DataFrame, live: DataFrame, as_of: dt.datetime, months: int) -> DataFrame:
    """What P8 asks of each table, whatever copies it has: `parent_id, seen`
    (on/after the threshold day), `exists, error` (of the lookup)."""
    threshold = date_lit(months_before_date(as_of.date(), months))
    lv = live.select("project_id", "dataset_id", "table_id", "lookup_status", "table_exists", "has_time_partitioning")
    return tables.join(lv, ["project_id", "dataset_id", "table_id"], "left").select(
        F.col("id").alias("parent_id"), F.coalesce(F.to_date("last_checked") >= threshold, F.lit(False)).alias("seen"),
        source_exists_column().alias("exists"), F.coalesce(F.col("lookup_status") == "error", F.lit(False)).alias("error"))


def grace_filter(retained: DataFrame, tables: DataFrame, live: DataFrame,
                 as_of: dt.datetime, months: int) -> DataFrame:
    """Drop every remaining copy of tables whose source is gone for
    longer than the grace period (young copies too)."""
    decision = grace_keep_tables(retained, tables, live, as_of, months)
    return retained.join(decision.filter("keep").select("parent_id"), "parent_id", "left_semi")


def not_retained(backups: DataFrame, retained: DataFrame) -> DataFrame:
    """Copies to delete = available minus retained, by copy id."""
    return backups.join(retained.select("id"), "id", "left_anti")


def retention_report(plan: DataFrame) -> DataFrame:
    """Per table, copies in and how many each step removed."""
    aggs = [F.count(F.lit(1)).alias("copies")]
    aggs += [F.count_if(F.col("reason") == r).alias(r) for r in REASONS]
    return plan.groupBy("parent_id").agg(*aggs)


def mark_deleted(backups: DataFrame, outcomes: DataFrame, as_of: dt.datetime) -> DataFrame:
    """M4: `deleted = as_of` for copies dropped or already missing; other
    outcomes (errors) leave the row unchanged.  `outcomes`: id, outcome in
    ('deleted', 'not_found', 'error')."""
    o = outcomes.select("id", "outcome")
    gone = F.col("outcome").isin("deleted", "not_found")
    cols = [F.when(gone & F.col("deleted").isNull(), ts_lit(as_of)).otherwise(F.col("deleted"))
            .alias("deleted") if c == "deleted" else F.col(c) for c in backups.columns]
    return backups.join(o, "id", "left").select(*cols)
