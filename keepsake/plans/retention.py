"""Q1 retention_plan and Q2 retention_apply."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keepsake.config import Config
from keepsake.functions.timeutil import date_lit, months_before_date
from keepsake.operators import retention as R
from keepsake.sources.bucketed import Part


def retention_plan(tables: DataFrame, backups: DataFrame, live: DataFrame,
                   cfg: Config) -> DataFrame:
    """Q1: decide, for every available copy of every table retention visits,
    whether it is retained and which rule removes it.

    Order of the rules is the reference's: candidates (P6) → available →
    duplicate check (P9) → newest per day (W8) → ten young (W9) → one old
    (W10) → grace period after deletion (P8) → the rest is deleted (J10).
    A table whose lookup P8 needs and that failed keeps every copy.

    Output: id, parent_id, table_id, created, retained, reason.
    """
    cand = R.retention_candidates(tables, cfg.as_of, cfg.grace_months)
    # Hash-partitioned by copy id (uniform even when one table holds a third
    # of all copies) once: the final join by id reuses this partitioning, and
    # the duplicate check and the per-day reduction read the same shuffle
    # output instead of scanning the backup records again.
    avail = (R.available(backups)
             .select("id", "parent_id", "table_id", "created")
             .join(cand.select(F.col("id").alias("parent_id")), "parent_id", "left_semi")
             .repartition("id"))

    # Tables with a physical copy id recorded twice are skipped whole.
    rejected = R.duplicate_copies(avail).select("parent_id", F.lit(True).alias("dup"))
    flagged = avail.join(rejected, "parent_id", "left")
    valid = flagged.filter(F.col("dup").isNull()).drop("dup")

    # W8 → at most one row per table and day from here on.
    daily = R.newest_daily_ids(valid)
    young = F.to_date("created") >= date_lit(months_before_date(cfg.as_of_date, cfg.young_months))
    w = Window.partitionBy("parent_id", "young").orderBy(F.col("created").desc(), F.col("id").desc())
    ranked = daily.withColumn("young", young).withColumn("_rn", F.row_number().over(w))
    step = (F.when(F.col("young") & (F.col("_rn") > cfg.keep_young), "young_over_limit")
            .when(~F.col("young") & (F.col("_rn") > 1), "old_not_newest"))
    ranked = ranked.withColumn("_step", step)

    # P8 looks only at what W8–W10 left, then drops all of it.
    survivors = ranked.filter(F.col("_step").isNull())
    grace = R.grace_keep_tables(survivors, cand, live, cfg.as_of, cfg.grace_months)
    decided = ranked.select("id", F.coalesce("_step", F.lit("kept")).alias("_reason"))

    gone = (F.col("_reason") == "kept") & ~F.col("keep")
    reason = (F.when(F.col("lookup_failed"), "lookup_failed").when(gone, "source_gone")
              .otherwise(F.coalesce("_reason", F.when(F.col("dup"), "duplicate_table_id"), F.lit("not_newest_of_day"))))
    return (flagged.join(decided, "id", "left").join(grace, "parent_id", "left")
            .select("id", "parent_id", "table_id", "created",
                    reason.isin("kept", "duplicate_table_id", "lookup_failed").alias("retained"),
                    reason.alias("reason")))


def _even_plan(tables: DataFrame, backups: DataFrame, live: DataFrame, cfg: Config) -> DataFrame:
    """Q1 over records in buckets of their table. The rules are windows on one
    frame, all partitioned by the table first, so they run where the records
    lie; no table has more of them than an average bucket."""
    cand = R.retention_candidates(tables, cfg.as_of, cfg.grace_months)
    avail = (R.available(backups).select("id", "parent_id", "table_id", "created")
             .join(cand.select(F.col("id").alias("parent_id")), "parent_id", "left_semi"))
    newest = (F.col("created").desc(), F.col("id").desc())
    young = F.to_date("created") >= date_lit(months_before_date(cfg.as_of_date, cfg.young_months))
    whole = (Window.unboundedPreceding, Window.unboundedFollowing)
    # whole tables, in the order in which their rows come from the window before
    by_table = lambda *order: Window.partitionBy("parent_id").orderBy(*order).rowsBetween(*whole)
    rows = avail.withColumn("_same", F.count(F.lit(1)).over(Window.partitionBy("parent_id", "table_id").orderBy("id").rowsBetween(*whole)))
    rows = rows.withColumn("dup", F.max(F.col("_same") > 1).over(by_table("table_id")))
    rows = rows.withColumn("_of_day", F.row_number().over(Window.partitionBy("parent_id", F.to_date("created")).orderBy(*newest)) == 1)
    rows = rows.withColumn("young", young)
    rows = rows.withColumn("_rn", F.row_number().over(Window.partitionBy("parent_id", "young", "_of_day").orderBy(*newest)))
    step = (F.when(F.col("dup"), "duplicate_table_id").when(~F.col("_of_day"), "not_newest_of_day")
            .when(F.col("young") & (F.col("_rn") > cfg.keep_young), "young_over_limit")
            .when(~F.col("young") & (F.col("_rn") > 1), "old_not_newest").otherwise("kept"))
    before_grace = F.to_date("created") < date_lit(months_before_date(cfg.as_of_date, cfg.grace_months))
    rows = rows.withColumn("_step", step)
    rows = rows.withColumn("_old", F.coalesce(F.max((F.col("_step") == "kept") & before_grace).over(by_table("young")), F.lit(False)))
    # P8 by table: tables are matched with the live catalog, then brought to the buckets
    asked = rows.join(R.grace_lookup(cand, live, cfg.as_of, cfg.grace_months), "parent_id", "left")
    needed = F.col("_old") & ~F.col("dup") & ~F.col("seen")
    reason = (F.when(needed & F.col("error"), "lookup_failed")
              .when(needed & ~F.col("exists") & (F.col("_step") == "kept"), "source_gone").otherwise(F.col("_step")))
    return asked.select("id", "parent_id", "table_id", "created",
                        reason.isin("kept", "duplicate_table_id", "lookup_failed").alias("retained"), reason.alias("reason"))


def stored_retention_plan(parts: list[Part], live: DataFrame, cfg: Config) -> DataFrame:
    """Q1 over `sources.bucketed`: records in buckets are not exchanged; those
    of hot tables, which lie apart, go through `retention_plan`."""
    even, hot = ([p for p in parts if p.even == kind] for kind in (True, False))
    plans = [_even_plan(p.tables, p.backups, live, cfg) for p in even] + [retention_plan(p.tables, p.backups, live, cfg) for p in hot]
    return reduce(DataFrame.unionByName, plans)
