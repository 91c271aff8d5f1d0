"""Registered retention queries (Q1 and its stages)."""

from __future__ import annotations

from pyspark.sql import functions as F

from keepsake.checks.oracle import (CANDIDATE_THRESHOLD, GRACE_THRESHOLD, YOUNG_THRESHOLD, AS_OF,
                                    EXISTS_SQL)
from keepsake.operators import retention as R
from keepsake.plans.retention import retention_plan, stored_retention_plan
from keepsake.registry import register
from keepsake.sources.bucketed import stored_parts
from keepsake.sources.testviews import TestViews, default_config

CFG = default_config()


def _avail(v: TestViews):
    return R.available(v.backups).select("id", "parent_id", "table_id", "created")


@register("p6_retention_candidates",
          f"SELECT * FROM tables WHERE last_checked >= {CANDIDATE_THRESHOLD}", ("tables",))
def p6(spark, sf):
    v = TestViews.of(spark, sf)
    return R.retention_candidates(v.tables, CFG.as_of, CFG.grace_months)


@register("a5_duplicate_copies", """
SELECT parent_id, arg_max(table_id, (c, table_id)) AS table_id, max(c) AS copies
FROM (SELECT parent_id, table_id, count(*) AS c FROM avail_all GROUP BY 1, 2) WHERE c > 1
GROUP BY parent_id""", ("avail_all",))
def a5(spark, sf):
    return R.duplicate_copies(_avail(TestViews.of(spark, sf)))


@register("p9_valid_groups", """
SELECT id, parent_id, table_id, created FROM avail_all
WHERE parent_id NOT IN (SELECT parent_id FROM avail_all GROUP BY parent_id, table_id HAVING count(*) > 1)""",
          ("avail_all",))
def p9(spark, sf):
    valid, _ = R.valid_groups(_avail(TestViews.of(spark, sf)))
    return valid.select("id", "parent_id", "table_id", "created")


_DAILY_ALL = """
SELECT * EXCLUDE (rn) FROM (
  SELECT id, parent_id, table_id, created, row_number() OVER (
    PARTITION BY parent_id, CAST(created AS DATE) ORDER BY created DESC, id DESC) AS rn
  FROM avail_all) WHERE rn = 1"""


@register("w8_most_recent_daily", _DAILY_ALL, ("avail_all",))
def w8(spark, sf):
    return R.most_recent_daily(_avail(TestViews.of(spark, sf))).select("id", "parent_id", "table_id", "created")


@register("p7_age_split", f"""
SELECT id, parent_id, table_id, created, CAST(created AS DATE) >= {YOUNG_THRESHOLD} AS young
FROM avail_all""", ("avail_all",))
def p7(spark, sf):
    return R.age_split(_avail(TestViews.of(spark, sf)), CFG.as_of, CFG.young_months)


def _ranked_sql(keep: str) -> str:
    return f"""
SELECT id, parent_id, table_id, created, young FROM (
  SELECT *, row_number() OVER (PARTITION BY parent_id, young ORDER BY created DESC, id DESC) AS rn
  FROM (SELECT *, CAST(created AS DATE) >= {YOUNG_THRESHOLD} AS young FROM ({_DAILY_ALL})))
WHERE {keep}"""


def _daily_young(sf, spark):
    return R.age_split(R.most_recent_daily(_avail(TestViews.of(spark, sf))), CFG.as_of, CFG.young_months)


@register("w9_keep_n_young", _ranked_sql("NOT young OR rn <= 10"), ("avail_all",))
def w9(spark, sf):
    return R.keep_n_young(_daily_young(sf, spark), CFG.keep_young)


@register("w10_keep_one_old", _ranked_sql("young OR rn = 1"), ("avail_all",))
def w10(spark, sf):
    return R.keep_one_old(_daily_young(sf, spark))


@register("p8_grace_filter", f"""
SELECT * FROM (WITH kept AS ({_ranked_sql("(young AND rn <= 10) OR (NOT young AND rn = 1)")}),
g AS (
  SELECT s.parent_id, (NOT s.has_old) OR coalesce(CAST(t.last_checked AS DATE) >= {GRACE_THRESHOLD}, false)
         OR {EXISTS_SQL} AS keep
  FROM (SELECT parent_id, bool_or(CAST(created AS DATE) < {GRACE_THRESHOLD}) AS has_old
        FROM kept GROUP BY 1) s
  LEFT JOIN tables t ON t.id = s.parent_id
  LEFT JOIN live l ON l.project_id = t.project_id AND l.dataset_id = t.dataset_id
                   AND l.table_id = t.table_id)
SELECT kept.* FROM kept JOIN g USING (parent_id) WHERE g.keep)""", ("avail_all", "tables", "live"))
def p8(spark, sf):
    v = TestViews.of(spark, sf)
    kept = R.keep_one_old(R.keep_n_young(_daily_young(sf, spark), CFG.keep_young))
    return R.grace_filter(kept, v.tables, v.live, CFG.as_of, CFG.grace_months)


@register("q1_retention_plan", "SELECT * FROM retention_plan", ("retention_plan",))
def q1(spark, sf):
    v = TestViews.of(spark, sf)
    return retention_plan(v.tables, v.backups, v.live, CFG)


@register("q1_stored_retention_plan", "SELECT * FROM retention_plan", ("retention_plan",))
def q1_stored(spark, sf):
    """Q1 over entities and records stored by table (`sources.bucketed`)."""
    v = TestViews.of(spark, sf)
    return stored_retention_plan(stored_parts(spark, v.tables, v.backups), v.live, CFG)


@register("j10_not_retained", """
SELECT id, parent_id, table_id, created FROM avail
WHERE id NOT IN (SELECT id FROM retention_plan WHERE retained)""", ("avail", "retention_plan"))
def j10(spark, sf):
    v = TestViews.of(spark, sf)
    plan = retention_plan(v.tables, v.backups, v.live, CFG)
    cand = R.retention_candidates(v.tables, CFG.as_of, CFG.grace_months)
    avail = _avail(v).join(cand.select(F.col("id").alias("parent_id")), "parent_id", "left_semi")
    return R.not_retained(avail, plan.filter("retained"))


@register("a8_retention_report", """
SELECT parent_id, count(*) AS copies,
  count(*) FILTER (WHERE reason = 'kept') AS kept,
  count(*) FILTER (WHERE reason = 'duplicate_table_id') AS duplicate_table_id,
  count(*) FILTER (WHERE reason = 'not_newest_of_day') AS not_newest_of_day,
  count(*) FILTER (WHERE reason = 'young_over_limit') AS young_over_limit,
  count(*) FILTER (WHERE reason = 'old_not_newest') AS old_not_newest,
  count(*) FILTER (WHERE reason = 'source_gone') AS source_gone,
  count(*) FILTER (WHERE reason = 'lookup_failed') AS lookup_failed
FROM retention_plan GROUP BY parent_id""", ("retention_plan",))
def a8(spark, sf):
    v = TestViews.of(spark, sf)
    return R.retention_report(retention_plan(v.tables, v.backups, v.live, CFG))


def _outcome(c):
    return F.when(c % 3 != 0, "deleted").when(c % 2 == 0, "not_found").otherwise("error")


@register("m4_mark_deleted", f"""
SELECT b.id, b.parent_id, b.last_modified, b.created, b.dataset_id, b.table_id, b.num_bytes,
       CASE WHEN o.outcome IN ('deleted', 'not_found') AND b.deleted IS NULL THEN {AS_OF}
            ELSE b.deleted END AS deleted
FROM backups b LEFT JOIN (
  SELECT id, CASE WHEN id % 3 <> 0 THEN 'deleted' WHEN id % 2 = 0 THEN 'not_found' ELSE 'error' END AS outcome
  FROM retention_plan WHERE NOT retained) o USING (id)""", ("backups", "retention_plan"))
def m4(spark, sf):
    v = TestViews.of(spark, sf)
    plan = retention_plan(v.tables, v.backups, v.live, CFG)
    outcomes = plan.filter(~F.col("retained")).select("id", _outcome(F.col("id")).alias("outcome"))
    return R.mark_deleted(v.backups, outcomes, CFG.as_of)
