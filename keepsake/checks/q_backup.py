"""Registered backup-planning queries: S7–S9, P1–P5, U1, U2, U5, Q3, Q5,
M1, M2, M6, S17, P21, P22."""

from __future__ import annotations

from pyspark.sql import functions as F

from keepsake.checks.oracle import AS_OF
from keepsake.functions import columns as U
from keepsake.operators import backup as B
from keepsake.plans.backup import backup_plan, on_demand_entities, on_demand_plan
from keepsake.registry import register
from keepsake.session import written
from keepsake.sources import catalog as SC
from keepsake.sources.testviews import TestViews, default_config

CFG = default_config()

LIVE_COLS = ("project_id, dataset_id, table_id, lookup_status, table_exists, creation_time, "
             "last_modified_time, num_bytes, num_rows, type, location, time_partitioning_type, "
             "partition_expiration_ms, is_empty, is_external_or_view, is_schema_defined, "
             "is_daily_partitioned, has_time_partitioning, has_partition_expiration")


@register("s9_live_catalog", f"SELECT {LIVE_COLS} FROM live", ("live",))
def s9(spark, sf):
    return TestViews.of(spark, sf).live


@register("s8_list_partitions", "SELECT * FROM partitions", ("partitions",))
def s8(spark, sf):
    return TestViews.of(spark, sf).partitions


@register("s7_enumerate_sources", f"SELECT {LIVE_COLS} FROM live WHERE table_exists", ("live",))
def s7(spark, sf):
    return SC.enumerate_sources(TestViews.of(spark, sf).live)


@register("p5_select_projects", f"""
SELECT {LIVE_COLS} FROM live WHERE table_exists AND project_id IN ('p0', 'p1', 'p3')
  AND project_id NOT IN ('p3')""", ("live",))
def p5(spark, sf):
    return SC.enumerate_sources(TestViews.of(spark, sf).live, custom=("p0", "p1", "p3"), skip=("p3",))


UNITS_SQL = """
SELECT project_id, dataset_id, table_id, CAST(NULL AS VARCHAR) AS partition_id, table_exists,
       is_schema_defined, is_external_or_view, location, has_partition_expiration, lookup_status,
       last_modified_time AS unit_last_modified, num_bytes AS unit_num_bytes, num_rows AS unit_num_rows,
       has_time_partitioning AND NOT is_daily_partitioned AS non_day_partitioning
FROM live WHERE table_exists AND NOT is_daily_partitioned
UNION ALL
SELECT s.project_id, s.dataset_id, s.table_id, p.partition_id, s.table_exists, s.is_schema_defined,
       s.is_external_or_view, s.location, s.has_partition_expiration, s.lookup_status,
       p.last_modified, p.num_bytes, p.num_rows, false
FROM live s JOIN partitions p ON p.project_id = s.project_id AND p.dataset_id = s.dataset_id
  AND p.table_id = s.table_id
WHERE s.table_exists AND s.is_daily_partitioned"""

COPYABLE_SQL = f"""
SELECT *, reason IN ('This table is empty', 'This table is valid') AS copyable FROM (
  SELECT *, CASE WHEN NOT coalesce(table_exists, false) THEN 'Table not found'
                 WHEN NOT is_schema_defined THEN 'This table is without schema'
                 WHEN is_external_or_view THEN 'This table is external or view type'
                 WHEN coalesce(unit_num_rows = 0, false) THEN 'This table is empty'
                 ELSE 'This table is valid' END AS reason
  FROM ({UNITS_SQL}))"""

PLAN_SQL = f"""
SELECT u.project_id, u.dataset_id, u.table_id, u.partition_id, t.id AS entity_id, u.copyable, u.reason,
  u.copyable AND (n.id IS NULL OR (NOT (coalesce(u.unit_num_rows = 0, false) AND coalesce(n.num_bytes > 0, false))
    AND (coalesce(u.unit_last_modified > n.last_modified, true) OR u.unit_num_bytes IS DISTINCT FROM n.num_bytes)))
    AS needs_backup,
  replace(CAST(year({AS_OF}) AS VARCHAR) || '_' || lpad(CAST(weekofyear({AS_OF}) AS VARCHAR), 2, '0')
          || '_' || u.location || '_' || u.project_id, '-', '_') AS target_dataset_id,
  strftime({AS_OF}, '%Y%m%d_%H%M%S') || '_' || replace(u.project_id, '-', '_') || '_' || u.dataset_id
    || '_' || u.table_id || coalesce('_partition_' || u.partition_id, '') AS target_table_id,
  regexp_replace(strftime({AS_OF}, '%Y-%m-%d') || '_' || u.project_id || ':' || u.dataset_id || '.'
    || u.table_id || coalesce('$' || u.partition_id, '') || '_0_None', '[$.: ]', '_', 'g') AS request_key,
  u.location, u.has_partition_expiration, u.unit_last_modified, u.unit_num_bytes
FROM ({COPYABLE_SQL}) u
LEFT JOIN tables t ON t.project_id = u.project_id AND t.dataset_id = u.dataset_id
  AND t.table_id = u.table_id AND t.partition_id IS NOT DISTINCT FROM u.partition_id
LEFT JOIN newest_avail n ON n.parent_id = t.id"""
PLAN_NEEDS = ("live", "partitions", "tables", "newest_avail")


def _plan(v):
    return backup_plan(v.live, v.partitions, v.tables, v.backups, CFG)


@register("p4_route_partitions", UNITS_SQL, ("live", "partitions"))
def p4(spark, sf):
    v = TestViews.of(spark, sf)
    return B.route_partitions(SC.enumerate_sources(v.live), v.partitions)


@register("p1_copyable", COPYABLE_SQL, ("live", "partitions"))
def p1(spark, sf):
    v = TestViews.of(spark, sf)
    return B.copyable(B.route_partitions(SC.enumerate_sources(v.live), v.partitions))


@register("p2_needs_backup", f"""
SELECT project_id, dataset_id, table_id, partition_id, entity_id, needs_backup FROM ({PLAN_SQL})""",
          PLAN_NEEDS)
def p2(spark, sf):
    return _plan(TestViews.of(spark, sf)).select("project_id", "dataset_id", "table_id", "partition_id",
                                              "entity_id", "needs_backup")


@register("q3_backup_plan", PLAN_SQL, PLAN_NEEDS)
def q3(spark, sf):
    return _plan(TestViews.of(spark, sf))


@register("u1_backup_table_id", f"""
SELECT id, strftime(created, '%Y%m%d_%H%M%S') || '_' || replace(project_id, '-', '_') || '_' || dataset_id
       || '_' || table_id || coalesce('_partition_' || partition_id, '') AS backup_table_id
FROM (SELECT b.id, b.created, t.project_id, t.dataset_id, t.table_id, t.partition_id
      FROM backups b JOIN tables t ON t.id = b.parent_id)""", ("backups", "tables"))
def u1(spark, sf):
    v = TestViews.of(spark, sf)
    j = v.backups.select("id", "created", "parent_id").join(
        v.tables.select(F.col("id").alias("parent_id"), "project_id", "dataset_id", "table_id", "partition_id"),
        "parent_id")
    return j.select("id", U.backup_table_id("project_id", "dataset_id", "table_id", "created", "partition_id")
                    .alias("backup_table_id"))


@register("u2_backup_dataset_id", """
SELECT id, replace(CAST(year(created) AS VARCHAR) || '_' || lpad(CAST(weekofyear(created) AS VARCHAR), 2, '0')
       || '_' || CASE WHEN id % 2 = 0 THEN 'EU' ELSE 'europe-west1' END || '_' || 'p-' || CAST(parent_id % 4 AS VARCHAR),
       '-', '_') AS backup_dataset_id
FROM backups""", ("backups",))
def u2(spark, sf):
    b = TestViews.of(spark, sf).backups
    loc = F.when(F.col("id") % 2 == 0, "EU").otherwise("europe-west1")
    proj = F.concat(F.lit("p-"), (F.col("parent_id") % 4).cast("string"))
    return b.select("id", U.backup_dataset_id(F.to_date("created"), loc, proj).alias("backup_dataset_id"))


@register("u5_copy_request_key", f"""
SELECT project_id, dataset_id, table_id, partition_id, request_key FROM ({PLAN_SQL})""", PLAN_NEEDS)
def u5(spark, sf):
    return _plan(TestViews.of(spark, sf)).select("project_id", "dataset_id", "table_id", "partition_id",
                                              "request_key")


@register("m1_upsert_last_checked", f"""
SELECT t.project_id, t.dataset_id, t.table_id, t.partition_id,
       CASE WHEN t.id IN (SELECT entity_id FROM ({PLAN_SQL}) WHERE entity_id IS NOT NULL) THEN {AS_OF}
            ELSE t.last_checked END AS last_checked, false AS is_new
FROM tables t
UNION ALL
SELECT DISTINCT project_id, dataset_id, table_id, partition_id, {AS_OF}, true
FROM ({PLAN_SQL}) WHERE entity_id IS NULL AND needs_backup""", PLAN_NEEDS)
def m1(spark, sf):
    v = TestViews.of(spark, sf)
    out = B.upsert_last_checked(v.tables, _plan(v), CFG.as_of)
    return out.join(v.tables.select(F.col("id"), F.lit(False).alias("_old")), "id", "left").select(
        "project_id", "dataset_id", "table_id", "partition_id", "last_checked",
        F.col("_old").isNull().alias("is_new"))


_REQ_K = "(CAST(substr(table_id, 2) AS BIGINT) * 1000000000 + coalesce(TRY_CAST(partition_id AS BIGINT), 0))"


@register("m6_dedupe_copy_requests", f"""
SELECT request_key, min(request_id) AS request_id, count(*) AS requests FROM (
  SELECT request_key, 2 * {_REQ_K} AS request_id FROM ({PLAN_SQL}) WHERE needs_backup
  UNION ALL
  SELECT request_key, 2 * {_REQ_K} + 1 FROM ({PLAN_SQL}) WHERE needs_backup AND length(table_id) % 2 = 0)
WHERE request_key IS NOT NULL GROUP BY request_key""", PLAN_NEEDS)
def m6(spark, sf):
    """Each copy request once plus a retry of every other one (the same
    idempotency key, a later request id); after M6 one request per key
    remains, the earliest."""
    plan = _plan(TestViews.of(spark, sf)).filter("needs_backup")
    k = (F.substring("table_id", 2, 10).cast("long") * 1000000000
         + F.coalesce(F.col("partition_id").try_cast("long"), F.lit(0)))
    first = plan.select("request_key", (k * 2).alias("request_id"))
    again = plan.filter(F.length("table_id") % 2 == 0).select("request_key", (k * 2 + 1).alias("request_id"))
    reqs = first.unionByName(again)
    deduped = B.dedupe_copy_requests(reqs.withColumn("n", F.lit(1)), "request_key", "request_id")
    counts = reqs.groupBy("request_key").agg(F.count(F.lit(1)).alias("requests"))
    return deduped.filter(F.col("request_key").isNotNull()).join(counts, "request_key").select(
        "request_key", "request_id", "requests")


def _results(v, plan):
    return v.copy_results(plan)


def _results_sql(plan: str) -> str:
    return f"""
SELECT p.*, k, CASE WHEN k % 9 = 0 THEN 'RUNNING' ELSE 'DONE' END AS state,
       CASE WHEN k % 5 = 0 THEN 'backendError' WHEN k % 7 = 0 THEN 'duplicate' END AS error_reason,
       k % 8 AS retry_count,
       CAST({AS_OF} AS TIMESTAMP) AS start_time, {AS_OF} + to_seconds(CAST(k AS BIGINT)) AS end_time
FROM (SELECT *, CAST(substr(table_id, 2, 10) AS BIGINT)
                + coalesce(TRY_CAST(partition_id AS BIGINT) % 7, 0) AS k
      FROM ({plan}) WHERE needs_backup) p"""


RESULTS_SQL = _results_sql(PLAN_SQL)


@register("p21_copy_result_class", f"""
SELECT 'backup' AS projectId, target_dataset_id AS datasetId, target_table_id AS tableId,
       CASE WHEN state <> 'DONE' THEN 'pending'
            WHEN error_reason IN ('backendError', 'internalError', 'quotaExceeded') AND retry_count < 6 THEN 'retry'
            WHEN error_reason IS NOT NULL THEN 'failed' ELSE 'done' END AS result_class,
       retry_count + CASE WHEN state = 'DONE' AND error_reason IN ('backendError', 'internalError', 'quotaExceeded')
                          AND retry_count < 6 THEN 1 ELSE 0 END AS next_retry_count
FROM ({RESULTS_SQL})""", PLAN_NEEDS)
def p21(spark, sf):
    v = TestViews.of(spark, sf)
    r = B.copy_result_class(_results(v, _plan(v)))
    d = F.col("configuration.copy.destinationTable")
    return r.select(d.projectId.alias("projectId"), d.datasetId.alias("datasetId"), d.tableId.alias("tableId"),
                    "result_class", "next_retry_count")


@register("p22_submit_error_class", f"""
SELECT target_table_id, http_status, message,
       CASE WHEN http_status = 500 AND message LIKE '%Deadline exceeded%' THEN 'lookup_job'
            WHEN (http_status = 403 AND message LIKE '%Access Denied%') OR http_status = 404 THEN 'invalid'
            WHEN http_status = 409 THEN 'already_submitted' ELSE 'raise' END AS action
FROM (SELECT target_table_id, CAST([500, 403, 404, 409, 503][CAST(k % 5 AS INTEGER) + 1] AS INTEGER) AS http_status,
             CASE WHEN k % 5 = 0 THEN 'Deadline exceeded' WHEN k % 5 = 1 THEN 'Access Denied: table'
                  ELSE 'error ' || CAST(k AS VARCHAR) END AS message
      FROM ({RESULTS_SQL}))""", PLAN_NEEDS)
def p22(spark, sf):
    """Submission errors of every planned copy: HTTP status by rule k % 5."""
    v = TestViews.of(spark, sf)
    plan = _plan(v).filter("needs_backup")
    k = (F.substring("table_id", 2, 10).cast("long")
         + F.coalesce(F.col("partition_id").try_cast("long") % 7, F.lit(0)))
    codes = F.array(*[F.lit(c) for c in (500, 403, 404, 409, 503)])
    msg = (F.when(k % 5 == 0, "Deadline exceeded").when(k % 5 == 1, "Access Denied: table")
           .otherwise(F.concat(F.lit("error "), k.cast("string"))))
    errs = plan.select("target_table_id", F.element_at(codes, (k % 5 + 1).cast("int")).alias("http_status"),
                       msg.alias("message"))
    return B.submit_error_class(errs)


def _recorded(v):
    """M2 as the backup run does it: plan, entities and results are fixed before the records are made."""
    plan = written(_plan(v), "backup-plan")
    res = written(_results(v, plan), "copy-results")
    done = res.filter((F.col("status.state") == "DONE") & F.col("status.errorResult").isNull())
    copies = done.select(F.col("configuration.copy.destinationTable.datasetId").alias("dataset_id"),
                         F.col("configuration.copy.destinationTable.tableId").alias("table_id"),
                         F.col("copied_bytes").alias("num_bytes"))
    tables = written(B.upsert_last_checked(v.tables, plan, CFG.as_of), "entities")
    return B.record_backups(v.backups, res, tables, copies), tables, plan


@register("m2_record_backups", f"""
SELECT t.project_id, t.dataset_id AS source_dataset_id, t.table_id AS source_table_id, t.partition_id,
       r.start_time AS last_modified, r.end_time AS created, r.target_dataset_id AS dataset_id,
       r.target_table_id AS table_id, r.unit_num_bytes AS num_bytes
FROM ({RESULTS_SQL}) r JOIN (
  SELECT project_id, dataset_id, table_id, partition_id FROM tables
  UNION SELECT project_id, dataset_id, table_id, partition_id FROM ({PLAN_SQL})
  WHERE entity_id IS NULL AND needs_backup) t
  ON t.project_id = r.project_id AND t.dataset_id = r.dataset_id AND t.table_id = r.table_id
 AND t.partition_id IS NOT DISTINCT FROM r.partition_id
WHERE r.state = 'DONE' AND r.error_reason IS NULL""", PLAN_NEEDS)
def m2(spark, sf):
    v = TestViews.of(spark, sf)
    rec, tables, _ = _recorded(v)
    t = tables.select(F.col("id").alias("parent_id"), "project_id", F.col("dataset_id").alias("source_dataset_id"),
                      F.col("table_id").alias("source_table_id"), "partition_id")
    return rec.join(t, "parent_id").select("project_id", "source_dataset_id", "source_table_id", "partition_id",
                                           "last_modified", "created", "dataset_id", "table_id", "num_bytes")


@register("s17_unexpire", f"""
SELECT r.target_dataset_id AS dataset_id, r.target_table_id AS table_id, CAST(NULL AS BIGINT) AS expiration_ms
FROM ({RESULTS_SQL}) r WHERE r.state = 'DONE' AND r.error_reason IS NULL AND r.has_partition_expiration""",
          PLAN_NEEDS)
def s17(spark, sf):
    v = TestViews.of(spark, sf)
    rec, _, plan = _recorded(v)
    return B.unexpire(rec, plan)


@register("q5_on_demand_backup", """
SELECT r.project_id, r.dataset_id, r.table_id, r.partition_id,
       CASE WHEN err IS NULL THEN 'backup' ELSE 'reject' END AS action, err AS error
FROM (SELECT r.*, CASE WHEN NOT coalesce(l.table_exists, false) THEN 'NotFound: table does not exist'
            WHEN l.is_daily_partitioned AND r.partition_id IS NULL
              THEN 'Partition id is required for a day-partitioned table'
            WHEN NOT l.is_schema_defined THEN 'ParameterValidation: This table is without schema'
            WHEN l.is_external_or_view THEN 'ParameterValidation: This table is external or view type' END AS err
      FROM tables r LEFT JOIN live l ON l.project_id = r.project_id AND l.dataset_id = r.dataset_id
        AND l.table_id = r.table_id) r""", ("tables", "live"))
def q5(spark, sf):
    """Q5: an on-demand request for every table entity."""
    v = TestViews.of(spark, sf)
    req = v.tables.select("project_id", "dataset_id", "table_id", "partition_id")
    return B.on_demand_backup(v.live, req)


ON_DEMAND_SQL = f"""
SELECT r.project_id, r.dataset_id, r.table_id, r.partition_id, true AS needs_backup, l.num_bytes AS unit_num_bytes,
  replace(CAST(year({AS_OF}) AS VARCHAR) || '_' || lpad(CAST(weekofyear({AS_OF}) AS VARCHAR), 2, '0')
          || '_' || coalesce(l.location, 'US') || '_' || r.project_id, '-', '_') AS target_dataset_id,
  strftime({AS_OF}, '%Y%m%d_%H%M%S') || '_' || replace(r.project_id, '-', '_') || '_' || r.dataset_id
    || '_' || r.table_id || coalesce('_partition_' || r.partition_id, '') AS target_table_id
FROM (SELECT project_id, dataset_id, table_id, partition_id FROM tables
      UNION SELECT project_id, dataset_id, table_id, NULL FROM live) r
JOIN live l ON l.project_id = r.project_id AND l.dataset_id = r.dataset_id AND l.table_id = r.table_id
WHERE l.table_exists AND NOT (l.is_daily_partitioned AND r.partition_id IS NULL) AND l.is_schema_defined AND NOT l.is_external_or_view"""


@register("q5_on_demand_run", f"""
SELECT project_id, dataset_id AS source_dataset_id, table_id AS source_table_id, partition_id, start_time AS last_modified,
       end_time AS created, target_dataset_id AS dataset_id, target_table_id AS table_id, unit_num_bytes AS num_bytes
FROM ({_results_sql(ON_DEMAND_SQL)}) WHERE state = 'DONE' AND error_reason IS NULL""", ("tables", "live"))
def q5_run(spark, sf):
    """Q5 as a whole: requests for every table entity and every whole live table → P3 → copies → M1 → M2, new records with their tables."""
    v = TestViews.of(spark, sf)
    known = v.tables.select("project_id", "dataset_id", "table_id", "partition_id")
    whole = v.live.select("project_id", "dataset_id", "table_id", F.lit(None).cast("string").alias("partition_id"))
    _, todo = on_demand_plan(v.live, known.unionByName(whole).distinct(), CFG)
    size = v.live.select("project_id", "dataset_id", "table_id", F.col("num_bytes").alias("unit_num_bytes"))
    todo = written(todo.join(size, ["project_id", "dataset_id", "table_id"]), "on-demand")
    res = written(_results(v, todo.withColumn("needs_backup", F.lit(True))), "copy-results")
    copies = res.select(F.col("configuration.copy.destinationTable.datasetId").alias("dataset_id"),
                        F.col("configuration.copy.destinationTable.tableId").alias("table_id"), F.col("copied_bytes").alias("num_bytes"))
    tables = written(on_demand_entities(v.tables, todo, CFG), "entities")
    t = tables.select(F.col("id").alias("parent_id"), "project_id", F.col("dataset_id").alias("source_dataset_id"),
                      F.col("table_id").alias("source_table_id"), "partition_id")
    return B.record_backups(v.backups, res, tables, copies).join(t, "parent_id").select(
        "project_id", "source_dataset_id", "source_table_id", "partition_id", "last_modified", "created", "dataset_id", "table_id", "num_bytes")


@register("f14_copy_errors_message", f"""
SELECT target_table_id AS tableId,
       'Copy job finished with errors: ' || error_reason || ':copy failed' AS message
FROM ({RESULTS_SQL}) WHERE error_reason IS NOT NULL""", PLAN_NEEDS)
def f14(spark, sf):
    v = TestViews.of(spark, sf)
    r = _results(v, _plan(v)).filter(F.col("status.errors").isNotNull())
    return r.select(F.col("configuration.copy.destinationTable.tableId").alias("tableId"),
                    U.copy_errors_message("status.errors").alias("message"))
