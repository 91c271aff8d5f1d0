"""Registered SLI queries: S5, S6, W1–W5, J2–J6, A1, A2, P11–P18, Q11–Q16."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepsake.operators import sli as S
from keepsake.plans import sli as PS
from keepsake.registry import register
from keepsake.session import checkpoint_root
from keepsake.sources import sli_sink as K
from keepsake.sources.testviews import AS_OF, TestViews, default_config

CFG = default_config()
EPOCH_SQL = "TIMESTAMP '1970-01-01 00:00:00'"
# Three runs of the SLI jobs: yesterday, today at midnight, today at 06:00.
RUNS = (AS_OF - dt.timedelta(days=1), AS_OF, AS_OF + dt.timedelta(hours=6))


def T(t: dt.datetime) -> str:
    return f"TIMESTAMP '{t:%Y-%m-%d %H:%M:%S}'"


def D(t: dt.datetime) -> str:
    return f"DATE '{t:%Y-%m-%d}'"


ORDER_TIES = "snapshotTime DESC, lastModifiedTime DESC, creationTime DESC, numRows DESC, numBytes DESC"


# ------------------------------------------------------------------ SQL builders
def sql_modified(x: int, t: dt.datetime) -> str:
    d = S.latency_days(x)
    lo, hi = t - dt.timedelta(days=d + 2), min(t, t - dt.timedelta(days=d - 2))
    cut = t - dt.timedelta(days=d)
    win = f"CAST(snapshot_date AS TIMESTAMP) BETWEEN {T(lo)} AND {T(hi)} AND lastModifiedTime <= {T(cut)}"
    cols = "projectId, datasetId, tableId, partitionId, creationTime, lastModifiedTime, numRows"
    return f"""
SELECT {cols} FROM (
  SELECT *, 'None' AS partitionId, row_number() OVER (
    PARTITION BY projectId, datasetId, tableId ORDER BY {ORDER_TIES}) AS rn
  FROM census_tables WHERE {win} AND tp_type IS NULL AND type = 'TABLE') WHERE rn = 1
UNION ALL
SELECT {cols} FROM (
  SELECT *, row_number() OVER (
    PARTITION BY projectId, datasetId, tableId, partitionId ORDER BY {ORDER_TIES}) AS rn
  FROM census_partitions WHERE {win}) WHERE rn = 1"""


def sql_latency(x: int, t: dt.datetime) -> str:
    d = S.latency_days(x)
    cut = t - dt.timedelta(days=d)
    return f"""
SELECT c.projectId, c.datasetId, c.tableId, c.partitionId, c.creationTime, c.lastModifiedTime,
       coalesce(b.backup_created, {EPOCH_SQL}) AS backup_created,
       coalesce(b.backup_last_modified, {EPOCH_SQL}) AS backup_last_modified
FROM ({sql_modified(x, t)}) c
LEFT JOIN last_avail_x b ON c.projectId = b.source_project_id AND c.datasetId = b.source_dataset_id
  AND c.tableId = b.source_table_id AND c.partitionId = b.source_partition_id
WHERE c.projectId NOT IN ('backup', 'restoration') AND c.partitionId <> '__UNPARTITIONED__'
  AND c.numRows <> 0 AND coalesce(b.backup_created, {EPOCH_SQL}) < {T(cut)}
  AND coalesce(b.backup_last_modified, {EPOCH_SQL}) < c.lastModifiedTime"""


LAT_NEEDS = ("census_tables", "census_partitions", "last_avail_x")


def sql_quality_sources(t: dt.datetime) -> str:
    day = dt.datetime.combine(t.date(), dt.time(0))
    win = (f"CAST(snapshot_date AS TIMESTAMP) BETWEEN {T(day - dt.timedelta(days=3))} AND {T(day)}")
    age = f"date_diff('day', CAST(lastModifiedTime AS DATE), {D(t)}) >= 3"
    cols = "projectId, datasetId, tableId, partitionId, lastModifiedTime, numBytes, numRows"
    return f"""
SELECT {cols} FROM (
  SELECT *, 'None' AS partitionId, row_number() OVER (
    PARTITION BY projectId, datasetId, tableId ORDER BY {ORDER_TIES}) AS rn
  FROM census_tables WHERE {win} AND tp_type IS NULL AND type = 'TABLE')
WHERE rn = 1 AND {age} AND projectId NOT IN ('backup', 'restoration')
UNION ALL
SELECT {cols} FROM (
  SELECT *, row_number() OVER (
    PARTITION BY projectId, datasetId, tableId, partitionId ORDER BY {ORDER_TIES}) AS rn
  FROM census_partitions WHERE {win})
WHERE rn = 1 AND {age} AND projectId <> 'backup'"""


SQL_IN_CENSUS = """
SELECT l.source_project_id, l.source_dataset_id, l.source_table_id, l.source_partition_id,
       c.lastModifiedTime AS backup_last_modified,
       l.backup_last_modified AS backup_entity_last_modified_time,
       l.backup_num_bytes AS backup_entity_num_bytes, l.backup_dataset_id, l.backup_table_id,
       c.numBytes AS backup_num_bytes, c.numRows AS backup_num_rows
FROM last_avail_x l LEFT JOIN (SELECT * FROM census_copies WHERE projectId = 'backup') c
  ON c.datasetId = l.backup_dataset_id AND c.tableId = l.backup_table_id"""


def sql_quality(t: dt.datetime) -> str:
    return f"""
SELECT s.projectId AS source_project_id, s.datasetId AS source_dataset_id,
       s.tableId AS source_table_id, s.partitionId AS source_partition_id,
       c.backup_dataset_id, c.backup_table_id, s.lastModifiedTime AS source_last_modified,
       c.backup_last_modified, c.backup_entity_last_modified_time AS backup_entity_last_modified,
       s.numBytes AS source_num_bytes, c.backup_num_bytes, c.backup_entity_num_bytes,
       s.numRows AS source_num_rows, c.backup_num_rows
FROM ({sql_quality_sources(t)}) s JOIN ({SQL_IN_CENSUS}) c
  ON s.projectId = c.source_project_id AND s.datasetId = c.source_dataset_id
 AND s.tableId = c.source_table_id AND s.partitionId = c.source_partition_id
WHERE date_diff('day', CAST(c.backup_entity_last_modified_time AS DATE), {D(t)}) >= 3
  AND c.backup_table_id IS NOT NULL AND c.source_partition_id <> '__UNPARTITIONED__'
  AND (s.numBytes <> c.backup_num_bytes OR s.numRows <> c.backup_num_rows OR c.backup_num_bytes IS NULL)
  AND s.numRows <> 0"""


QUAL_NEEDS = ("census_tables", "census_partitions", "last_avail_x", "census_copies")

LAT_COLS = ("snapshotTime, projectId, datasetId, tableId, partitionId, creationTime, lastModifiedTime, "
            "backupCreated, backupLastModified, xDays")
QUAL_COLS = ("snapshotTime, projectId, datasetId, tableId, partitionId, backupDatasetId, backupTableId, "
             "lastModifiedTime, backupLastModifiedTime, backupEntityLastModifiedTime, numBytes, "
             "backupNumBytes, backupEntityNumBytes, numRows, backupNumRows")


def sql_latency_typed(x: int, t: dt.datetime) -> str:
    return f"""
SELECT {T(t)} AS snapshotTime, projectId, datasetId, tableId, partitionId, creationTime,
       lastModifiedTime, backup_created AS backupCreated, backup_last_modified AS backupLastModified,
       '{x}' AS xDays
FROM ({sql_latency(x, t)})"""


# lookups of the partitions of every 17th table fail; so do those of some copies (by size)
LISTED = """(SELECT project_id, dataset_id, table_id, partition_id,
  CASE WHEN CAST(substr(table_id, 2) AS INTEGER) % 17 <> 0 THEN last_modified END AS last_modified,
  CASE WHEN CAST(substr(table_id, 2) AS INTEGER) % 17 = 0 THEN 'error' ELSE 'found' END AS lookup_status FROM partitions)"""
LIVE_JOIN = f"""
LEFT JOIN live l ON l.project_id = s.projectId AND l.dataset_id = s.datasetId AND l.table_id = s.tableId
LEFT JOIN {LISTED} p ON p.project_id = s.projectId AND p.dataset_id = s.datasetId
  AND p.table_id = s.tableId AND p.partition_id = {{part}}"""
EXISTS = """coalesce(l.table_exists, false) AND coalesce(l.is_schema_defined, false)
  AND ({part} IS NULL OR NOT coalesce(l.has_time_partitioning, false) OR p.partition_id IS NOT NULL)"""
ERR = "(coalesce(l.lookup_status = 'error', false) OR coalesce(p.lookup_status = 'error', false))"
COPY_ERR = "coalesce(lc.num_bytes % 13 = 0, false)"


def sql_confirm_latency(x: int, t: dt.datetime) -> str:
    part = "s.partitionId"
    return f"""
SELECT s.* FROM ({sql_latency_typed(x, t)}) s {LIVE_JOIN.format(part=part)}
WHERE {ERR} OR ({EXISTS.format(part=part)}
  AND NOT coalesce(l.creation_time > s.creationTime, false)
  AND NOT (s.backupCreated > {EPOCH_SQL} AND coalesce(l.num_rows = 0, false)))"""


def sql_quality_typed(t: dt.datetime) -> str:
    return f"""
SELECT {T(t)} AS snapshotTime, source_project_id AS projectId, source_dataset_id AS datasetId,
       source_table_id AS tableId, source_partition_id AS partitionId,
       backup_dataset_id AS backupDatasetId, backup_table_id AS backupTableId,
       source_last_modified AS lastModifiedTime, backup_last_modified AS backupLastModifiedTime,
       backup_entity_last_modified AS backupEntityLastModifiedTime, source_num_bytes AS numBytes,
       backup_num_bytes AS backupNumBytes, backup_entity_num_bytes AS backupEntityNumBytes,
       source_num_rows AS numRows, backup_num_rows AS backupNumRows
FROM ({sql_quality(t)})"""


def sql_confirm_quality(t: dt.datetime) -> str:
    part = "s._part"
    return f"""
SELECT s.* EXCLUDE (_part) FROM (
  SELECT *, CASE WHEN partitionId <> 'None' THEN partitionId END AS _part
  FROM ({sql_quality_typed(t)})) s {LIVE_JOIN.format(part=part)}
LEFT JOIN live_copies lc ON lc.dataset_id = s.backupDatasetId AND lc.table_id = s.backupTableId
WHERE {ERR} OR {COPY_ERR} OR ({EXISTS.format(part=part)}
  AND NOT coalesce(CASE WHEN {part} IS NOT NULL AND coalesce(l.has_time_partitioning, false)
                        THEN p.last_modified ELSE l.last_modified_time END > s.lastModifiedTime, false)
  AND NOT (lc.table_id IS NOT NULL AND s.backupLastModifiedTime IS NULL
           AND coalesce(lc.num_bytes = s.backupEntityNumBytes, false)))"""


def sql_latency_run(t: dt.datetime) -> str:
    parts = []
    for x in (4, 5, 7):
        parts.append(f"""SELECT {T(t)} AS snapshotTime, 'SNAPSHOT_MARKER' AS projectId,
  'SNAPSHOT_MARKER' AS datasetId, 'SNAPSHOT_MARKER' AS tableId, 'SNAPSHOT_MARKER' AS partitionId,
  {EPOCH_SQL} AS creationTime, {EPOCH_SQL} AS lastModifiedTime, {EPOCH_SQL} AS backupCreated,
  {EPOCH_SQL} AS backupLastModified, '{x}' AS xDays""")
        parts.append(f"SELECT {LAT_COLS} FROM ({sql_confirm_latency(x, t)})")
    return "\nUNION ALL\n".join(parts)


def sql_quality_run(t: dt.datetime) -> str:
    marker = (f"SELECT {T(t)} AS snapshotTime, 'SNAPSHOT_MARKER' AS projectId, 'SNAPSHOT_MARKER' AS datasetId, "
              f"'SNAPSHOT_MARKER' AS tableId, 'SNAPSHOT_MARKER' AS partitionId, "
              f"'SNAPSHOT_MARKER' AS backupDatasetId, 'SNAPSHOT_MARKER' AS backupTableId, "
              f"{EPOCH_SQL} AS lastModifiedTime, {EPOCH_SQL} AS backupLastModifiedTime, "
              f"{EPOCH_SQL} AS backupEntityLastModifiedTime, CAST(0 AS BIGINT) AS numBytes, "
              f"CAST(0 AS BIGINT) AS backupNumBytes, CAST(0 AS BIGINT) AS backupEntityNumBytes, "
              f"CAST(0 AS BIGINT) AS numRows, CAST(0 AS BIGINT) AS backupNumRows")
    return f"{marker}\nUNION ALL\nSELECT {QUAL_COLS} FROM ({sql_confirm_quality(t)})"


RUN_NEEDS = LAT_NEEDS + ("census_copies", "live", "partitions", "live_copies")


def sql_history(kind: str) -> str:
    run = sql_latency_run if kind == "latency" else sql_quality_run
    return "\nUNION ALL\n".join(f"SELECT *, {D(t)} AS ingest_date FROM ({run(t)})" for t in RUNS)


# ------------------------------------------------------------------ Spark side
def _listed(v: TestViews) -> DataFrame:
    """Partition lookups, of which those of every 17th table failed."""
    failed = F.substring("table_id", 2, 20).cast("int") % 17 == 0
    return v.partitions.select("project_id", "dataset_id", "table_id", "partition_id",
                               F.when(~failed, F.col("last_modified")).alias("last_modified"),
                               F.when(failed, "error").otherwise("found").alias("lookup_status"))


def _copies(v: TestViews) -> DataFrame:
    """Live copies, some of whose lookups fail."""
    return v.live_copies.withColumn("lookup_status", F.when(F.col("num_bytes") % 13 == 0, "error").otherwise("found"))


def _la(v: TestViews) -> DataFrame:
    return PS.last_available_backups(v.tables, v.backups)


def _latency(v: TestViews, x: int, t: dt.datetime = AS_OF) -> DataFrame:
    return PS.latency_sli(v.census_tables, v.census_partitions, _la(v), x, t, CFG)


def _latency_run(spark, v: TestViews, t: dt.datetime) -> DataFrame:
    return PS.latency_run(spark, v.census_tables, v.census_partitions, _la(v), v.live, _listed(v),
                          t, CFG)


def _quality_run(spark, v: TestViews, t: dt.datetime) -> DataFrame:
    return PS.quality_run(spark, v.census_tables, v.census_partitions, _la(v), v.census_copies,
                          v.live, _listed(v), _copies(v), t, CFG)


def _history(spark, v: TestViews, kind: str) -> DataFrame:
    """The SLI history that three runs wrote (S10), which the current views (Q15) read: written once for each folder of tables."""
    paths = v.__dict__.setdefault("_histories", {})
    if kind not in paths:
        path = f"{checkpoint_root(spark)}/sli-{kind}-{uuid.uuid4().hex}"
        run = _latency_run if kind == "latency" else _quality_run
        for t in RUNS:
            K.append_sli(K.conform(run(spark, v, t), kind), path, t)
        paths[kind] = path
    return K.read_sli(spark, paths[kind], kind)


T_LO, T_HI = AS_OF - dt.timedelta(days=5), AS_OF - dt.timedelta(days=1)


@register("s5_census_tables", f"""
SELECT projectId, datasetId, tableId, snapshotTime, lastModifiedTime, numRows, 'None' AS partitionId
FROM census_tables WHERE CAST(snapshot_date AS TIMESTAMP) BETWEEN {T(T_LO)} AND {T(T_HI)}
  AND type = 'TABLE' AND tp_type IS NULL""", ("census_tables",))
def s5(spark, sf):
    v = TestViews.of(spark, sf)
    return S.census_tables_scan(v.census_tables, T_LO, T_HI).select(
        "projectId", "datasetId", "tableId", "snapshotTime", "lastModifiedTime", "numRows", "partitionId")


@register("s6_census_partitions", f"""
SELECT projectId, datasetId, tableId, partitionId, snapshotTime, lastModifiedTime, numRows
FROM census_partitions WHERE CAST(snapshot_date AS TIMESTAMP) BETWEEN {T(T_LO)} AND {T(T_HI)}""",
          ("census_partitions",))
def s6(spark, sf):
    v = TestViews.of(spark, sf)
    return S.census_partitions_scan(v.census_partitions, T_LO, T_HI).select(
        "projectId", "datasetId", "tableId", "partitionId", "snapshotTime", "lastModifiedTime", "numRows")


@register("w1_latest_table_snapshot", f"""
SELECT projectId, datasetId, tableId, snapshotTime, lastModifiedTime, creationTime, numRows, numBytes
FROM (SELECT *, row_number() OVER (PARTITION BY projectId, datasetId, tableId ORDER BY {ORDER_TIES}) rn
      FROM census_tables WHERE lastModifiedTime <= {T(AS_OF - dt.timedelta(days=3))}) WHERE rn = 1""",
          ("census_tables",))
def w1(spark, sf):
    v = TestViews.of(spark, sf)
    df = v.census_tables.filter(F.col("lastModifiedTime") <= F.lit("2024-01-27").cast("timestamp_ntz"))
    return S.latest_per_table(df.select("projectId", "datasetId", "tableId", "snapshotTime",
                                        "lastModifiedTime", "creationTime", "numRows", "numBytes"))


@register("w2_latest_partition_snapshot", f"""
SELECT projectId, datasetId, tableId, partitionId, snapshotTime, lastModifiedTime, creationTime,
       numRows, numBytes
FROM (SELECT *, row_number() OVER (PARTITION BY projectId, datasetId, tableId, partitionId
                                   ORDER BY {ORDER_TIES}) rn
      FROM census_partitions) WHERE rn = 1""", ("census_partitions",))
def w2(spark, sf):
    v = TestViews.of(spark, sf)
    return S.latest_per_partition(v.census_partitions.select(
        "projectId", "datasetId", "tableId", "partitionId", "snapshotTime", "lastModifiedTime",
        "creationTime", "numRows", "numBytes"))


@register("w3_quality_sources", sql_quality_sources(AS_OF), ("census_tables", "census_partitions"))
def w3(spark, sf):
    v = TestViews.of(spark, sf)
    return S.quality_sources(v.census_tables, v.census_partitions, AS_OF, CFG)


for _x in (0, 4, 5, 7):
    def _mk_mod(x):
        def q(spark, sf):
            v = TestViews.of(spark, sf)
            return S.modified_before(v.census_tables, v.census_partitions, x, AS_OF)
        return q

    def _mk_lat(x):
        def q(spark, sf):
            return _latency(TestViews.of(spark, sf), x)
        return q

    register(f"q11_modified_before_{_x}", sql_modified(_x, AS_OF),
             ("census_tables", "census_partitions"))(_mk_mod(_x))
    register(f"q11_latency_sli_{_x}", sql_latency(_x, AS_OF), LAT_NEEDS)(_mk_lat(_x))


@register("j2_census_last_backup", f"""
SELECT c.*, coalesce(b.backup_created, {EPOCH_SQL}) AS backup_created,
       coalesce(b.backup_last_modified, {EPOCH_SQL}) AS backup_last_modified
FROM ({sql_modified(0, AS_OF)}) c LEFT JOIN last_avail_x b
  ON c.projectId = b.source_project_id AND c.datasetId = b.source_dataset_id
 AND c.tableId = b.source_table_id AND c.partitionId = b.source_partition_id""", LAT_NEEDS)
def j2(spark, sf):
    v = TestViews.of(spark, sf)
    m = S.modified_before(v.census_tables, v.census_partitions, 0, AS_OF)
    lb = _la(v)
    j = m.join(lb, (m.projectId == lb.source_project_id) & (m.datasetId == lb.source_dataset_id)
               & (m.tableId == lb.source_table_id) & (m.partitionId == lb.source_partition_id), "left")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return j.select(*[m[c] for c in m.columns],
                    F.coalesce(lb.backup_created, epoch).alias("backup_created"),
                    F.coalesce(lb.backup_last_modified, epoch).alias("backup_last_modified"))


@register("j3_last_backup_in_census", SQL_IN_CENSUS, ("last_avail_x", "census_copies"))
def j3(spark, sf):
    v = TestViews.of(spark, sf)
    return S.last_backup_in_census(_la(v), v.census_copies, CFG.backup_project)


@register("q13_quality_sli", sql_quality(AS_OF), QUAL_NEEDS)
def q13(spark, sf):
    v = TestViews.of(spark, sf)
    return PS.quality_sli(v.census_tables, v.census_partitions, _la(v), v.census_copies, AS_OF, CFG)


_ORPH = f"""
SELECT tableId, datasetId, projectId FROM census_copies
WHERE projectId = 'backup' AND tableId LIKE '20%'
  AND lastModifiedTime < CAST({D(AS_OF)} - INTERVAL 7 DAY AS TIMESTAMP)"""
SQL_J5 = _ORPH + f""" AND tableId IN (SELECT backup_table_id FROM all_backups_x
  WHERE backup_deleted IS NOT NULL AND backup_deleted < CAST({D(AS_OF)} - INTERVAL 7 DAY AS TIMESTAMP))"""
SQL_J6 = _ORPH + """ AND NOT EXISTS (SELECT 1 FROM all_backups_x a WHERE a.backup_table_id = census_copies.tableId)"""


@register("j5_orphans_deleted", SQL_J5, ("census_copies", "all_backups_x"))
def j5(spark, sf):
    v = TestViews.of(spark, sf)
    return S.orphans_deleted(v.census_copies, PS.all_backups(v.tables, v.backups), AS_OF, CFG.backup_project)


@register("j6_orphans_unrecorded", SQL_J6, ("census_copies", "all_backups_x"))
def j6(spark, sf):
    v = TestViews.of(spark, sf)
    return S.orphans_unrecorded(v.census_copies, PS.all_backups(v.tables, v.backups), AS_OF,
                                CFG.backup_project)


@register("q16_orphaned_backups", f"{SQL_J5}\nUNION ALL\n{SQL_J6}", ("census_copies", "all_backups_x"))
def q16(spark, sf):
    v = TestViews.of(spark, sf)
    return PS.orphaned_backups(v.census_copies, v.tables, v.backups, AS_OF, CFG)


@register("p17_confirm_latency", sql_confirm_latency(4, AS_OF), RUN_NEEDS)
def p17(spark, sf):
    v = TestViews.of(spark, sf)
    rows = K.typed_latency_rows(_latency(v, 4), AS_OF, 4)
    return S.confirm_latency(rows, v.live, _listed(v))


def _predicate_frame(v: TestViews):
    rows = K.typed_latency_rows(_latency(v, 0), AS_OF, 0)
    return S.with_partition(S.with_live(rows, v.live), _listed(v), "partitionId")


_PRED_SQL = f"""
SELECT s.projectId, s.datasetId, s.tableId, s.partitionId, {{expr}} AS {{name}}
FROM ({sql_latency_typed(0, AS_OF)}) s {LIVE_JOIN.format(part="s.partitionId")}"""

_PREDICATES = {
    "p11_is_recreated": ("coalesce(l.creation_time > s.creationTime, false)", S.is_recreated),
    "p12_has_any_backup": (f"s.backupCreated > {EPOCH_SQL}", S.has_any_backup),
    "p13_is_source_empty": ("coalesce(l.num_rows = 0, false)", S.is_source_empty),
    "p14_source_exists": (EXISTS.format(part="s.partitionId"), lambda: S.source_exists("partitionId")),
    "p15_is_newer": ("coalesce(CASE WHEN s.partitionId IS NOT NULL AND coalesce(l.has_time_partitioning, false) "
                     "THEN p.last_modified ELSE l.last_modified_time END > s.lastModifiedTime, false)",
                     lambda: S.is_newer("partitionId")),
}

for _name, (_expr, _col) in _PREDICATES.items():
    def _mk_pred(name, col):
        def q(spark, sf):
            j = _predicate_frame(TestViews.of(spark, sf))
            return j.select("projectId", "datasetId", "tableId", "partitionId", col().alias(name))
        return q
    register(_name, _PRED_SQL.format(expr=_expr, name=_name), RUN_NEEDS)(_mk_pred(_name, _col))


@register("p16_copy_not_in_census", f"""
SELECT s.projectId, s.datasetId, s.tableId, s.backupTableId,
       lc.table_id IS NOT NULL AND s.backupLastModifiedTime IS NULL
       AND coalesce(lc.num_bytes = s.backupEntityNumBytes, false) AS p16_copy_not_in_census
FROM ({sql_quality_typed(AS_OF)}) s
LEFT JOIN live_copies lc ON lc.dataset_id = s.backupDatasetId AND lc.table_id = s.backupTableId""",
          QUAL_NEEDS + ("live_copies",))
def p16(spark, sf):
    v = TestViews.of(spark, sf)
    rows = K.typed_quality_rows(PS.quality_sli(v.census_tables, v.census_partitions, _la(v),
                                               v.census_copies, AS_OF, CFG), AS_OF)
    lc = v.live_copies.select(F.col("dataset_id").alias("lc_dataset_id"),
                              F.col("table_id").alias("lc_table_id"), F.lit(True).alias("lc_exists"),
                              F.col("num_bytes").alias("lc_num_bytes"))
    j = rows.join(lc, (rows.backupDatasetId == lc.lc_dataset_id) & (rows.backupTableId == lc.lc_table_id),
                  "left")
    return j.select("projectId", "datasetId", "tableId", "backupTableId",
                    S.copy_not_in_census().alias("p16_copy_not_in_census"))


@register("p18_confirm_quality", sql_confirm_quality(AS_OF), RUN_NEEDS)
def p18(spark, sf):
    v = TestViews.of(spark, sf)
    rows = K.typed_quality_rows(PS.quality_sli(v.census_tables, v.census_partitions, _la(v),
                                               v.census_copies, AS_OF, CFG), AS_OF)
    return S.confirm_quality(rows, v.live, _listed(v), _copies(v))


@register("q12_latency_run", sql_latency_run(AS_OF), RUN_NEEDS)
def q12(spark, sf):
    return _latency_run(spark, TestViews.of(spark, sf), AS_OF)


@register("q14_quality_run", sql_quality_run(AS_OF), RUN_NEEDS)
def q14(spark, sf):
    return _quality_run(spark, TestViews.of(spark, sf), AS_OF)


@register("w4_newest_latency_snapshot", f"""
SELECT {LAT_COLS} FROM (
  SELECT *, dense_rank() OVER (PARTITION BY xDays ORDER BY snapshotTime DESC) AS rk
  FROM ({sql_history('latency')}) WHERE ingest_date = {D(AS_OF)})
WHERE rk = 1 AND projectId <> 'SNAPSHOT_MARKER'""", RUN_NEEDS)
def w4(spark, sf):
    v = TestViews.of(spark, sf)
    return S.newest_latency_snapshot(_history(spark, v, "latency"), AS_OF)


@register("w5_newest_quality_snapshot", f"""
SELECT {QUAL_COLS} FROM (
  SELECT *, dense_rank() OVER (ORDER BY snapshotTime DESC) AS rk
  FROM ({sql_history('quality')}) WHERE ingest_date = {D(AS_OF)})
WHERE rk = 1 AND projectId <> 'SNAPSHOT_MARKER'""", RUN_NEEDS)
def w5(spark, sf):
    v = TestViews.of(spark, sf)
    return S.newest_quality_snapshot(_history(spark, v, "quality"), AS_OF)


@register("a1_latency_by_count", f"""
SELECT CAST(xDays AS INTEGER) AS xDays, count(*) AS count FROM (
  SELECT *, dense_rank() OVER (PARTITION BY xDays ORDER BY snapshotTime DESC) AS rk
  FROM ({sql_history('latency')}) WHERE ingest_date = {D(AS_OF)})
WHERE rk = 1 AND projectId <> 'SNAPSHOT_MARKER' GROUP BY 1""", RUN_NEEDS)
def a1(spark, sf):
    v = TestViews.of(spark, sf)
    return S.latency_by_count(S.newest_latency_snapshot(_history(spark, v, "latency"), AS_OF))


@register("a2_last_snapshot_time", f"""
SELECT 'latency' AS kind, max(snapshotTime) AS snapshotTime FROM ({sql_history('latency')})
WHERE ingest_date = {D(AS_OF)}
UNION ALL
SELECT 'quality', max(snapshotTime) FROM ({sql_history('quality')}) WHERE ingest_date = {D(AS_OF)}""",
          RUN_NEEDS)
def a2(spark, sf):
    v = TestViews.of(spark, sf)
    lat = S.last_snapshot_time(_history(spark, v, "latency"), AS_OF).select(F.lit("latency").alias("kind"),
                                                                           "snapshotTime")
    qual = S.last_snapshot_time(_history(spark, v, "quality"), AS_OF).select(F.lit("quality").alias("kind"),
                                                                            "snapshotTime")
    return lat.unionByName(qual)


@register("s16_typed_sli_rows", sql_latency_typed(4, AS_OF), LAT_NEEDS)
def s16(spark, sf):
    return K.typed_latency_rows(_latency(TestViews.of(spark, sf), 4), AS_OF, 4)
