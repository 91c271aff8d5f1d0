"""Registered restore queries: P10, P19, P20, J7, J8, U-4, A3, A4, A6, A7,
M3, M5, S15, U3, U4, U6, Q6–Q8, Q10."""

from __future__ import annotations


from pyspark.sql import functions as F

from keepsake.checks.oracle import AS_OF
from keepsake.functions import columns as U
from keepsake.operators import restore as RS
from keepsake.plans import restore as PR
from keepsake.registry import register
from keepsake.sources.testviews import AS_OF as AS_OF_DT, BACKUP_PROJECT, TestViews

EOD = "INTERVAL '23 hours 59 minutes 59 seconds'"


# ------------------------------------------------------------- request frames
def dataset_requests(v: TestViews):
    d = F.col("dataset_id")
    return (v.tables.select("project_id", "dataset_id").distinct()
            .select(F.concat_ws(".", "project_id", "dataset_id").alias("request_id"), "project_id", "dataset_id",
                    F.when(d == "d1", F.col("project_id")).otherwise(F.lit("restoration")).alias("target_project_id"),
                    d.alias("target_dataset_id"),
                    F.when(d == "d0", 3).when(d == "d1", 0).cast("int").alias("max_partition_days")))


DS_REQ_SQL = """
SELECT project_id || '.' || dataset_id AS request_id, project_id, dataset_id,
       CASE WHEN dataset_id = 'd1' THEN project_id ELSE 'restoration' END AS target_project_id,
       dataset_id AS target_dataset_id,
       CAST(CASE WHEN dataset_id = 'd0' THEN 3 WHEN dataset_id = 'd1' THEN 0 END AS INTEGER) AS max_partition_days
FROM (SELECT DISTINCT project_id, dataset_id FROM tables)"""


def existing_datasets(v: TestViews):
    return v.live.groupBy("project_id", "dataset_id").agg(F.min("location").alias("location"))


def backup_datasets(v: TestViews):
    return (v.backups.select("dataset_id").distinct()
            .select("dataset_id", F.when(F.col("dataset_id") == "bk1", "EU").otherwise("US").alias("location")))


DATASETS_SQL = "SELECT project_id, dataset_id, min(location) AS location FROM live GROUP BY 1, 2"
BK_DATASETS_SQL = ("SELECT dataset_id, CASE WHEN dataset_id = 'bk1' THEN 'EU' ELSE 'US' END AS location "
                   "FROM (SELECT DISTINCT dataset_id FROM backups)")


def table_requests(v: TestViews):
    i = F.col("id")
    text = (F.when(i % 10 == 0, F.lit(None).cast("string")).when(i % 17 == 0, "not-a-date")
            .otherwise(F.date_format(F.date_sub(F.lit(AS_OF_DT.date()), (i % 60).cast("int")), "yyyy-MM-dd")))
    return v.tables.select(i.alias("request_id"), "project_id", "dataset_id",
                           F.concat("table_id", F.when(i % 13 == 0, "x").otherwise("")).alias("table_id"),
                           "partition_id", text.alias("date_text"))


TABLE_REQ_SQL = f"""
SELECT id AS request_id, project_id, dataset_id,
       table_id || CASE WHEN id % 13 = 0 THEN 'x' ELSE '' END AS table_id, partition_id,
       CASE WHEN id % 10 = 0 THEN NULL WHEN id % 17 = 0 THEN 'not-a-date'
            ELSE strftime({AS_OF} - to_days(CAST(id % 60 AS INTEGER)), '%Y-%m-%d') END AS date_text
FROM tables"""


def _j7(v: TestViews):
    r = table_requests(v)
    r = r.withColumn("not_newer_than", RS.request_time(F.col("date_text"), AS_OF_DT))
    out = RS.as_of_backup(r, v.tables, v.backups)
    date_err = F.when(F.col("date_text").isNotNull() & F.col("not_newer_than").isNull(), RS.WRONG_DATE)
    return out.withColumn("error", F.coalesce(date_err, F.col("error")))


J7_SQL = f"""
SELECT r.*, t.id AS entity_id, b.backup_created, b.backup_id, b.backup_dataset_id, b.backup_table_id,
  CASE WHEN r.date_text IS NOT NULL AND r.not_newer_than IS NULL
         THEN 'Wrong date value format for parameter ''restoration_date''. Should be ''YYYY-mm-dd'''
       WHEN t.id IS NULL THEN 'Table not found in datastore: ' || r.project_id || ':' || r.dataset_id || '.' || r.table_id || coalesce('$' || r.partition_id, '')
       WHEN b.backup_id IS NULL THEN 'Backup not found for ' || r.project_id || ':' || r.dataset_id || '.' || r.table_id || coalesce('$' || r.partition_id, '') || ' before '
         || strftime(r.not_newer_than, '%Y-%m-%d %H:%M:%S') END AS error
FROM (SELECT *, CASE WHEN date_text IS NULL THEN {AS_OF}
                     ELSE CAST(TRY_STRPTIME(date_text, '%Y-%m-%d') AS TIMESTAMP) + {EOD} END AS not_newer_than
      FROM ({TABLE_REQ_SQL})) r
LEFT JOIN tables t ON t.project_id = r.project_id AND t.dataset_id = r.dataset_id AND t.table_id = r.table_id
  AND t.partition_id IS NOT DISTINCT FROM r.partition_id
LEFT JOIN (
  SELECT request_id, arg_max(created, (created, id)) AS backup_created, arg_max(id, (created, id)) AS backup_id,
         arg_max(dataset_id, (created, id)) AS backup_dataset_id, arg_max(table_id, (created, id)) AS backup_table_id
  FROM (SELECT rr.request_id, bb.* FROM (
          SELECT r2.request_id, t2.id AS entity_id,
                 CASE WHEN r2.date_text IS NULL THEN {AS_OF}
                      ELSE CAST(TRY_STRPTIME(r2.date_text, '%Y-%m-%d') AS TIMESTAMP) + {EOD} END AS nnt
          FROM ({TABLE_REQ_SQL}) r2 JOIN tables t2 ON t2.project_id = r2.project_id
            AND t2.dataset_id = r2.dataset_id AND t2.table_id = r2.table_id
            AND t2.partition_id IS NOT DISTINCT FROM r2.partition_id) rr
        JOIN backups bb ON bb.parent_id = rr.entity_id AND bb.deleted IS NULL AND bb.created <= rr.nnt)
  GROUP BY request_id) b ON b.request_id = r.request_id"""


@register("j7_as_of_backup", J7_SQL, ("tables", "backups"))
def j7(spark, sf):
    return _j7(TestViews.of(spark, sf))


@register("q7_table_restore_plan", f"""
SELECT request_id, error,
  CASE WHEN error IS NULL THEN {{'project_id': 'backup', 'dataset_id': backup_dataset_id,
       'table_id': backup_table_id, 'partition_id': partition_id}} END AS source_table,
  CASE WHEN error IS NULL THEN {{'project_id': 'restoration', 'dataset_id': dataset_id,
       'table_id': table_id, 'partition_id': partition_id}} END AS target_table,
  CASE WHEN error IS NULL THEN 'In Progress' END AS status
FROM ({J7_SQL})""", ("tables", "backups"))
def q7(spark, sf):
    """Q7: J7 → one item per request (target: the restoration project)."""
    v = TestViews.of(spark, sf)
    return PR.table_restore_plan(table_requests(v), v.tables, v.backups, AS_OF_DT, BACKUP_PROJECT, "restoration")


@register("p10_max_partition_days", f"""
SELECT * FROM tables WHERE partition_id >= strftime({AS_OF} - to_days(2), '%Y%m%d')
UNION ALL SELECT * FROM tables WHERE partition_id IS NULL""", ("tables",))
def p10(spark, sf):
    return RS.max_partition_days(TestViews.of(spark, sf).tables, AS_OF_DT, 3)


def _a7_sql():
    return f"""
SELECT request_id, tables,
  CASE WHEN target_project_id IS NULL THEN 'Required target project id parameter is None'
       WHEN tables = 0 THEN 'No Tables was found in Datastore for project ' || r_project || ', dataset ' || r_dataset
       WHEN any_backup_dataset IS NULL
         THEN 'No Backups was found in Datastore for project ' || r_project || ', dataset ' || r_dataset
       WHEN target_location IS NOT NULL AND target_location IS DISTINCT FROM backup_location
         THEN 'Target dataset already exist and has different location than backup dataset' END AS error
FROM (
  SELECT p.*, d.location AS target_location, bl.location AS backup_location FROM (
    SELECT r.request_id, r.project_id AS r_project, r.dataset_id AS r_dataset, r.target_project_id,
           r.target_dataset_id, count(t.id) AS tables,
           arg_min(a.dataset_id, t.id) FILTER (a.dataset_id IS NOT NULL) AS any_backup_dataset
    FROM ({DS_REQ_SQL}) r
    LEFT JOIN tables t ON t.project_id = r.project_id AND t.dataset_id = r.dataset_id
    LEFT JOIN newest_avail a ON a.parent_id = t.id
    WHERE t.id IS NULL OR r.max_partition_days IS NULL OR t.partition_id IS NULL
       OR t.partition_id >= strftime({AS_OF} - to_days(CAST(r.max_partition_days - 1 AS INTEGER)), '%Y%m%d')
    GROUP BY 1, 2, 3, 4, 5) p
  LEFT JOIN ({DATASETS_SQL}) d ON d.project_id = p.target_project_id AND d.dataset_id = p.target_dataset_id
  LEFT JOIN ({BK_DATASETS_SQL}) bl ON bl.dataset_id = p.any_backup_dataset)"""


@register("a7_dataset_restore_check", _a7_sql(), ("tables", "newest_avail", "backups", "live"))
def a7(spark, sf):
    v = TestViews.of(spark, sf)
    return RS.dataset_restore_check(dataset_requests(v), v.tables, v.backups, existing_datasets(v),
                                    backup_datasets(v), AS_OF_DT)


Q6_SQL = f"""
SELECT r.request_id, t.id AS entity_id, n.id AS backup_id,
  {{'project_id': 'backup', 'dataset_id': n.dataset_id, 'table_id': n.table_id,
    'partition_id': t.partition_id}} AS source_table,
  {{'project_id': coalesce(r.target_project_id, t.project_id),
    'dataset_id': coalesce(r.target_dataset_id, t.dataset_id), 'table_id': t.table_id,
    'partition_id': t.partition_id}} AS target_table,
  'In Progress' AS status
FROM ({DS_REQ_SQL}) r
JOIN tables t ON t.project_id = r.project_id AND t.dataset_id = r.dataset_id
JOIN newest_avail n ON n.parent_id = t.id
WHERE (coalesce(r.max_partition_days, 0) = 0 OR t.partition_id IS NULL
   OR t.partition_id >= strftime({AS_OF} - to_days(CAST(r.max_partition_days - 1 AS INTEGER)), '%Y%m%d'))
  AND r.request_id IN (SELECT request_id FROM ({_a7_sql()}) WHERE error IS NULL)"""


def _q6(v):
    """Items of the requests that pass the validation."""
    return PR.dataset_restore_plan(dataset_requests(v), v.tables, v.backups, existing_datasets(v), backup_datasets(v),
                                   AS_OF_DT, BACKUP_PROJECT).items


@register("q6_dataset_restore_plan", Q6_SQL, ("tables", "newest_avail", "backups", "live"))
def q6(spark, sf):
    return _q6(TestViews.of(spark, sf))


@register("s15_prepare_targets", f"""
SELECT 'create_dataset' AS action, g.project_id, g.dataset_id, CAST(NULL AS VARCHAR) AS table_id, g.location
FROM (SELECT i.target_table.project_id AS project_id, i.target_table.dataset_id AS dataset_id,
             min(s.location) AS location
      FROM ({Q6_SQL}) i LEFT JOIN (SELECT DISTINCT dataset_id, location FROM ({BK_DATASETS_SQL})) s
        ON s.dataset_id = i.source_table.dataset_id
      GROUP BY 1, 2) g
WHERE NOT EXISTS (SELECT 1 FROM ({DATASETS_SQL}) d WHERE d.project_id = g.project_id AND d.dataset_id = g.dataset_id)
UNION ALL
SELECT DISTINCT 'create_table', i.target_table.project_id, i.target_table.dataset_id, i.target_table.table_id,
       CAST(NULL AS VARCHAR)
FROM ({Q6_SQL}) i
WHERE i.target_table.partition_id IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM live l WHERE l.table_exists AND l.project_id = i.target_table.project_id
    AND l.dataset_id = i.target_table.dataset_id AND l.table_id = i.target_table.table_id)""",
          ("tables", "newest_avail", "live", "backups"))
def s15(spark, sf):
    v = TestViews.of(spark, sf)
    return RS.prepare_targets(_q6(v), existing_datasets(v), v.live, backup_datasets(v))


# ------------------------------------------------------------- list restore
LIST_REQ_SQL = """
SELECT id % 1000 AS list_id, id AS request_id,
  CASE WHEN id % 350 = 0 THEN '!!not-base64!!'
       WHEN id % 200 = 0 THEN to_base64(encode('"Table", ' || CAST(parent_id AS VARCHAR) || ', "Backup"'))
       ELSE to_base64(encode('"Table", ' || CAST(parent_id + CASE WHEN id % 130 = 0 THEN 1 ELSE 0 END AS VARCHAR)
                            || ', "Backup", ' || CAST(id AS VARCHAR)))
  END AS backupBqKey,
  CASE WHEN id % 300 = 0 THEN 'ahFzfmJhY2t1cA' END AS backupUrlSafeKey
FROM backups"""
LIST_ALL_SQL = f"""
SELECT * FROM ({LIST_REQ_SQL})
UNION ALL SELECT list_id, -request_id, backupBqKey, backupUrlSafeKey FROM ({LIST_REQ_SQL}) WHERE request_id % 450 = 0"""
PARSED_SQL = f"""
SELECT *, CASE WHEN err IS NULL THEN TRY_CAST(parts[2] AS BIGINT) END AS table_entity_id,
       CASE WHEN err IS NULL THEN TRY_CAST(parts[4] AS BIGINT) END AS backup_id, err AS error
FROM (SELECT *, CASE
    WHEN backupBqKey IS NULL AND backupUrlSafeKey IS NULL
      THEN 'There are missing ''backupUrlSafeKey'' or ''backupBqKey'' variables in request body.'
    WHEN backupBqKey IS NOT NULL AND backupUrlSafeKey IS NOT NULL
      THEN 'Please specify either ''backupUrlSafeKey'' or ''backupBqKey'' element in single item.'
    WHEN backupBqKey IS NULL THEN 'Url-safe store keys are not supported'
    WHEN parts IS NULL OR len(parts) <> 4 OR TRY_CAST(parts[2] AS BIGINT) IS NULL
         OR TRY_CAST(parts[4] AS BIGINT) IS NULL
      THEN 'Unable to parse backup BQ key: ' || backupBqKey
           || CASE WHEN parts IS NOT NULL AND len(parts) <> 4 THEN ', key doesn''t consist of 4 parts' ELSE '' END
    END AS err
  FROM (SELECT *, string_split(regexp_replace(decode(TRY(from_base64(backupBqKey))), '["\\s]', '', 'g'), ',') AS parts
        FROM ({LIST_ALL_SQL})))"""


def _parsed(v):
    return RS.parse_list_requests(v.list_requests)


@register("u4_parse_backup_key", f"""
SELECT request_id, table_entity_id, backup_id, error FROM ({PARSED_SQL})""", ("backups",))
def u4(spark, sf):
    return _parsed(TestViews.of(spark, sf)).select("request_id", "table_entity_id", "backup_id", "error")


@register("u_4_duplicate_requests", f"""
SELECT list_id, table_entity_id, backup_id, count(*) AS times FROM ({PARSED_SQL}) WHERE backup_id IS NOT NULL
GROUP BY 1, 2, 3 HAVING count(*) > 1""", ("backups",))
def u_4(spark, sf):
    return RS.duplicate_requests(_parsed(TestViews.of(spark, sf)))


J8_SQL = f"""
SELECT p.list_id, p.request_id, p.backupBqKey, p.backupUrlSafeKey, p.table_entity_id, p.backup_id, b.dataset_id AS backup_dataset_id, b.table_id AS backup_table_id,
       t.project_id, t.dataset_id, t.table_id, t.partition_id,
       coalesce(p.error, CASE WHEN b.id IS NULL THEN 'Backup entity (key=' || CAST(p.backup_id AS VARCHAR)
                                                       || ') doesn''t exist in datastore.'
                              WHEN t.id IS NULL THEN 'Backup ancestor doesn''t exists: ''' || b.dataset_id || ':'
                                                     || b.table_id || '''. '
                         END) AS error
FROM ({PARSED_SQL}) p LEFT JOIN backups b ON b.id = p.backup_id AND b.parent_id = p.table_entity_id
LEFT JOIN tables t ON t.id = b.parent_id"""


def _j8(v):
    return RS.resolve_backup_keys(_parsed(v), v.backups, v.tables)


@register("j8_resolve_backup_keys", f"SELECT * EXCLUDE (backupBqKey, backupUrlSafeKey) FROM ({J8_SQL})", ("backups", "tables"))
def j8(spark, sf):
    return _j8(TestViews.of(spark, sf)).select("list_id", "request_id", "table_entity_id", "backup_id", "backup_dataset_id",
                                            "backup_table_id", "project_id", "dataset_id", "table_id",
                                            "partition_id", "error")


@register("q8_list_restore_plan", f"""
SELECT list_id, request_id, e AS error,
  CASE WHEN e IS NULL THEN {{'project_id': 'backup', 'dataset_id': backup_dataset_id, 'table_id': backup_table_id,
       'partition_id': partition_id}} END AS source_table,
  CASE WHEN e IS NULL THEN {{'project_id': 'restoration', 'dataset_id': dataset_id, 'table_id': table_id,
       'partition_id': partition_id}} END AS target_table,
  CASE WHEN e IS NULL THEN 'In Progress' END AS status,
  CAST(to_json({{'list_id': list_id, 'request_id': request_id, 'backupBqKey': backupBqKey,
                'backupUrlSafeKey': backupUrlSafeKey}}) AS VARCHAR) AS custom_parameters
FROM (SELECT j.*, coalesce(j.error, CASE WHEN d.list_id IS NOT NULL THEN 'There are duplicated backup items - '
          || 'more than one ''backupUrlSafeKey'' or ''backupBqKey'' are pointing to the same backup. '
          || 'Duplicated backup item: ' || CAST(d.dup AS VARCHAR) END) AS e
      FROM ({J8_SQL}) j LEFT JOIN (
        SELECT list_id, min(backup_id) AS dup FROM (
          SELECT list_id, table_entity_id, backup_id FROM ({J8_SQL}) WHERE backup_id IS NOT NULL
          GROUP BY list_id, table_entity_id, backup_id HAVING count(*) > 1) GROUP BY list_id) d USING (list_id))""", ("backups", "tables"))
def q8(spark, sf):
    v = TestViews.of(spark, sf)
    return PR.list_restore_plan(v.list_requests, v.backups, v.tables, BACKUP_PROJECT, "restoration", None)


# ------------------------------------------------------------- validation
def _p19_frame(v):
    i = F.col("id")
    return v.tables.select(
        i.alias("request_id"),
        F.when(i % 7 == 0, F.concat("project_id", F.lit("_x"))).otherwise(F.col("project_id")).alias("source_project_id"),
        F.when(i % 11 == 0, F.concat("dataset_id", F.lit("-x"))).otherwise(F.col("dataset_id")).alias("source_dataset_id"),
        F.when(i % 5 == 0, F.lit("")).otherwise(F.lit("restoration")).alias("target_project_id"),
        F.when(i % 6 == 0, F.lit(None).cast("string")).when(i % 19 == 0, F.lit("bad.name"))
        .otherwise(F.col("dataset_id")).alias("target_dataset_id"),
        F.when(i % 9 == 0, "WRITE_SOMETIMES").otherwise("WRITE_APPEND").alias("write_disposition"),
        F.when(i % 4 == 0, "CREATE_MAYBE").when(i % 4 == 1, F.lit(None).cast("string"))
        .otherwise(F.lit("CREATE_NEVER")).alias("create_disposition"))


@register("p19_validate_restore_requests", """
SELECT *, CASE
  WHEN coalesce(source_project_id, '') <> '' AND NOT regexp_matches(source_project_id, '^[a-zA-Z0-9-]+$')
    THEN 'Invalid project value: ''' || source_project_id || '''. Project IDs may contain letters, numbers, and dash'
  WHEN coalesce(source_dataset_id, '') <> '' AND NOT regexp_matches(source_dataset_id, '^[a-zA-Z0-9_]+$')
    THEN 'Invalid dataset value: ''' || source_dataset_id || '''. Dataset IDs may contain letters, numbers, and underscores'
  WHEN coalesce(target_project_id, '') <> '' AND NOT regexp_matches(target_project_id, '^[a-zA-Z0-9-]+$')
    THEN 'Invalid project value: ''' || target_project_id || '''. Project IDs may contain letters, numbers, and dash'
  WHEN coalesce(target_dataset_id, '') <> '' AND NOT regexp_matches(target_dataset_id, '^[a-zA-Z0-9_]+$')
    THEN 'Invalid dataset value: ''' || target_dataset_id || '''. Dataset IDs may contain letters, numbers, and underscores'
  WHEN coalesce(write_disposition, '') <> '' AND write_disposition NOT IN ('WRITE_TRUNCATE', 'WRITE_APPEND', 'WRITE_EMPTY')
    THEN 'Invalid write disposition: ''' || write_disposition || '''. The following values are supported: WRITE_TRUNCATE, WRITE_APPEND, WRITE_EMPTY.'
  WHEN coalesce(create_disposition, '') <> '' AND create_disposition NOT IN ('CREATE_IF_NEEDED', 'CREATE_NEVER')
    THEN 'Invalid create disposition: ''' || create_disposition || '''. The following values are supported: CREATE_IF_NEEDED, CREATE_NEVER.'
  END AS error
FROM (SELECT id AS request_id,
  CASE WHEN id % 7 = 0 THEN project_id || '_x' ELSE project_id END AS source_project_id,
  CASE WHEN id % 11 = 0 THEN dataset_id || '-x' ELSE dataset_id END AS source_dataset_id,
  CASE WHEN id % 5 = 0 THEN '' ELSE 'restoration' END AS target_project_id,
  CASE WHEN id % 6 = 0 THEN NULL WHEN id % 19 = 0 THEN 'bad.name' ELSE dataset_id END AS target_dataset_id,
  CASE WHEN id % 9 = 0 THEN 'WRITE_SOMETIMES' ELSE 'WRITE_APPEND' END AS write_disposition,
  CASE WHEN id % 4 = 0 THEN 'CREATE_MAYBE' WHEN id % 4 = 1 THEN NULL ELSE 'CREATE_NEVER' END AS create_disposition
  FROM tables)""", ("tables",))
def p19(spark, sf):
    return RS.validate_restore_requests(_p19_frame(TestViews.of(spark, sf)))


REF_TEXT_SQL = """
SELECT id, CASE WHEN id % 3 = 0 THEN replace(ref, ':', '_') ELSE ref END AS ref FROM (
  SELECT id, project_id || ':' || dataset_id || '.' || table_id || coalesce('$' || partition_id, '') AS ref
  FROM tables)"""


@register("u3_parse_table_ref", f"""
SELECT id, ref,
  CASE WHEN ok THEN string_split(ref, ':')[1] END AS project_id,
  CASE WHEN ok THEN string_split(string_split(ref, ':')[2], '.')[1] END AS dataset_id,
  CASE WHEN ok THEN string_split(string_split(string_split(ref, ':')[2], '.')[2], '$')[1] END AS table_id,
  CASE WHEN ok AND len(string_split(string_split(string_split(ref, ':')[2], '.')[2], '$')) > 1
       THEN string_split(string_split(string_split(ref, ':')[2], '.')[2], '$')[2] END AS partition_id,
  CASE WHEN ok THEN ref END AS formatted
FROM (SELECT *, regexp_matches(ref, '^[a-zA-Z1-9\\-]+:\\w+.\\w+(\\$\\d{{8}})?$')
               AND len(string_split(ref, ':')) = 2
               AND len(string_split(coalesce(string_split(ref, ':')[2], ''), '.')) = 2 AS ok
      FROM ({REF_TEXT_SQL}))""", ("tables",))
def u3(spark, sf):
    v = TestViews.of(spark, sf)
    i = F.col("id")
    ref = U.format_table_ref(U.table_ref("project_id", "dataset_id", "table_id", "partition_id"))
    texts = v.tables.select(i, F.when(i % 3 == 0, F.replace(ref, F.lit(":"), F.lit("_"))).otherwise(ref).alias("ref"))
    p = U.parse_table_ref("ref")
    return texts.select("id", "ref", p.project_id.alias("project_id"), p.dataset_id.alias("dataset_id"),
                        p.table_id.alias("table_id"), p.partition_id.alias("partition_id"),
                        U.format_table_ref(p).alias("formatted"))


# ------------------------------------------------------------- status
ITEMS_SQL = f"""
SELECT l_orderkey * 8 + l_linenumber AS id, CAST(l_orderkey AS VARCHAR) AS job_id,
  CASE l_returnflag WHEN 'R' THEN 'Failed' WHEN 'A' THEN 'Done' ELSE 'In Progress' END AS status,
  CASE WHEN l_returnflag = 'R' THEN 'Copy job failed: line ' || CAST(l_linenumber AS VARCHAR) END AS status_message,
  CASE WHEN l_returnflag IN ('R', 'A') THEN l_shipdate + to_days(8217) END AS completed,
  {{'project_id': 'backup', 'dataset_id': 'bk' || CAST(l_orderkey % 5 AS VARCHAR),
    'table_id': '20' || CAST(l_orderkey AS VARCHAR),
    'partition_id': CASE WHEN l_linenumber % 2 = 0 THEN strftime(l_shipdate, '%Y%m%d') END}} AS source_table,
  {{'project_id': 'p' || CAST(l_partkey % 4 AS VARCHAR), 'dataset_id': 'd' || CAST(l_suppkey % 3 AS VARCHAR),
    'table_id': 't' || CAST(l_partkey % 100 AS VARCHAR),
    'partition_id': CASE WHEN l_linenumber % 2 = 0 THEN strftime(l_shipdate, '%Y%m%d') END}} AS target_table,
  CASE WHEN l_linenumber % 3 = 0 THEN '{{"line": ' || CAST(l_linenumber AS VARCHAR) || '}}'
       WHEN l_linenumber % 3 = 1 THEN 'not json' END AS custom_parameters
FROM lineitem"""
JOBS_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderdate + to_days(8217) AS created,
  n + o_orderkey % 2 AS items_count,
  CASE WHEN o_orderkey % 3 = 0 THEN 'CREATE_NEVER' ELSE 'CREATE_IF_NEEDED' END AS create_disposition,
  ['WRITE_EMPTY', 'WRITE_APPEND', 'WRITE_TRUNCATE'][CAST(o_orderkey % 3 AS INTEGER) + 1] AS write_disposition
FROM orders JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey"""


@register("a6_items_count", f"SELECT job_id, count(*) AS items FROM ({ITEMS_SQL}) GROUP BY 1")
def a6(spark, sf):
    return RS.items_count(TestViews.of(spark, sf).restore_items)


@register("a3_item_results", f"""
SELECT job_id, CASE status WHEN 'In Progress' THEN 'inProgress' ELSE lower(status) END AS result,
       count(*) AS count FROM ({ITEMS_SQL}) GROUP BY job_id, status
UNION ALL
SELECT j.id, 'unknown', j.items_count - coalesce(c.n, 0) FROM ({JOBS_SQL}) j
LEFT JOIN (SELECT job_id, count(*) AS n FROM ({ITEMS_SQL}) GROUP BY 1) c ON c.job_id = j.id
WHERE j.items_count - coalesce(c.n, 0) > 0""")
def a3(spark, sf):
    v = TestViews.of(spark, sf)
    return RS.item_results(v.restoration_jobs, v.restore_items)


A4_SQL = f"""
SELECT j.id AS job_id, j.items_count, j.create_disposition, j.write_disposition,
  CASE WHEN fin THEN 'Done' ELSE 'In progress' END AS state,
  CASE WHEN fin THEN CASE WHEN coalesce(c.done, 0) = j.items_count THEN 'Success' ELSE 'Failed' END END AS result
FROM (SELECT j.*, c.*, coalesce(c.in_progress, 0) = 0 AND coalesce(c.n, 0) = j.items_count AS fin
      FROM ({JOBS_SQL}) j LEFT JOIN (
        SELECT job_id, count(*) AS n, count(*) FILTER (WHERE status = 'In Progress') AS in_progress,
               count(*) FILTER (WHERE status = 'Done') AS done
        FROM ({ITEMS_SQL}) GROUP BY 1) c ON c.job_id = j.id) j
LEFT JOIN (SELECT job_id, count(*) FILTER (WHERE status = 'Done') AS done FROM ({ITEMS_SQL}) GROUP BY 1) c
  ON c.job_id = j.id"""


@register("a4_job_status", A4_SQL)
def a4(spark, sf):
    v = TestViews.of(spark, sf)
    return RS.job_status(v.restoration_jobs, v.restore_items)


@register("p20_warnings_only", f"SELECT * FROM ({ITEMS_SQL}) WHERE status NOT IN ('Done', 'In Progress')")
def p20(spark, sf):
    return RS.warnings_only(TestViews.of(spark, sf).restore_items)


@register("q10_restore_status", f"""
SELECT s.state, s.result, i.job_id, i.id, i.status, i.status_message AS statusMessage,
  CASE WHEN i.completed IS NULL THEN NULL
       WHEN microsecond(i.completed) % 1000000 = 0 THEN strftime(i.completed, '%Y-%m-%dT%H:%M:%S')
       ELSE strftime(i.completed, '%Y-%m-%dT%H:%M:%S.%f') END AS completed,
  i.custom_parameters AS customParameters, json_valid(i.custom_parameters) AS customParametersIsJson,
  i.source_table.project_id || ':' || i.source_table.dataset_id || '.' || i.source_table.table_id
    || coalesce('$' || i.source_table.partition_id, '') AS sourceTable,
  i.target_table.project_id || ':' || i.target_table.dataset_id || '.' || i.target_table.table_id
    || coalesce('$' || i.target_table.partition_id, '') AS targetTable
FROM ({ITEMS_SQL}) i JOIN ({A4_SQL}) s ON s.job_id = i.job_id
WHERE i.status NOT IN ('Done', 'In Progress')""")
def q10(spark, sf):
    """Q10: per job its state and result (counts taken before the filter),
    then the warnings-only item listing."""
    v = TestViews.of(spark, sf)
    status = PR.restore_status(v.restoration_jobs, v.restore_items, warnings_only=True)
    st = status.jobs.select("job_id", "state", "result")
    return st.join(status.items, "job_id").select("state", "result", "job_id", "id", "status", "statusMessage",
                                                  "completed", "customParameters", "customParametersIsJson",
                                                  "sourceTable", "targetTable")


EVENTS_SQL = f"""
SELECT l_orderkey * 8 + l_linenumber AS item_id, t AS event_time, status,
       CASE WHEN status = 'Failed' THEN 'error on item ' || CAST(l_orderkey * 8 + l_linenumber AS VARCHAR) END AS message
FROM (SELECT *, l_shipdate + to_days(8217) AS t,
             CASE WHEN l_linenumber % 2 = 0 THEN 'Done' ELSE 'Failed' END AS status FROM lineitem
      UNION ALL
      SELECT *, l_shipdate + to_days(8217) + INTERVAL 1 HOUR,
             CASE WHEN l_linenumber % 2 = 0 THEN 'Failed' ELSE 'Done' END FROM lineitem)"""


@register("m3_fold_item_status", f"""
SELECT i.id, i.job_id, CASE WHEN fin THEN e.status ELSE i.status END AS status,
  CASE WHEN fin THEN CASE WHEN e.status = 'Failed' THEN e.message END ELSE i.status_message END AS status_message,
  CASE WHEN fin THEN e.event_time ELSE i.completed END AS completed,
  i.source_table, i.target_table, i.custom_parameters
FROM (SELECT i.*, e.*, i.status = 'In Progress' AND e.status IS NOT NULL AS fin
      FROM ({ITEMS_SQL}) i LEFT JOIN (
        SELECT item_id, arg_min(status, event_time) AS status, min(event_time) AS event_time,
               arg_min(message, event_time) AS message
        FROM ({EVENTS_SQL}) WHERE status IN ('Done', 'Failed') GROUP BY 1) e ON e.item_id = i.id) i
LEFT JOIN (SELECT item_id, arg_min(status, event_time) AS status, min(event_time) AS event_time,
                  arg_min(message, event_time) AS message
           FROM ({EVENTS_SQL}) WHERE status IN ('Done', 'Failed') GROUP BY 1) e ON e.item_id = i.id""")
def m3(spark, sf):
    v = TestViews.of(spark, sf)
    return RS.fold_item_status(v.restore_items, v.status_events)


@register("m5_create_job", f"""
SELECT n.* FROM (
  SELECT CAST(o_orderkey * 2 + 1 AS VARCHAR) AS id, o_orderdate + to_days(8218) AS created,
         CAST(1 AS BIGINT) AS items_count, 'CREATE_IF_NEEDED' AS create_disposition,
         'WRITE_EMPTY' AS write_disposition
  FROM orders) n
WHERE n.id NOT IN (SELECT id FROM ({JOBS_SQL}))""")
def m5(spark, sf):
    """A new-job request per order (id 2·o_orderkey + 1, so about half
    collide with existing job ids); ids that exist already are ignored."""
    v = TestViews.of(spark, sf)
    o = v._read("orders")
    new = o.select((F.col("o_orderkey") * 2 + 1).cast("string").alias("id"),
                   F.date_add(F.col("o_orderdate"), 8218).cast("timestamp_ntz").alias("created"),
                   F.lit(1).cast("long").alias("items_count"), F.lit("CREATE_IF_NEEDED").alias("create_disposition"),
                   F.lit("WRITE_EMPTY").alias("write_disposition"))
    return RS.create_job(v.restoration_jobs, new)


@register("u6_camel_case", f"""
SELECT DISTINCT status, CASE status WHEN 'In Progress' THEN 'inProgress' ELSE lower(status) END AS key
FROM ({ITEMS_SQL})""")
def u6(spark, sf):
    items = TestViews.of(spark, sf).restore_items
    return items.select("status").distinct().select("status", U.camel_case("status").alias("key"))


# ------------------------------------------------------------- flat output
# Registered outputs carry table references as flat columns, so results
# compare as plain values in any client (structs stay inside the library).
_REF_FIELDS = ("project_id", "dataset_id", "table_id", "partition_id")


def _flat_df(df):
    cols = [c for c in df.columns if c not in ("source_table", "target_table")]
    refs = [F.col(f"{side}_table.{f}").alias(f"{side}_{f}") for side in ("source", "target") for f in _REF_FIELDS]
    return df.select(*cols, *refs)


def _flat_sql(sql):
    refs = ", ".join(f"{side}_table.{f} AS {side}_{f}" for side in ("source", "target") for f in _REF_FIELDS)
    return f"SELECT * EXCLUDE (source_table, target_table), {refs} FROM ({sql})"


def _flatten(name):
    from keepsake.registry import REGISTRY
    fn, sql = REGISTRY[name]
    REGISTRY[name] = ((lambda spark, sf, _fn=fn: _flat_df(_fn(spark, sf))), _flat_sql(sql) if sql else None)


for _n in ("m3_fold_item_status", "p20_warnings_only", "q6_dataset_restore_plan", "q7_table_restore_plan",
           "q8_list_restore_plan"):
    _flatten(_n)
