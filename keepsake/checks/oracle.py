"""DuckDB oracle: the catalog adapter and every checkable query as SQL.

Independent of the Spark code: same rules, written as CTEs over the driver's
pre-registered views (orders, lineitem, events, ...).  Month arithmetic uses
DuckDB's own interval rules, ties are broken by id descending as in Spark.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-30 00:00:00'"
AS_OF_DATE = "DATE '2024-01-30'"
BACKUP_PROJECT = "'backup'"
RESTORATION_PROJECT = "'restoration'"


def _s(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


def _days(expr: str) -> str:
    return f"to_days(CAST({expr} AS INTEGER))"


PARTITION_RULE = (f"CASE WHEN {{i}} % 5 = 0 THEN '__UNPARTITIONED__' "
                  f"WHEN {{i}} % 2 = 0 THEN strftime({AS_OF} - to_days(CAST({{i}} % 7 AS INTEGER)), '%Y%m%d') END")

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, deps: tuple[str, ...] = ()) -> None:
    CTES[name] = (sql, deps)


# ---------------------------------------------------------------- adapter
cte("tables", f"""
SELECT i AS id, 'p' || {_s('i % 4')} AS project_id, 'd' || {_s('i % 3')} AS dataset_id,
       't' || {_s('i')} AS table_id, {PARTITION_RULE.format(i='i')} AS partition_id,
       {AS_OF} - {_days('(i * 37) % 420')} AS last_checked
FROM (SELECT DISTINCT o_custkey % 100 AS i FROM orders)""")

cte("backups", f"""
SELECT o_orderkey AS id, o_custkey % 100 AS parent_id, created - INTERVAL 10 MINUTE AS last_modified,
       created, 'bk' || {_s('o_orderkey % 5')} AS dataset_id,
       CASE WHEN o_custkey % 100 = 7 THEN '20' || {_s('o_orderkey // 1000')}
            ELSE '20' || {_s('o_orderkey')} END AS table_id,
       CAST(floor(o_totalprice) AS BIGINT) AS num_bytes,
       CASE WHEN o_orderstatus = 'P' THEN o_orderdate + to_days(8247) END AS deleted
FROM (SELECT *, o_orderdate + to_days(8217) + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS created
      FROM orders)""")

cte("census_base", f"""
SELECT user_id % 100 AS n, 'p' || {_s('user_id % 100 % 4')} AS projectId,
       'd' || {_s('user_id % 100 % 3')} AS datasetId, 't' || {_s('user_id % 100')} AS tableId,
       ts AS snapshotTime, CAST(ts AS DATE) AS snapshot_date,
       ts - {_days('event_id % 9')} AS lastModifiedTime, ts - to_days(100) AS creationTime,
       CAST(floor(value) AS BIGINT) AS numRows, CAST(floor(value * 100) AS BIGINT) AS numBytes,
       CASE WHEN event_type = 'error' THEN 'VIEW' ELSE 'TABLE' END AS type
FROM events""")

cte("census_tables", """
SELECT projectId, datasetId, tableId, snapshotTime, snapshot_date, lastModifiedTime, creationTime,
       numRows, numBytes, type, CASE WHEN n % 5 = 0 OR n % 2 = 0 THEN 'DAY' END AS tp_type
FROM census_base""", ("census_base",))

cte("census_partitions", f"""
SELECT projectId, datasetId, tableId, snapshotTime, snapshot_date, lastModifiedTime, creationTime,
       numRows, numBytes, {PARTITION_RULE.format(i='n')} AS partitionId
FROM census_base WHERE n % 5 = 0 OR n % 2 = 0""", ("census_base",))

cte("census_copies", f"""
SELECT {BACKUP_PROJECT} AS projectId, dataset_id AS datasetId, table_id AS tableId,
       created AS creationTime, created AS lastModifiedTime, id % 50 AS numRows,
       num_bytes + id % 3 AS numBytes, {AS_OF} AS snapshotTime
FROM backups WHERE id % 11 <> 0
UNION ALL
SELECT {BACKUP_PROJECT}, dataset_id, '20x' || {_s('id')}, created, created, id % 50,
       num_bytes + id % 3, {AS_OF}
FROM backups WHERE id % 101 = 0""", ("backups",))

cte("census_latest_n", """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY n ORDER BY snapshotTime DESC, lastModifiedTime DESC,
         creationTime DESC, numRows DESC, numBytes DESC, type DESC) AS rn
  FROM census_base) WHERE rn = 1""", ("census_base",))

cte("live", """
SELECT t.project_id, t.dataset_id, t.table_id, st AS lookup_status, st = 'found' AS table_exists,
       CASE WHEN ok THEN make_timestamp((epoch_us(c.creationTime) // 1000) * 1000) END AS creation_time,
       CASE WHEN ok THEN make_timestamp((epoch_us(c.lastModifiedTime) // 1000) * 1000) END AS last_modified_time,
       CASE WHEN ok THEN c.numBytes END AS num_bytes,
       CASE WHEN ok THEN c.numRows END AS num_rows,
       CASE WHEN ok THEN c.type END AS type,
       CASE WHEN ok AND t.id % 6 = 1 THEN 'EU' ELSE 'US' END AS location,
       CASE WHEN ok AND part THEN 'DAY' END AS time_partitioning_type,
       CASE WHEN ok AND part AND t.id % 3 = 0 THEN CAST(2592000000 AS BIGINT) END AS partition_expiration_ms,
       CASE WHEN ok THEN c.numRows = 0 END AS is_empty,
       coalesce(ok AND c.type IN ('VIEW', 'EXTERNAL'), false) AS is_external_or_view,
       coalesce(ok AND t.id % 13 <> 0, false) AS is_schema_defined,
       coalesce(ok AND part, false) AS is_daily_partitioned,
       coalesce(ok AND part, false) AS has_time_partitioning,
       coalesce(ok AND part AND t.id % 3 = 0, false) AS has_partition_expiration
FROM (SELECT *, CASE WHEN id % 23 = 0 OR id % 50 = 29 THEN 'error' ELSE 'found' END AS st,
             id % 23 <> 0 AND id % 50 <> 29 AS ok, (id % 5 = 0 OR id % 2 = 0) AS part
      FROM tables WHERE id % 4 <> 2) t
JOIN census_latest_n c ON c.n = t.id""", ("tables", "census_latest_n"))

cte("partitions", """
SELECT l.project_id, l.dataset_id, l.table_id, p.partitionId AS partition_id,
       p.creationTime AS creation_time, p.lastModifiedTime AS last_modified,
       p.numRows AS num_rows, p.numBytes AS num_bytes
FROM (SELECT *, row_number() OVER (PARTITION BY projectId, datasetId, tableId, partitionId
        ORDER BY snapshotTime DESC, lastModifiedTime DESC, creationTime DESC, numRows DESC,
                 numBytes DESC) AS rn
      FROM census_partitions) p
JOIN live l ON l.project_id = p.projectId AND l.dataset_id = p.datasetId AND l.table_id = p.tableId
WHERE p.rn = 1 AND l.table_exists AND l.has_time_partitioning""", ("census_partitions", "live"))

# ---------------------------------------------------------------- retention
YOUNG_THRESHOLD = f"CAST({AS_OF_DATE} - INTERVAL 7 MONTH AS DATE)"
GRACE_THRESHOLD = f"CAST({AS_OF_DATE} - INTERVAL 7 MONTH AS DATE)"
CANDIDATE_THRESHOLD = f"({AS_OF} - INTERVAL 8 MONTH)"

cte("avail_all", "SELECT * FROM backups WHERE deleted IS NULL", ("backups",))
cte("cand", f"SELECT * FROM tables WHERE last_checked >= {CANDIDATE_THRESHOLD}", ("tables",))
cte("avail", """
SELECT id, parent_id, table_id, created FROM backups
WHERE deleted IS NULL AND parent_id IN (SELECT id FROM cand)""", ("backups", "cand"))
cte("dup_parents", """
SELECT parent_id, arg_max(table_id, (c, table_id)) AS table_id, max(c) AS copies
FROM (SELECT parent_id, table_id, count(*) AS c FROM {src} GROUP BY 1, 2) WHERE c > 1
GROUP BY parent_id""".replace("{src}", "avail"), ("avail",))
cte("flagged", """
SELECT a.*, d.parent_id IS NOT NULL AS dup FROM avail a LEFT JOIN dup_parents d USING (parent_id)""",
    ("avail", "dup_parents"))
cte("daily", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY parent_id, CAST(created AS DATE)
                               ORDER BY created DESC, id DESC) AS rn
  FROM flagged WHERE NOT dup) WHERE rn = 1""", ("flagged",))
cte("stepped", f"""
SELECT *, CASE WHEN young AND rn2 > 10 THEN 'young_over_limit'
               WHEN NOT young AND rn2 > 1 THEN 'old_not_newest' END AS step
FROM (SELECT *, row_number() OVER (PARTITION BY parent_id, young ORDER BY created DESC, id DESC) AS rn2
      FROM (SELECT *, CAST(created AS DATE) >= {YOUNG_THRESHOLD} AS young FROM daily))""", ("daily",))
EXISTS_SQL = ("((coalesce(l.table_exists, false) AND (t.partition_id IS NULL "
              "OR coalesce(l.has_time_partitioning, false))) OR coalesce(l.lookup_status = 'error', false))")
cte("grace", f"""
SELECT s.parent_id,
       (NOT s.has_old) OR coalesce(CAST(t.last_checked AS DATE) >= {GRACE_THRESHOLD}, false)
       OR {EXISTS_SQL} AS keep,
       s.has_old AND NOT coalesce(CAST(t.last_checked AS DATE) >= {GRACE_THRESHOLD}, false)
       AND coalesce(l.lookup_status = 'error', false) AS lookup_failed
FROM (SELECT parent_id, bool_or(CAST(created AS DATE) < {GRACE_THRESHOLD}) AS has_old
      FROM stepped WHERE step IS NULL GROUP BY 1) s
LEFT JOIN cand t ON t.id = s.parent_id
LEFT JOIN live l ON l.project_id = t.project_id AND l.dataset_id = t.dataset_id
                 AND l.table_id = t.table_id""", ("stepped", "cand", "live"))
cte("retention_plan", """
SELECT f.id, f.parent_id, f.table_id, f.created, r IN ('kept', 'duplicate_table_id', 'lookup_failed') AS retained,
       r AS reason
FROM (SELECT f.*, coalesce(CASE WHEN lf.lookup_failed THEN 'lookup_failed' END, d.reason, CASE WHEN f.dup THEN 'duplicate_table_id' END,
                           'not_newest_of_day') AS r
      FROM flagged f LEFT JOIN (
        SELECT s.id, coalesce(s.step, CASE WHEN NOT g.keep THEN 'source_gone' END, 'kept') AS reason
        FROM stepped s LEFT JOIN grace g USING (parent_id)) d USING (id)
      LEFT JOIN grace lf ON lf.parent_id = f.parent_id) f""",
    ("flagged", "stepped", "grace"))


def build(final_sql: str, needs: tuple[str, ...]) -> str:
    """Assemble `WITH` + the CTEs `needs` depends on, in dependency order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return final_sql
    body = ",\n".join(f"{n} AS ({CTES[n][0]}\n)" for n in order)
    return f"WITH {body}\n{final_sql}"


# ---------------------------------------------------------------- export / catalog
cte("table_export", """
SELECT project_id, dataset_id, table_id, partition_id, last_checked,
       '"Table", ' || CAST(id AS VARCHAR) AS key_path, id AS key_id
FROM tables""", ("tables",))
cte("backup_export", """
SELECT created, deleted, last_modified, num_bytes AS numBytes, table_id, dataset_id,
       '"Table", ' || CAST(parent_id AS VARCHAR) || ', "Backup", ' || CAST(id AS VARCHAR) AS key_path,
       id AS key_id
FROM backups""", ("backups",))
cte("last_table_x", """
SELECT project_id, dataset_id, table_id, coalesce(partition_id, 'None') AS partition_id,
       last_checked, key_id AS id
FROM table_export""", ("table_export",))
cte("last_backup_x", """
SELECT created, deleted, last_modified, numBytes, table_id, dataset_id,
       to_base64(encode(key_path)) AS key,
       TRY_CAST(trim(split_part(key_path, ',', 2)) AS BIGINT) AS parent_id
FROM backup_export""", ("backup_export",))
cte("all_backups_x", """
SELECT t.project_id AS source_project_id, t.dataset_id AS source_dataset_id,
       t.table_id AS source_table_id, t.partition_id AS source_partition_id,
       t.last_checked AS source_table_last_checked, t.id AS table_entity_id,
       b.created AS backup_created, b.deleted AS backup_deleted,
       b.last_modified AS backup_last_modified, b.numBytes AS backup_num_bytes,
       b.table_id AS backup_table_id, b.dataset_id AS backup_dataset_id, b.key AS backupBqKey
FROM last_backup_x b JOIN last_table_x t ON b.parent_id = t.id""", ("last_backup_x", "last_table_x"))
cte("last_avail_x", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY table_entity_id
                               ORDER BY backup_created DESC, backupBqKey DESC) AS rn
  FROM all_backups_x WHERE backup_deleted IS NULL) WHERE rn = 1""", ("all_backups_x",))
cte("newest_avail", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY parent_id ORDER BY created DESC, id DESC) AS rn
  FROM backups WHERE deleted IS NULL) WHERE rn = 1""", ("backups",))

cte("listed_copies", """
SELECT dataset_id, table_id, id, parent_id, created, last_modified, num_bytes + CASE WHEN id % 7 = 0 THEN 1 ELSE 0 END AS num_bytes FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset_id, table_id ORDER BY id DESC) AS rn
  FROM backups WHERE deleted IS NULL) WHERE rn = 1""", ("backups",))
cte("live_copies", "SELECT dataset_id, table_id, num_bytes FROM listed_copies", ("listed_copies",))
