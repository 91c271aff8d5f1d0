"""Registered catalog/export queries: S1–S3, J1, W6, W7, J12, Q17, Q18; orders L1–L3 as explicit ranks."""

from __future__ import annotations

from pyspark.sql import functions as F

from keepsake.operators import catalog as C
from keepsake.operators import restore as RS
from keepsake.operators.common import with_rank
from keepsake.registry import register
from keepsake.sources import export as X
from keepsake.sources.bucketed import over_parts, stored_parts
from keepsake.sources.testviews import TestViews


def _exports(v: TestViews):
    """Two daily shards of the backup export: yesterday's (copies that
    existed then) and today's (all)."""
    old = X.to_export(v.backups.filter(F.col("created") < F.lit("2024-01-29").cast("timestamp_ntz")),
                      "Backup").withColumn("export_date", F.lit("20240129"))
    new = X.to_export(v.backups, "Backup").withColumn("export_date", F.lit("20240130"))
    return old.unionByName(new)


def _last_table(v):
    return X.last_table(X.to_export(v.tables, "Table"))


def _last_backup(v):
    return X.last_backup(X.to_export(v.backups, "Backup"))


@register("s1_latest_export", """
SELECT key_id AS id, '20240130' AS export_date FROM backup_export""", ("backup_export",))
def s1(spark, sf):
    return X.latest_export(_exports(TestViews.of(spark, sf))).select(
        F.col("__key__.id").alias("id"), "export_date")


@register("s2_last_table", "SELECT * FROM last_table_x", ("last_table_x",))
def s2(spark, sf):
    return _last_table(TestViews.of(spark, sf))


@register("s3_last_backup_export", "SELECT * FROM last_backup_x", ("last_backup_x",))
def s3(spark, sf):
    return _last_backup(TestViews.of(spark, sf))


@register("q17_metadata_export", """
SELECT created, deleted, last_modified, numBytes, table_id, dataset_id, key_path, 'Backup' AS key_kind,
       key_id FROM backup_export""", ("backup_export",))
def q17(spark, sf):
    e = X.to_export(TestViews.of(spark, sf).backups, "Backup")
    return e.select("created", "deleted", "last_modified", "numBytes", "table_id", "dataset_id",
                    F.col("__key__.path").alias("key_path"), F.col("__key__.kind").alias("key_kind"),
                    F.col("__key__.id").alias("key_id"))


@register("j1_all_backups", "SELECT * FROM all_backups_x", ("all_backups_x",))
def j1(spark, sf):
    v = TestViews.of(spark, sf)
    return C.all_backups(_last_backup(v), _last_table(v))


@register("w6_last_available_backup", "SELECT * FROM last_avail_x", ("last_avail_x",))
def w6(spark, sf):
    v = TestViews.of(spark, sf)
    return C.last_available_backup(C.all_backups(_last_backup(v), _last_table(v)))


_LAST_SQL = """
SELECT t.*, n.id AS backup_id, n.created AS backup_created, n.last_modified AS backup_last_modified,
       n.num_bytes AS backup_num_bytes, n.dataset_id AS backup_dataset_id,
       n.table_id AS backup_table_id
FROM tables t LEFT JOIN newest_avail n ON n.parent_id = t.id"""


@register("w7_last_backup", _LAST_SQL, ("tables", "newest_avail"))
def w7(spark, sf):
    v = TestViews.of(spark, sf)
    return C.last_backup(v.tables, v.backups)


_FIND_SQL = """
SELECT b.* FROM backups b WHERE b.parent_id IN (
  SELECT t.id FROM tables t WHERE EXISTS (
    SELECT 1 FROM census_base c WHERE c.projectId = t.project_id AND c.datasetId = t.dataset_id
                                AND c.tableId = t.table_id))"""


def _census_refs(v):
    return v.census_tables.select(F.col("projectId").alias("project_id"),
                                  F.col("datasetId").alias("dataset_id"),
                                  F.col("tableId").alias("table_id"))


@register("j12_backups_of_table", _FIND_SQL, ("backups", "tables", "census_base"))
def j12(spark, sf):
    v = TestViews.of(spark, sf)
    return C.backups_of_tables(v.tables, v.backups, _census_refs(v))


@register("j1_stored_backups", "SELECT * FROM all_backups_x", ("all_backups_x",))
def j1_stored(spark, sf):
    """J1 over frames stored by table (`sources.bucketed`)."""
    v = TestViews.of(spark, sf)
    return over_parts(stored_parts(spark, _last_table(v), _last_backup(v)), lambda tables, backups: C.all_backups(backups, tables))


@register("w7_stored_last_backup", _LAST_SQL, ("tables", "newest_avail"))
def w7_stored(spark, sf):
    """W7 over frames stored by table."""
    v = TestViews.of(spark, sf)
    return over_parts(stored_parts(spark, v.tables, v.backups), C.last_backup)


@register("j12_stored_backups_of_table", _FIND_SQL, ("backups", "tables", "census_base"))
def j12_stored(spark, sf):
    """J12 over frames stored by table."""
    v = TestViews.of(spark, sf)
    refs = _census_refs(v)
    return over_parts(stored_parts(spark, v.tables, v.backups), lambda tables, backups: C.backups_of_tables(tables, backups, refs))


@register("q18_find_backups", """
SELECT b.* FROM last_backup_x b WHERE b.parent_id IN (
  SELECT t.id FROM tables t WHERE EXISTS (
    SELECT 1 FROM census_base c WHERE c.projectId = t.project_id AND c.datasetId = t.dataset_id
                                AND c.tableId = t.table_id))""", ("last_backup_x", "tables", "census_base"))
def q18(spark, sf):
    """Q18: S1 (newest export shard) → S3 → J12 for every table the census
    sees."""
    v = TestViews.of(spark, sf)
    shard = X.latest_export(_exports(v)).drop("export_date")
    return C.backups_of_tables(v.tables, X.last_backup(shard), _census_refs(v))


@register("l1_backups_newest_first", """
SELECT id, created, row_number() OVER (ORDER BY created DESC, id DESC) AS rank FROM backups""", ("backups",))
def l1(spark, sf):
    return with_rank(TestViews.of(spark, sf).backups.select("id", "created"), RS.ORDERS["L1"]())


@register("l2_retention_order", """
SELECT id, last_checked, row_number() OVER (ORDER BY last_checked, id) AS rank FROM tables""", ("tables",))
def l2(spark, sf):
    return with_rank(TestViews.of(spark, sf).tables.select("id", "last_checked"), RS.ORDERS["L2"]())


@register("l3_partitions_first", """
SELECT id, partition_id, row_number() OVER (ORDER BY partition_id DESC NULLS LAST, id) AS rank FROM tables""", ("tables",))
def l3(spark, sf):
    return with_rank(TestViews.of(spark, sf).tables.select("id", "partition_id"), RS.ORDERS["L3"]())
