"""Joins over table entities and their copies: J1, W6, W7, J12."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepsake.operators.common import latest_by

ALL_BACKUPS_COLUMNS = ("source_project_id", "source_dataset_id", "source_table_id",
                       "source_partition_id", "source_table_last_checked", "table_entity_id",
                       "backup_created", "backup_deleted", "backup_last_modified",
                       "backup_num_bytes", "backup_table_id", "backup_dataset_id", "backupBqKey")


def all_backups(last_backup: DataFrame, last_table: DataFrame) -> DataFrame:
    """Every exported copy with its source table (INNER on parent_id =
    id), 13 columns.  Inputs are the S3 / S2 frames."""
    b, t = last_backup.alias("b"), last_table.alias("t")
    return b.join(t, F.col("b.parent_id") == F.col("t.id"), "inner").select(
        F.col("t.project_id").alias("source_project_id"),
        F.col("t.dataset_id").alias("source_dataset_id"),
        F.col("t.table_id").alias("source_table_id"),
        F.col("t.partition_id").alias("source_partition_id"),
        F.col("t.last_checked").alias("source_table_last_checked"),
        F.col("t.id").alias("table_entity_id"),
        F.col("b.created").alias("backup_created"),
        F.col("b.deleted").alias("backup_deleted"),
        F.col("b.last_modified").alias("backup_last_modified"),
        F.col("b.numBytes").alias("backup_num_bytes"),
        F.col("b.table_id").alias("backup_table_id"),
        F.col("b.dataset_id").alias("backup_dataset_id"),
        F.col("b.key").alias("backupBqKey"))


def last_available_backup(all_backups_df: DataFrame) -> DataFrame:
    """Newest available copy per table entity (ties: greatest key)."""
    avail = all_backups_df.filter(F.col("backup_deleted").isNull())
    return latest_by(avail, ["table_entity_id"], "backup_created", ["backupBqKey"])


def newest_available(backups: DataFrame) -> DataFrame:
    """Newest available copy per parent table (ties: greatest id), as an
    aggregate so a hot table is reduced map-side."""
    avail = backups.filter(F.col("deleted").isNull())
    return latest_by(avail, ["parent_id"], "created", ["id"])


def last_backup(tables: DataFrame, backups: DataFrame) -> DataFrame:
    """Every table entity with its newest available copy; NULL copy
    columns when it has none."""
    newest = newest_available(backups).select(
        "parent_id", F.col("id").alias("backup_id"), F.col("created").alias("backup_created"),
        F.col("last_modified").alias("backup_last_modified"),
        F.col("num_bytes").alias("backup_num_bytes"),
        F.col("dataset_id").alias("backup_dataset_id"), F.col("table_id").alias("backup_table_id"))
    return tables.join(newest, tables["id"] == newest["parent_id"], "left").drop("parent_id")


def backups_of_tables(tables: DataFrame, backups: DataFrame, refs: DataFrame) -> DataFrame:
    """Copies whose parent is a table entity matching one of `refs`
    (project_id, dataset_id, table_id; a NULL partition in refs matches any
    partition of the table)."""
    r = refs.select(F.col("project_id").alias("r_p"), F.col("dataset_id").alias("r_d"),
                    F.col("table_id").alias("r_t")).distinct()
    ids = (tables.join(r, (tables.project_id == r.r_p) & (tables.dataset_id == r.r_d)
                       & (tables.table_id == r.r_t), "left_semi")
           .select(F.col("id").alias("parent_id")))
    return backups.join(ids, "parent_id", "left_semi")
