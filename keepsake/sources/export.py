"""Metadata export (S4 sink) and its read side."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepsake.config import NONE_SENTINEL

KINDS = ("Table", "Backup")


def table_key_path(id_col: str = "id") -> F.Column:
    return F.concat(F.lit('"Table", '), F.col(id_col).cast("string"))


def backup_key_path(parent_col: str = "parent_id", id_col: str = "id") -> F.Column:
    return F.concat(F.lit('"Table", '), F.col(parent_col).cast("string"),
                    F.lit(', "Backup", '), F.col(id_col).cast("string"))


def _envelope(kind: str, path: F.Column, id_col: str) -> list[F.Column]:
    key = F.struct(F.lit(None).cast("string").alias("namespace"),
                   F.lit(None).cast("string").alias("app"), path.alias("path"),
                   F.lit(kind).alias("kind"), F.lit(None).cast("string").alias("name"),
                   F.col(id_col).cast("long").alias("id"))
    return [key.alias("__key__"), F.lit(None).cast("array<string>").alias("__error__"),
            F.lit(False).alias("__has_error__")]


def to_export(df: DataFrame, kind: str) -> DataFrame:
    """The document-store export of one entity kind (D3/D4): entity columns
    plus the `__key__` envelope."""
    if kind == "Table":
        return df.select("project_id", "dataset_id", "table_id", "partition_id", "last_checked",
                         *_envelope(kind, table_key_path(), "id"))
    if kind == "Backup":
        return df.select("created", "deleted", "last_modified",
                         F.col("num_bytes").alias("numBytes"), "table_id", "dataset_id",
                         *_envelope(kind, backup_key_path(), "id"))
    raise ValueError(kind)


def load_export(df: DataFrame, kind: str, export_date: dt.date, root: str) -> str:
    """One load per kind into `<root>/<kind>/export_date=YYYYMMDD`,
    WRITE_TRUNCATE: a rerun on the same day replaces only that day's shard
    (dynamic partition overwrite)."""
    path = f"{root.rstrip('/')}/{kind}"
    (df.withColumn("export_date", F.lit(export_date.strftime("%Y%m%d")))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("export_date").parquet(path))
    return path


def read_export(spark: SparkSession, root: str, kind: str) -> DataFrame:
    return spark.read.option("basePath", f"{root.rstrip('/')}/{kind}").parquet(
        f"{root.rstrip('/')}/{kind}")


def latest_export(df: DataFrame) -> DataFrame:
    """Keep only the newest dated shard, `export_date = (SELECT
    MAX(export_date))`.  The maximum of a partition column is one scalar; as
    a literal it prunes every other shard at planning time, so older shards
    are never read."""
    newest = df.agg(F.max("export_date").alias("m")).first()["m"]
    return df.filter(F.col("export_date") == F.lit(newest))


def latest_shard(spark: SparkSession, root: str, kind: str) -> str | None:
    """S1 on storage: the newest committed `export_date=` directory of a
    kind, found by listing the kind's directory (one listing, no file is
    opened); None when there is no shard."""
    from keepsake.sources.copy import _FS
    fs = _FS(spark)
    base = f"{root.rstrip('/')}/{kind}"
    p, hfs = fs._p(base)
    if not hfs.exists(p):
        return None
    dates = [st.getPath().getName().split("=", 1)[1] for st in hfs.listStatus(p)
             if st.isDirectory() and st.getPath().getName().startswith("export_date=")]
    return max(dates) if dates else None


def read_latest_export(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """The newest shard only, read with its `export_date` column: a static
    partition filter, so older shards are never listed beyond their names."""
    newest = latest_shard(spark, root, kind)
    if newest is None:
        raise FileNotFoundError(f"no {kind} export under {root}")
    return read_export(spark, root, kind).filter(F.col("export_date") == F.lit(newest))


def last_table(export: DataFrame) -> DataFrame:
    """Table entities of an export; NULL partition → 'None' so it can be
    equi-joined."""
    return export.select("project_id", "dataset_id", "table_id",
                         F.coalesce(F.col("partition_id"), F.lit(NONE_SENTINEL)).alias("partition_id"),
                         "last_checked", F.col("__key__.id").alias("id"))


def last_backup(export: DataFrame) -> DataFrame:
    """S3: backup records of an export; the parent id is the second element
    of the comma-separated key path, the key is the path in base64."""
    path = F.col("__key__.path")
    parent = F.trim(F.try_element_at(F.split(path, ","), F.lit(2))).try_cast("long")
    return export.select("created", "deleted", "last_modified", "numBytes", "table_id", "dataset_id",
                         F.base64(F.encode(path, "UTF-8")).alias("key"), parent.alias("parent_id"))
