"""SLI history rows (S16), run markers (S11) and the history sink."""

from __future__ import annotations

import datetime as dt
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepsake.config import NONE_SENTINEL, SNAPSHOT_MARKER
from keepsake.functions.timeutil import ts_lit
from keepsake.schemas import LATENCY_SLI, QUALITY_SLI

EPOCH = dt.datetime(1970, 1, 1)


def typed_latency_rows(sli: DataFrame, snapshot_time: dt.datetime, x_days: int | None) -> DataFrame:
    """S16 (latency): view columns → D10 rows with snapshotTime and xDays
    (from the frame's `x` column when x_days is None)."""
    x = F.col("x").cast("string") if x_days is None else F.lit(str(x_days))
    return sli.select(ts_lit(snapshot_time).alias("snapshotTime"), "projectId", "datasetId", "tableId",
                      "partitionId", "creationTime", "lastModifiedTime",
                      F.col("backup_created").alias("backupCreated"),
                      F.col("backup_last_modified").alias("backupLastModified"),
                      x.alias("xDays"))


def typed_quality_rows(sli: DataFrame, snapshot_time: dt.datetime) -> DataFrame:
    """S16 (quality): view columns → D11 rows; nullable backup* stay NULL."""
    return sli.select(ts_lit(snapshot_time).alias("snapshotTime"),
                      F.col("source_project_id").alias("projectId"),
                      F.col("source_dataset_id").alias("datasetId"),
                      F.col("source_table_id").alias("tableId"),
                      F.col("source_partition_id").alias("partitionId"),
                      F.col("backup_dataset_id").alias("backupDatasetId"),
                      F.col("backup_table_id").alias("backupTableId"),
                      F.col("source_last_modified").alias("lastModifiedTime"),
                      F.col("backup_last_modified").alias("backupLastModifiedTime"),
                      F.col("backup_entity_last_modified").alias("backupEntityLastModifiedTime"),
                      F.col("source_num_bytes").alias("numBytes"),
                      F.col("backup_num_bytes").alias("backupNumBytes"),
                      F.col("backup_entity_num_bytes").alias("backupEntityNumBytes"),
                      F.col("source_num_rows").alias("numRows"),
                      F.col("backup_num_rows").alias("backupNumRows"))


def snapshot_marker(spark: SparkSession, kind: str, snapshot_time: dt.datetime,
                    x_days: int | None = None) -> DataFrame:
    """Exactly one marker row per run ('a run happened'), zero/epoch
    values; unioned into the history before the violations."""
    one = spark.range(1)
    m = F.lit(SNAPSHOT_MARKER)
    epoch = ts_lit(EPOCH)
    if kind == "latency":
        return one.select(ts_lit(snapshot_time).alias("snapshotTime"), m.alias("projectId"),
                          m.alias("datasetId"), m.alias("tableId"), m.alias("partitionId"),
                          epoch.alias("creationTime"), epoch.alias("lastModifiedTime"),
                          epoch.alias("backupCreated"), epoch.alias("backupLastModified"),
                          F.lit(str(x_days)).alias("xDays"))
    if kind == "quality":
        z = F.lit(0).cast("long")
        return one.select(ts_lit(snapshot_time).alias("snapshotTime"), m.alias("projectId"),
                          m.alias("datasetId"), m.alias("tableId"), m.alias("partitionId"),
                          m.alias("backupDatasetId"), m.alias("backupTableId"),
                          epoch.alias("lastModifiedTime"), epoch.alias("backupLastModifiedTime"),
                          epoch.alias("backupEntityLastModifiedTime"), z.alias("numBytes"),
                          z.alias("backupNumBytes"), z.alias("backupEntityNumBytes"),
                          z.alias("numRows"), z.alias("backupNumRows"))
    raise ValueError(kind)


def conform(df: DataFrame, kind: str) -> DataFrame:
    schema = LATENCY_SLI if kind == "latency" else QUALITY_SLI
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def with_ingest_date(df: DataFrame, as_of: dt.datetime) -> DataFrame:
    return df.withColumn("ingest_date", F.lit(as_of.date()))


def append_sli(df: DataFrame, path: str, as_of: dt.datetime, run: str | None = None) -> None:
    """The rows of one run in today's ingest partition (`ingest_date=`).

    A run has a folder of its own in it (`batch_id=`, named by its time unless a
    name is given) and replaces that folder only: a run that is tried again
    leaves the rows as they were, other runs of the day stay."""
    run = run or as_of.strftime("%Y%m%dT%H%M%S%f")
    place = f"{path.rstrip('/')}/ingest_date={as_of.date()}/batch_id={quote(run, safe='')}"
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(place)


def read_sli(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The history that `append_sli` (S10) and the stream (M7) wrote: the columns of `kind` and `ingest_date`."""
    schema = LATENCY_SLI if kind == "latency" else QUALITY_SLI
    stored = T.StructType([*schema.fields, T.StructField("ingest_date", T.DateType()), T.StructField("batch_id", T.StringType())])
    return spark.read.schema(stored).parquet(path).drop("batch_id")
