"""Catalog sources: typed live metadata (S9), partition listing (S8) and the
organisation walk as one frame (S7)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepsake.config import DEFAULT_LOCATION
from keepsake.schemas import LIVE_DOCUMENT
from keepsake.session import written
from keepsake.sources import files


def live_catalog(raw: DataFrame) -> DataFrame:
    """Type raw metadata documents once at the scan.

    Input: `project_id, dataset_id, table_id, lookup_status, document` (JSON
    text as the catalog API returns it; NULL when the lookup failed).
    Output: one row per looked-up table with typed columns and the flags the
    predicates need.
    """
    d = F.from_json(F.col("document"), LIVE_DOCUMENT)
    doc = raw.select("project_id", "dataset_id", "table_id", "lookup_status", d.alias("d"))
    tp = F.col("d.timePartitioning")
    ms_ts = lambda c: F.timestamp_millis(c.cast("long")).cast("timestamp_ntz")
    return doc.select(
        "project_id", "dataset_id", "table_id", "lookup_status",
        (F.col("lookup_status") == "found").alias("table_exists"),
        ms_ts(F.col("d.creationTime")).alias("creation_time"),
        ms_ts(F.col("d.lastModifiedTime")).alias("last_modified_time"),
        F.col("d.numBytes").cast("long").alias("num_bytes"),
        F.col("d.numRows").cast("long").alias("num_rows"),
        F.col("d.type").alias("type"),
        F.coalesce(F.col("d.location"), F.lit(DEFAULT_LOCATION)).alias("location"),
        tp.getField("type").alias("time_partitioning_type"),
        tp.getField("expirationMs").alias("partition_expiration_ms"),
        (F.col("d.numRows") == "0").alias("is_empty"),
        F.coalesce(F.col("d.type").isin("VIEW", "EXTERNAL"), F.lit(False)).alias("is_external_or_view"),
        # a schema object counts even with an empty field list; a missing one does not
        F.col("d.schema.fields").isNotNull().alias("is_schema_defined"),
        F.coalesce(tp.getField("type") == "DAY", F.lit(False)).alias("is_daily_partitioned"),
        tp.isNotNull().alias("has_time_partitioning"),
        F.coalesce(tp.getField("expirationMs").isNotNull(), F.lit(False)).alias("has_partition_expiration"),
    )


def list_partitions(census_partitions: DataFrame, live: DataFrame) -> DataFrame:
    """Per partition of every live partitioned table: creation time,
    last-modified time, rows and bytes of its newest snapshot (a table that
    is not found lists nothing).  The newest row per partition is a partial
    aggregate, so the join sees one row per partition."""
    from keepsake.operators.common import latest_by
    per_part = latest_by(census_partitions.select(
        "projectId", "datasetId", "tableId", "partitionId", "snapshotTime", "lastModifiedTime",
        "creationTime", "numRows", "numBytes"),
        ["projectId", "datasetId", "tableId", "partitionId"], "snapshotTime",
        ["lastModifiedTime", "creationTime", "numRows", "numBytes"])
    parted = live.filter(F.col("table_exists") & F.col("has_time_partitioning"))\
        .select("project_id", "dataset_id", "table_id")
    return (per_part.join(parted, (per_part.projectId == parted.project_id)
                          & (per_part.datasetId == parted.dataset_id)
                          & (per_part.tableId == parted.table_id), "inner")
            .select("project_id", "dataset_id", "table_id",
                    F.col("partitionId").alias("partition_id"),
                    F.col("creationTime").alias("creation_time"),
                    F.col("lastModifiedTime").alias("last_modified"),
                    F.col("numRows").alias("num_rows"), F.col("numBytes").alias("num_bytes")))


def select_projects(df: DataFrame, custom: Iterable[str] = (), skip: Iterable[str] = (),
                    column: str = "project_id") -> DataFrame:
    """P5: a non-empty custom list replaces discovery; the skip list applies
    in both cases."""
    custom, skip = list(custom), list(skip)
    out = df
    if custom:
        out = out.filter(F.col(column).isin(custom))
    if skip:
        out = out.filter(~F.col(column).isin(skip))
    return out


def enumerate_sources(live: DataFrame, custom: Iterable[str] = (),
                      skip: Iterable[str] = ()) -> DataFrame:
    """The organisation → project → dataset → table walk as one frame of
    table references (only tables that exist; a missing dataset yields no
    rows)."""
    found = live.filter(F.col("table_exists"))
    return select_projects(found, custom, skip)


def warehouse_tables(spark, warehouse, skip: Iterable[str] = ()) -> DataFrame:
    """References (project_id, dataset_id, table_id) of all tables of a file warehouse, listed level by level in tasks."""
    at = spark.createDataFrame([(warehouse.root.rstrip("/"),)], "path string")
    keys: list[str] = []
    for key in ("project_id", "dataset_id", "table_id"):
        found = files.children(files.spread(at, "path")).filter("is_folder").withColumnRenamed("name", key)
        at = found.select(*keys, key, F.col("child").alias("path"))
        keys.append(key)
        if key == "project_id":
            at = at.filter(~F.col(key).isin(*skip)) if list(skip) else at
    return at.select(*keys)


def warehouse_catalog(spark, warehouse, refs) -> tuple[DataFrame, DataFrame]:
    """S7–S9 over a file warehouse: live metadata and partition listing of
    the given tables (rows or tuples project, dataset, table).  Table folders
    are listed in tasks, then their partition folders, then the footers of
    their files are read, each step dealt anew over the tasks; no row of data
    is read and the driver lists nothing.  Returns (live, partitions) in the
    shapes `live_catalog` / `list_partitions` produce.  A table exists if its
    folder does, so one whose files hold no rows, or that has none yet, is
    found and empty; one whose folder cannot be listed has lookup_status
    'error'."""
    from keepsake.sources.copy import PARTITION_COLUMN

    keys = ["project_id", "dataset_id", "table_id"]
    wanted = refs if isinstance(refs, DataFrame) else spark.createDataFrame(
        [tuple(r) for r in refs], "project_id string, dataset_id string, table_id string")
    wanted = wanted.select(*keys).distinct()
    folder = F.concat_ws("/", F.lit(warehouse.root.rstrip("/")), *keys)
    # a listing is a moment: it is written, so that all that reads it sees the same one
    entries = written(files.children(files.spread(wanted.withColumn("path", folder), "path")), "listing")
    day = F.regexp_extract("name", f"^{PARTITION_COLUMN}=(.*)$", 1)
    below = files.files_below(files.spread(entries.filter("is_folder").select(*keys, F.when(day != "", day).alias("partition_id"),
                                                                              F.col("child").alias("path")), "path"))
    own = entries.filter("NOT is_folder").select(*keys, F.lit(None).cast("string").alias("partition_id"),
                                                 F.col("child").alias("file"), "bytes", "modified")
    counted = files.footers(files.spread(own.unionByName(below), "file"))
    instant = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    per_part = written(counted.groupBy(*keys, "partition_id").agg(
        F.sum("num_rows").alias("num_rows"), F.sum("bytes").alias("num_bytes"),
        instant(F.min("modified")).alias("creation_time"), instant(F.max("modified")).alias("last_modified")), "listing")
    per_table = per_part.groupBy(*keys).agg(
        F.sum("num_rows").alias("num_rows"), F.sum("num_bytes").alias("num_bytes"),
        F.min("creation_time").alias("creation_time"), F.max("last_modified").alias("last_modified_time"),
        F.max(F.col("partition_id").isNotNull()).alias("partitioned"))
    partitions = per_part.filter(F.col("partition_id").isNotNull()).select(
        *keys, "partition_id", "creation_time", "last_modified", "num_rows", "num_bytes")
    j = entries.groupBy(*keys).agg(F.first("status").alias("status")).join(per_table, keys, "left")
    found = F.col("status") == files.FOUND
    known = F.when(F.col("status") != files.ERROR, found)
    count = lambda c: F.when(found, F.coalesce(F.col(c), F.lit(0)))
    partitioned = F.coalesce(F.col("partitioned"), F.lit(False))
    live = j.select(
        *keys, F.col("status").alias("lookup_status"),
        known.alias("table_exists"), "creation_time", "last_modified_time", count("num_bytes").alias("num_bytes"),
        count("num_rows").alias("num_rows"),
        F.when(found, "TABLE").alias("type"), F.lit(DEFAULT_LOCATION).alias("location"),
        F.when(partitioned, "DAY").alias("time_partitioning_type"),
        F.lit(None).cast("long").alias("partition_expiration_ms"), (count("num_rows") == 0).alias("is_empty"),
        F.lit(False).alias("is_external_or_view"), known.alias("is_schema_defined"),
        partitioned.alias("is_daily_partitioned"), partitioned.alias("has_time_partitioning"),
        F.lit(False).alias("has_partition_expiration"))
    return live, partitions

