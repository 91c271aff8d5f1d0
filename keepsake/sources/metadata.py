"""Metadata tables (entities, backup records, restore jobs and items) as files.

A table is written in buckets of one key. Replacing it writes only the buckets
whose rows differ, to a staging folder, and publishes them by a
`commit.Ledger`: until that is decided the old state is readable, afterwards
every reader and writer ends what a lost driver left half published. Files of
other buckets stay as they are, so a run that touches few tables writes little.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepsake.sources.commit import FileSystem, Ledger

BUCKET = "_bucket"
BUCKETS = 64
#: Rows go by the first of these columns that a table has: copies lie with their table.
KEYS = ("parent_id", "job_id", "id")


def _ledger(spark: SparkSession, path: str) -> Ledger:
    folder, _, name = path.rstrip("/").rpartition("/")
    return Ledger(FileSystem(spark), f"{folder}/_log/{name}")


def _plain(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.drop(BUCKET) if BUCKET in df.columns else df


def read_metadata(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest decided state of the table at `path`; no rows if there is none yet."""
    ledger = _ledger(spark, path)
    ledger.recover()
    there = ledger.fs.committed(path) and ledger.fs.data_files(path)
    return _plain(spark, path).select(*schema.fieldNames()) if there else spark.createDataFrame([], schema)


def _sums(df: DataFrame, columns: list[str], side: str) -> DataFrame:
    from keepsake.sources.copy import row_hash

    return df.groupBy(BUCKET).agg(F.count(F.lit(1)).alias(f"{side}_n"), F.sum(row_hash(df, columns)).alias(f"{side}_sum"))


def write_metadata(spark: SparkSession, df: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Replace the table at `path` by `df`, which may derive from it.

    Buckets are compared by the number and the checksum of their rows; what the
    driver learns is one row for each bucket that differs."""
    path = path.rstrip("/")
    ledger = _ledger(spark, path)
    ledger.recover()
    fs = ledger.fs
    key = next((k for k in KEYS if k in df.columns), None)
    if key is None:
        raise ValueError(f"no column to bucket by: {', '.join(KEYS)}")
    columns = df.columns
    dealt = lambda x: x.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    new = dealt(df)
    old_files = fs.files(path)
    place = lambda f: int(f.split("/")[0].split("=")[1]) if f.startswith(f"{BUCKET}=") else None
    # files outside the buckets, or of a table with other columns, go as a whole
    whole = any(place(f) is None for f in old_files) or (old_files and sorted(_plain(spark, path).columns) != sorted(columns))
    if whole or not old_files:
        touched = None
    else:
        before, after = _sums(dealt(_plain(spark, path)), columns, "old"), _sums(new, columns, "new")
        same = F.col("old_n").eqNullSafe(F.col("new_n")) & F.col("old_sum").eqNullSafe(F.col("new_sum"))
        touched = [r[0] for r in before.join(after, BUCKET, "full").filter(~same).select(BUCKET).collect()]
        if not touched:
            return
    staging = ledger.staging()
    rows = new if touched is None else new.filter(F.col(BUCKET).isin(touched))
    # rebalanced: a table with a third of all records is more than one task, small buckets are one
    rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{staging}/data")
    staged = fs.files(f"{staging}/data")
    replaced = [f for f in old_files if touched is None or place(f) in touched]
    ledger.commit([], path, staging, [(f"{staging}/data/{f}", f) for f in staged], replaced)
    ledger.forget()
