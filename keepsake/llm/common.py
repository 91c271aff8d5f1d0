"""What the operators of this package share: word patterns, row keys and written intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keepsake.session import checkpoint_root

# The two word patterns, in the dialect that Java, RE2 and Python share.
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ALNUM_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACE_WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written as Parquet under the cluster's checkpoint folder and read back.

    It cuts the lineage as `checkpoint()` does, with columnar files: a lost
    executor costs a re-read, later jobs read only the columns they need.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a `stored` table that no later job reads."""
    spark = df.sparkSession
    root = checkpoint_root(spark)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if path.getParent().getName() == jvm.org.apache.hadoop.fs.Path(root).getName():
            path.getFileSystem(conf).delete(path, True)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other character, accented capitals included, as it is."""
    return F.translate(text, UPPER, LOWER)


def alnum_words(text: Column) -> Column:
    """Lower-cased words, the matches of ALNUM_WORD; null has none.

    Cut at the runs of all other characters, which costs a tenth of collecting
    the matches; empty pieces before the first and after the last word go.
    """
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), ALNUM_BREAK), "")


def text_key(text: Column) -> Column:
    """64-bit content hash; with `doc_id` it names a row by value, so a recomputed task names it alike."""
    return F.xxhash64(text)


def require(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
