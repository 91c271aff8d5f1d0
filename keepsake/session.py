"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library's semantics depend on (not tuning): all timestamps are
# naive UTC, and the driver's parquet timestamps read as TIMESTAMP_NTZ.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Tuning defaults for a fresh session; a cluster's own values win because
# `builder.config` only applies when the session is created here.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # reliable checkpoints of finished jobs are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "keepsake", checkpoint_dir: str | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **REQUIRED_CONF}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and job state.

    On a cluster this is `spark.checkpoint.dir` (a shared file system), and
    its absence is an error; a temporary folder stands in under a local master
    only, where all tasks share one machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="keepsake-ckpt-", dir=os.environ.get("KEEPSAKE_TMP", "/tmp"))
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` written once as Parquet to the shared checkpoint folder and read back.

    For a frame that several parts of a plan read: it is computed once, all of
    them see the same rows, and a lost executor costs a re-read."""
    path = f"{checkpoint_root(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
