"""Incremental forms of M3, M6 and M7 with Structured Streaming.

The reference applies callbacks one at a time; here each arrives as rows of
a file stream.  Every sink is idempotent per micro-batch (a replayed batch
rewrites the same directory), so a batch retried after an executor or driver
loss gives the same state.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepsake.operators.restore import fold_item_status
from keepsake.operators.sli import confirm_latency
from keepsake.config import STATUS_DONE, STATUS_FAILED
from keepsake.sources.commit import FileSystem
from keepsake.sources.sli_sink import append_sli

STATUS_EVENT_SCHEMA = T.StructType([T.StructField("item_id", T.LongType()),
                                    T.StructField("event_time", T.TimestampNTZType()),
                                    T.StructField("status", T.StringType()),
                                    T.StructField("message", T.StringType())])


def latest_version(spark: SparkSession, root: str) -> str | None:
    """Newest committed `batch=<n>` directory under root (None if none)."""
    jvm = spark.sparkContext._jvm
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return None
    best = -1
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("batch=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            best = max(best, int(name.split("=", 1)[1]))
    return f"{root.rstrip('/')}/batch={best}" if best >= 0 else None


class EarliestEvents:
    """The earliest terminal event of every item, written in versions.

    A batch writes only the buckets (of item ids) that its events touch, to
    `<root>/batch=<n>/bucket=<b>`; Spark's `_SUCCESS` commits it. A bucket is
    read from its newest committed batch. Merging takes a minimum, so the order
    in which events come does not matter; a batch that is tried again starts
    from the versions before it and writes the same rows over its own. Versions
    that no batch can start from any more are removed, so there are at most two
    of a bucket: the streaming query itself keeps no state at all."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.fs = FileSystem(spark)

    def _versions(self) -> dict[int, list[int]]:
        """bucket -> committed batches that hold it, newest first."""
        found: dict[int, list[int]] = {}
        for name in self.fs.names(self.root):
            if name.startswith("batch=") and self.fs.committed(f"{self.root}/{name}"):
                for part in self.fs.names(f"{self.root}/{name}"):
                    if part.startswith("bucket="):
                        found.setdefault(int(part[7:]), []).append(int(name[6:]))
        return {b: sorted(v, reverse=True) for b, v in found.items()}

    def read(self, before: int | None = None, among: list[int] | None = None) -> DataFrame:
        """item_id, event_time, status, message; of the batches before `before` and the buckets `among`, if given."""
        paths = []
        for bucket, batches in self._versions().items():
            old = [n for n in batches if before is None or n < before]
            if old and (among is None or bucket in among):
                paths.append(f"{self.root}/batch={old[0]}/bucket={bucket}")
        return self.spark.read.schema(STATUS_EVENT_SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], STATUS_EVENT_SCHEMA)

    def merge(self, events: DataFrame, batch_id: int) -> None:
        own = events.filter(F.col("status").isin(STATUS_DONE, STATUS_FAILED)).select(*STATUS_EVENT_SCHEMA.fieldNames())
        bucket = F.pmod(F.xxhash64("item_id"), F.lit(self.buckets)).cast("int").alias("bucket")
        touched = [r[0] for r in own.select(bucket).distinct().collect()]  # at most `buckets` numbers
        if not touched:
            return
        first = (self.read(batch_id, touched).unionByName(own).groupBy("item_id")
                 .agg(F.min(F.struct("event_time", "status", "message")).alias("e")).select("item_id", "e.*"))
        # one file a bucket and no more: rows of a bucket meet in one task, which holds 1 / buckets of them
        (first.select("*", bucket).repartition(len(touched), "bucket").write.mode("overwrite")
         .option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{self.root}/batch={batch_id}"))
        for b, batches in self._versions().items():
            for n in [n for n in batches if n < batch_id][1:]:
                self.fs.delete(f"{self.root}/batch={n}/bucket={b}")


def item_status(spark: SparkSession, items: DataFrame, state_root: str) -> DataFrame:
    """`items` with the status that the events seen so far give them."""
    return fold_item_status(items, EarliestEvents(spark, f"{state_root.rstrip('/')}/_earliest").read())


def stream_item_status(spark: SparkSession, items: DataFrame, events_dir: str, state_root: str,
                       checkpoint: str, available_now: bool = True, write_items: bool = True):
    """M3 as a stream: every micro-batch merges its terminal events into the
    earliest ones known (`EarliestEvents`), then the items as they were at the
    start are folded with all of these. An earlier event that comes late
    corrects an item already written; a batch tried again changes nothing; the
    result is that of the batch form over all events. `write_items` writes the
    folded items as version `batch=<n>` (see `latest_version`); without it
    `item_status` folds them when asked. Returns the started query. One
    `state_root` belongs to one `checkpoint`."""
    events = spark.readStream.schema(STATUS_EVENT_SCHEMA).parquet(events_dir)
    root = state_root.rstrip("/")

    def apply(batch: DataFrame, batch_id: int) -> None:
        EarliestEvents(spark, f"{root}/_earliest").merge(batch, batch_id)
        if write_items:
            item_status(spark, items, root).write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    w = events.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def stream_sli_append(spark: SparkSession, rows_dir: str, schema: T.StructType, live: DataFrame,
                      partitions: DataFrame, table_root: str, checkpoint: str, ingest_date,
                      available_now: bool = True):
    """M7: candidate latency rows are confirmed against the live catalog
    (P17) as they arrive and appended to today's history partition (S10);
    each batch is a run of its own (`append_sli`), so a replay overwrites
    rather than duplicates."""
    rows = spark.readStream.schema(schema).parquet(rows_dir)

    def apply(batch: DataFrame, batch_id: int) -> None:
        confirmed = confirm_latency(batch, live, partitions)
        append_sli(confirmed, table_root, dt.datetime.combine(ingest_date, dt.time()), f"stream-{batch_id}")

    w = rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def stream_dedupe_requests(requests: DataFrame, key: str = "request_key", time_col: str = "requested_at",
                           delay: str = "1 day") -> DataFrame:
    """M6 on a stream: one request per idempotency key within the watermark
    delay; NULL keys are never deduplicated (they bypass the state)."""
    # event time must be TIMESTAMP; NTZ request times are read in the session zone (UTC)
    ntz = dict(requests.dtypes)[time_col] == "timestamp_ntz"
    event = "_event_time" if ntz else time_col
    keyed = requests.filter(F.col(key).isNotNull())
    if ntz:
        keyed = keyed.withColumn(event, F.col(time_col).cast("timestamp"))
    keyed = keyed.withWatermark(event, delay).dropDuplicatesWithinWatermark([key])
    if ntz:
        keyed = keyed.drop(event)
    return keyed.unionByName(requests.filter(F.col(key).isNull()))
