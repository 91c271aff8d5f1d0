"""Incremental forms equal their batch forms (M3, M6, M7)."""

import datetime as dt
import os

from pyspark.sql import functions as F

from keepsake.operators import restore as RS
from keepsake.operators import sli as S
from keepsake.schemas import LATENCY_SLI
from keepsake.sources.testviews import TestViews
from keepsake.streaming import incremental as INC

SF = "/root/testdata/sf0.001"


def _norm(df):
    return sorted(tuple(r) for r in df.select("id", "status", "status_message", "completed").collect())


def test_item_status_stream_equals_batch(spark, scratch):
    v = TestViews(spark, SF)
    items, events = v.restore_items, v.status_events
    # events arrive in two files: first terminal events, then the later ones
    first = events.filter(F.hour("event_time") == 0)
    later = events.filter(F.hour("event_time") != 0)
    d = os.path.join(scratch, "events")
    first.write.parquet(d + "/part1")
    state, ckpt = os.path.join(scratch, "state"), os.path.join(scratch, "ckpt")
    q = INC.stream_item_status(spark, items, d + "/part1", state, ckpt)
    q.awaitTermination(120)
    q2_src = d + "/part1"
    later.write.mode("append").parquet(q2_src)
    q = INC.stream_item_status(spark, items, q2_src, state, ckpt)
    q.awaitTermination(120)
    streamed = spark.read.parquet(INC.latest_version(spark, state))
    assert _norm(streamed) == _norm(RS.fold_item_status(items, events))


def test_sli_stream_append_equals_batch(spark, scratch):
    v = TestViews(spark, SF)
    from keepsake.checks.q_sli import _latency
    from keepsake.sources import sli_sink as K
    from keepsake.sources.testviews import AS_OF
    rows = K.conform(K.typed_latency_rows(_latency(v, 0), AS_OF, 0), "latency")
    src = os.path.join(scratch, "rows")
    rows.write.parquet(src)
    table = os.path.join(scratch, "history")
    q = INC.stream_sli_append(spark, src, LATENCY_SLI, v.live, v.partitions, table,
                              os.path.join(scratch, "ckpt"), AS_OF.date())
    q.awaitTermination(120)
    got = spark.read.parquet(table).drop("ingest_date", "batch_id")
    want = S.confirm_latency(rows, v.live, v.partitions)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


import pytest


@pytest.mark.parametrize("ts_type", ["timestamp", "timestamp_ntz"])
def test_dedupe_stream_keeps_null_keys(spark, scratch, ts_type):
    src = os.path.join(scratch, "reqs")
    t0 = dt.datetime(2024, 1, 1)
    schema = f"request_key string, requested_at {ts_type}"
    spark.createDataFrame([("k1", t0), ("k1", t0 + dt.timedelta(minutes=5)), (None, t0), (None, t0),
                           ("k2", t0)], schema).write.parquet(src)
    stream = spark.readStream.schema(schema).parquet(src)
    out = os.path.join(scratch, "out")
    q = (INC.stream_dedupe_requests(stream).writeStream.format("parquet")
         .option("checkpointLocation", os.path.join(scratch, "ck")).option("path", out)
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    keys = sorted((r["request_key"] or "") for r in spark.read.parquet(out).collect())
    assert keys == ["", "", "k1", "k2"]


def _hour(h):
    return dt.datetime(2024, 1, 30, h)


def _item_frame(spark, n):
    return spark.createDataFrame([(i, "In Progress", None, None) for i in range(n)],
                                 "id long, status string, status_message string, completed timestamp_ntz")


def test_late_earlier_events_correct_items_already_written(spark, scratch):
    items = _item_frame(spark, 40)
    src, state, ckpt = (os.path.join(scratch, x) for x in ("events", "state", "ckpt"))
    batches = [[(0, _hour(12), "Failed", "late"), (1, _hour(9), "Done", None), (2, _hour(8), "Running", None)],
               [(0, _hour(10), "Done", None), (1, _hour(11), "Failed", "later"), (3, _hour(5), "Failed", "x")],
               [(0, _hour(11), "Failed", "between"), (3, _hour(5), "Done", None), (99, _hour(1), "Done", None)]]
    for rows in batches:
        spark.createDataFrame(rows, INC.STATUS_EVENT_SCHEMA).write.mode("append").parquet(src)
        INC.stream_item_status(spark, items, src, state, ckpt).awaitTermination(120)
    want = RS.fold_item_status(items, spark.read.schema(INC.STATUS_EVENT_SCHEMA).parquet(src))
    assert _norm(spark.read.parquet(INC.latest_version(spark, state))) == _norm(want)
    assert _norm(INC.item_status(spark, items, state)) == _norm(want)
    assert {r["id"]: r["status"] for r in want.filter("id < 4").collect()} == {0: "Done", 1: "Done", 2: "In Progress", 3: "Done"}


def test_a_batch_tried_again_changes_nothing(spark, scratch):
    store = INC.EarliestEvents(spark, scratch, buckets=4)
    rows = [[(i, _hour(h), "Done", f"{n}") for i in range(n, 30, n + 1)] for n, h in enumerate((9, 7, 11))]
    frames = [spark.createDataFrame(r, INC.STATUS_EVENT_SCHEMA) for r in rows]
    for n, f in enumerate(frames):
        store.merge(f, n)
        once = sorted(map(tuple, store.read().collect()))
        store.merge(f, n)  # the driver was lost before the stream took note of the batch
        assert sorted(map(tuple, store.read().collect())) == once
    first = {}
    for i, t, _, m in [x for r in rows for x in r]:
        first[i] = min(first.get(i, (t, m)), (t, m))
    assert [(r[0], (r[1], r[3])) for r in once] == sorted(first.items())
    assert max(len(v) for v in store._versions().values()) <= 2
    untouched = [b for b, v in store._versions().items() if 2 not in v]
    store.merge(frames[2].filter("item_id = 2"), 3)
    assert untouched == [b for b, v in store._versions().items() if 2 not in v and 3 not in v]
    store.merge(frames[2].limit(0), 4)
    assert sorted(map(tuple, store.read().collect())) == once


def test_an_sli_run_tried_again_leaves_the_rows_as_they_were(spark, scratch):
    from keepsake.checks.q_sli import _latency
    from keepsake.sources import sli_sink as K
    from keepsake.sources.testviews import AS_OF
    v = TestViews(spark, SF)
    rows = K.conform(K.typed_latency_rows(_latency(v, 0), AS_OF, 0), "latency")
    src, table = os.path.join(scratch, "rows"), os.path.join(scratch, "history")
    rows.write.parquet(src)
    one = sorted(map(str, rows.collect()))
    read = lambda: sorted(str(r) for r in K.read_sli(spark, table, "latency").drop("ingest_date").collect())
    later = AS_OF + dt.timedelta(hours=6)
    K.append_sli(rows, table, AS_OF)
    K.append_sli(rows, table, AS_OF)
    assert read() == one
    K.append_sli(rows, table, later)
    K.append_sli(rows.limit(0), table, AS_OF + dt.timedelta(days=1), "nothing to say / yet")
    assert read() == sorted(one * 2)
    K.append_sli(rows.limit(1), table, later)  # the run found less this time: its own rows go, no others
    assert len(read()) == len(one) + 1
    K.append_sli(rows, table, later)
    # the stream writes to the same history; its first batch is tried again under a checkpoint that was lost
    for n in range(2):
        INC.stream_sli_append(spark, src, LATENCY_SLI, v.live, v.partitions, table, os.path.join(scratch, f"ck{n}"), AS_OF.date()).awaitTermination(120)
        assert read() == sorted(one * 2 + [str(r) for r in S.confirm_latency(rows, v.live, v.partitions).collect()])
    assert K.read_sli(spark, table, "latency").select("ingest_date").distinct().count() == 1
