"""A restore that is stopped anywhere and run again gives the rows and outcomes of one that was not."""

import pytest
from pyspark.sql import functions as F

from keepsake.sources import commit
from keepsake.sources import copy as CP
from tests.test_data_safety import ITEM, _versions


class Stopped(BaseException):
    """The driver is gone: nothing handles it."""


def _job(spark, write, parts, job="j1"):
    rows = [(i, ("backup", "bk", f"v{i}", p), ("r", "d", "t", p), "CREATE_IF_NEEDED", write, job) for i, p in enumerate(parts)]
    return spark.createDataFrame(rows, ITEM + ", job_id string")


def _state(spark, wh, got):
    df = spark.read.parquet(wh.path("r", "d", "t"))
    day = F.col(CP.PARTITION_COLUMN).cast("string") if CP.PARTITION_COLUMN in df.columns else F.lit("")
    rows = sorted(map(tuple, df.groupBy(day.alias("d")).agg(F.count(F.lit(1)), F.sum("id")).collect()))
    return rows, sorted((r["item_id"], r["state"], r["error_reason"]) for r in got.collect())


def _before(spark, wh, partitioned):
    df = spark.range(100, 103)
    if partitioned:
        df.withColumn(CP.PARTITION_COLUMN, F.lit("20240102")).write.partitionBy(CP.PARTITION_COLUMN).parquet(wh.path("r", "d", "t"))
    else:
        df.write.parquet(wh.path("r", "d", "t"))


@pytest.mark.parametrize("write, parts", [("WRITE_APPEND", ["20240101", "20240102", "20240101"]), ("WRITE_TRUNCATE", ["20240101", "20240102", "20240101"]),
                                          ("WRITE_EMPTY", ["20240101", "20240102", "20240101"]), ("WRITE_TRUNCATE", [None, None])])
def test_stopped_anywhere_and_run_again(spark, scratch, monkeypatch, write, parts):
    def place(name):
        wh = CP.Warehouse(f"{scratch}/{name}")
        _versions(spark, wh, 5, 7, 9)
        _before(spark, wh, parts[0] is not None)
        return wh

    wh = place("whole")
    want = _state(spark, wh, CP.restore_copy(spark, _job(spark, write, parts), wh, 1))
    left, steps = [0], []

    def stopping(name):
        real = getattr(commit.FileSystem, name)

        def step(self, *a):
            if left[0] == 0:
                raise Stopped(name)
            left[0] -= 1
            return real(self, *a)
        monkeypatch.setattr(commit.FileSystem, name, step)

    for name in ("rename", "write", "touch"):
        stopping(name)
    k = 0
    while True:
        wh, left[0] = place(f"stop{k}"), k
        try:
            got = CP.restore_copy(spark, _job(spark, write, parts), wh, 1)
        except Stopped as e:
            steps.append(str(e))
            left[0] = -1
            got = CP.restore_copy(spark, _job(spark, write, parts), wh, 1)
            assert _state(spark, wh, got) == want, f"stopped before step {k} ({e})"
            k += 1
        else:
            break
    assert {"write", "rename", "touch"} == set(steps) and len(steps) >= 6


def test_a_finished_job_run_again_writes_nothing(spark, scratch):
    wh = CP.Warehouse(scratch)
    _versions(spark, wh, 5, 7)
    first = _state(spark, wh, CP.restore_copy(spark, _job(spark, "WRITE_APPEND", [None, None]), wh))
    assert first[0] == [("", 12, 31)]
    assert _state(spark, wh, CP.restore_copy(spark, _job(spark, "WRITE_APPEND", [None, None]), wh)) == first
    # another job is another wish, and items without a job have no record
    assert _state(spark, wh, CP.restore_copy(spark, _job(spark, "WRITE_APPEND", [None, None], "j/2"), wh))[0] == [("", 24, 62)]
    assert _state(spark, wh, CP.restore_copy(spark, _job(spark, "WRITE_APPEND", [None, None]).drop("job_id"), wh))[0] == [("", 36, 93)]
    assert CP._FS(spark).names(f"{scratch}/_restores") == ["job-j%2F2", "job-j1"]


def test_an_empty_copy_replaces_a_partition(spark, scratch):
    wh = CP.Warehouse(scratch)
    spark.range(0).write.parquet(wh.path("backup", "bk", "v0"))
    _before(spark, wh, True)
    spark.range(2).withColumn(CP.PARTITION_COLUMN, F.lit("20240109")).write.partitionBy(CP.PARTITION_COLUMN).mode("append").parquet(wh.path("r", "d", "t"))
    got = CP.restore_copy(spark, _job(spark, "WRITE_TRUNCATE", ["20240102"]), wh).first()
    assert got["error_reason"] is None and got["num_bytes"] == 0
    assert [r[0] for r in spark.read.parquet(wh.path("r", "d", "t")).groupBy(F.col(CP.PARTITION_COLUMN).cast("string")).count().collect()] == ["20240109"]


def test_a_refusal_stays_what_it_was(spark, scratch):
    """An item that was refused is refused again, though the table is empty by then; one that failed is tried again."""
    wh = CP.Warehouse(scratch)
    _versions(spark, wh, 5)
    _before(spark, wh, False)
    items = _job(spark, "WRITE_EMPTY", [None, None])  # the copy of the second item does not exist
    assert [r["error_reason"] for r in CP.restore_copy(spark, items, wh).orderBy("item_id").collect()] == ["duplicate", "notFound"]
    spark.range(7).write.parquet(wh.path("backup", "bk", "v1"))
    CP._FS(spark).delete(wh.path("r", "d", "t"))
    assert [r["error_reason"] for r in CP.restore_copy(spark, items, wh).orderBy("item_id").collect()] == ["duplicate", None]
