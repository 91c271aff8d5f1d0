"""Data movement: snapshot copies (S12), restores with dispositions (S13),
deleting copies (S14), and copy verification (Q19).

A warehouse is a directory tree `<root>/<project>/<dataset>/<table>` of
parquet tables; a day-partitioned table is written with the partition
column `_partition_id` (yyyymmdd), so one partition is one directory and
copying or restoring it touches nothing else (partition pruning on read,
dynamic partition overwrite on write).

Each source table is its own Spark job (schemas differ from table to table,
so tables cannot share one plan); all changed partitions of one table share
that job.  The plan frame is streamed to the driver with `toLocalIterator()`;
only a bounded number of jobs is in flight, and their outcomes are appended
page by page to a result table in the shared checkpoint folder, so the driver
holds neither the plan nor the results.  Data is always written to a staging
directory and renamed into place; only a `_SUCCESS` marker makes a copy count.
"""

from __future__ import annotations

import datetime as dt
import itertools
import uuid
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepsake.session import checkpoint_root
from keepsake.sources import files as FT
from keepsake.sources.commit import FileSystem, Ledger, restore_ledger

PARTITION_COLUMN = "_partition_id"
#: Outcomes held by the driver before they are appended to the result table.
PAGE = 1000

COPY_RESULT_SCHEMA = T.StructType([
    T.StructField("source_project_id", T.StringType()), T.StructField("source_dataset_id", T.StringType()),
    T.StructField("source_table_id", T.StringType()), T.StructField("source_partition_id", T.StringType()),
    T.StructField("target_project_id", T.StringType()), T.StructField("target_dataset_id", T.StringType()),
    T.StructField("target_table_id", T.StringType()), T.StructField("target_partition_id", T.StringType()),
    T.StructField("state", T.StringType()), T.StructField("error_reason", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("start_time", T.TimestampNTZType()), T.StructField("end_time", T.TimestampNTZType()),
    T.StructField("num_rows", T.LongType()), T.StructField("num_bytes", T.LongType()),
    T.StructField("item_id", T.LongType())])


@dataclass(frozen=True)
class Warehouse:
    root: str

    def path(self, project: str, dataset: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{project}/{dataset}/{table}"


_FS = FileSystem


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _rows(spark: SparkSession, path: str) -> int:
    # Only row counts from parquet footers are read.
    return spark.read.parquet(path).count()


def data_bytes(df: DataFrame) -> int:
    """Bytes of the data files behind a (pruned) scan, from the hidden file
    metadata only; the same measure the warehouse catalog reports."""
    r = (df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s"))
         .distinct().agg(F.sum("s").alias("b")).first())
    return int(r["b"] or 0)


def read_table(spark: SparkSession, path: str, partition_id: str | list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if partition_id is not None:
        if PARTITION_COLUMN not in df.columns:
            raise ValueError("Cannot read partition information from a table that is not partitioned")
        asked = [partition_id] if isinstance(partition_id, str) else partition_id
        # partition values may be inferred as numbers; compare as text
        df = df.filter(F.col(PARTITION_COLUMN).cast("string").isin(asked))
    return df


def _run_paged(spark: SparkSession, fn: Callable[..., list[tuple]], work: Iterable, parallelism: int,
               schema: T.StructType) -> DataFrame:
    """Run `fn` over `work` from a pool and collect its rows in a result table.

    `work` is drawn only as jobs finish (twice the parallelism is in flight),
    and every PAGE outcomes are appended to Parquet in the checkpoint folder."""
    path = f"{checkpoint_root(spark)}/outcomes-{uuid.uuid4().hex}"
    page: list[tuple] = []

    def flush() -> None:
        spark.createDataFrame(page, schema).coalesce(1).write.mode("append").parquet(path)
        page.clear()

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        source, running = iter(work), deque()
        while True:
            for item in itertools.islice(source, 2 * max(1, parallelism) - len(running)):
                running.append(pool.submit(fn, item))
            if not running:
                break
            page += running.popleft().result()
            if len(page) >= PAGE:
                flush()
    flush()
    return spark.read.schema(schema).parquet(path)


def _result(**r) -> tuple:
    return tuple(r.get(n) for n in COPY_RESULT_SCHEMA.fieldNames())


def _iter_rows(plan: DataFrame | Iterable) -> Iterator:
    if isinstance(plan, DataFrame):
        return plan.toLocalIterator()
    return iter(plan)


# ---------------------------------------------------------------- S12
def _reason(e: Exception) -> str:
    return "notFound" if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e) else "internalError"


def snapshot_copy(spark: SparkSession, plan: DataFrame | Iterable[Row], warehouse: Warehouse,
                  backup_project: str, parallelism: int = 4) -> DataFrame:
    """Copy each planned table/partition whole to
    `<backup_project>/<target_dataset_id>/<target_table_id>` with
    CREATE_IF_NEEDED + WRITE_EMPTY.  A target that is already committed is a
    'duplicate' (not retried); a target without `_SUCCESS` was left by a lost
    job and is replaced, so a rerun converges.  Returns one result row per copy.

    The plan is streamed sorted by source table; all changed partitions of one
    table are copied by one Spark job (10 tables x 500 partitions are 10 jobs).
    If that job fails, its requests are tried one by one, so that a bad one
    does not fail its neighbours."""
    fs = _FS(spark)
    if isinstance(plan, DataFrame):
        plan = plan.orderBy("project_id", "dataset_id", "table_id", "partition_id")

    def outcome(r, started: dt.datetime, **more) -> tuple:
        return _result(source_project_id=r["project_id"], source_dataset_id=r["dataset_id"],
                       source_table_id=r["table_id"], source_partition_id=r["partition_id"],
                       target_project_id=backup_project, target_dataset_id=r["target_dataset_id"],
                       target_table_id=r["target_table_id"], start_time=started, end_time=_now(),
                       state="DONE", **more)

    def target(r) -> str:
        return warehouse.path(backup_project, r["target_dataset_id"], r["target_table_id"])

    def staged(group: list, staging: str) -> dict:
        """Write the requests of one table below `staging`; (bytes, rows) by request position."""
        r0 = group[0]
        src = warehouse.path(r0["project_id"], r0["dataset_id"], r0["table_id"])
        sizes = {}
        for i, r in enumerate(group):
            if r["partition_id"] is None:
                data = read_table(spark, src)
                data.write.parquet(f"{staging}/_target={i}")
                sizes[i] = (data_bytes(data), _rows(spark, f"{staging}/_target={i}"))
        days = [(r["partition_id"], i) for i, r in enumerate(group) if r["partition_id"] is not None]
        if days:
            data = read_table(spark, src, [d for d, _ in days])
            key = F.col(PARTITION_COLUMN).cast("string")
            # one row for each asked partition of this one table
            found = {row["p"]: (int(row["b"]), int(row["n"])) for row in
                     data.select(key.alias("p"), F.col("_metadata.file_path").alias("f"),
                                 F.col("_metadata.file_size").alias("s"))
                     .groupBy("p", "f").agg(F.max("s").alias("s"), F.count(F.lit(1)).alias("n"))
                     .groupBy("p").agg(F.sum("s").alias("b"), F.sum("n").alias("n")).collect()}
            mapping = spark.createDataFrame(days, "_day string, _target int")
            data.join(mapping, key == F.col("_day")).drop("_day").write.partitionBy("_target").parquet(f"{staging}/days")
            for day, i in days:
                place = f"{staging}/_target={i}"
                if fs.exists(f"{staging}/days/_target={i}"):
                    fs.rename(f"{staging}/days/_target={i}", place)
                else:  # a partition without rows: an empty copy with the source schema
                    spark.createDataFrame([], data.schema).write.parquet(place)
                sizes[i] = found.get(day, (0, 0))
        return sizes

    def one_table(group: list) -> list[tuple]:
        started, out, todo = _now(), [], []
        for r in group:
            if fs.committed(target(r)):
                out.append(outcome(r, started, error_reason="duplicate", error_message="Already Exists: " + target(r),
                                   num_bytes=fs.size(target(r))))
            else:
                todo.append(r)
        if not todo:
            return out
        dataset_dir = warehouse.path(backup_project, todo[0]["target_dataset_id"], "").rstrip("/")
        staging = f"{dataset_dir}/_staging_{uuid.uuid4().hex}"
        try:
            sizes = staged(todo, staging)
            for i, r in enumerate(todo):
                dst = target(r)
                if fs.exists(dst):
                    fs.delete(dst)  # left by an earlier, lost attempt
                if not fs.rename(f"{staging}/_target={i}", dst):
                    raise OSError(f"cannot rename into {dst}")
                fs.touch(dst + "/_SUCCESS")
                out.append(outcome(r, started, num_bytes=sizes[i][0], num_rows=sizes[i][1]))
        except Exception as e:  # noqa: BLE001 - a failed copy is a result row
            done = len(out) - (len(group) - len(todo))
            left = todo[done:]
            if len(todo) == 1:
                out.append(outcome(todo[0], started, error_reason=_reason(e), error_message=str(e)))
            else:
                out += [x for r in left for x in one_table([r])]
        finally:
            if fs.exists(staging):
                fs.delete(staging)
        return out

    key = lambda r: (r["project_id"], r["dataset_id"], r["table_id"])
    # one group is the changed partitions of one table
    groups = (list(g) for _, g in itertools.groupby(_iter_rows(plan), key=key))
    return _run_paged(spark, one_table, groups, parallelism, COPY_RESULT_SCHEMA)


def as_job_documents(results: DataFrame) -> DataFrame:
    """Copy results in the copy-job document shape (D12) that P21/M2 read."""
    ms = lambda c: F.unix_millis(F.col(c).cast("timestamp")).cast("string")
    src_tid = F.concat(F.col("source_table_id"),
                       F.coalesce(F.concat(F.lit("$"), F.col("source_partition_id")), F.lit("")))
    err = F.when(F.col("error_reason").isNotNull(), F.struct(F.col("error_reason").alias("reason"),
                                                             F.col("error_message").alias("message")))
    return results.select(
        F.struct(F.col("target_project_id").alias("projectId"),
                 F.concat(F.lit("copy_"), F.col("target_table_id")).alias("jobId")).alias("jobReference"),
        F.struct(F.struct(
            F.struct(F.col("source_project_id").alias("projectId"), F.col("source_dataset_id").alias("datasetId"),
                     src_tid.alias("tableId")).alias("sourceTable"),
            F.struct(F.col("target_project_id").alias("projectId"), F.col("target_dataset_id").alias("datasetId"),
                     F.col("target_table_id").alias("tableId")).alias("destinationTable"),
            F.lit("CREATE_IF_NEEDED").alias("createDisposition"),
            F.lit("WRITE_EMPTY").alias("writeDisposition")).alias("copy")).alias("configuration"),
        F.struct(F.col("state").alias("state"), err.alias("errorResult"),
                 F.when(err.isNotNull(), F.array(err)).alias("errors")).alias("status"),
        F.struct(ms("start_time").alias("startTime"), ms("end_time").alias("endTime")).alias("statistics"),
        (F.col("retry_count") if "retry_count" in results.columns else F.lit(0)).alias("retry_count"))


def copies_catalog(results: DataFrame) -> DataFrame:
    """Live metadata of the copies a run made (dataset_id, table_id,
    num_bytes), for M2's existence and size check."""
    return (results.filter(F.col("error_reason").isNull())
            .select(F.col("target_dataset_id").alias("dataset_id"), F.col("target_table_id").alias("table_id"),
                    "num_bytes"))


# ---------------------------------------------------------------- S13
def restore_copy(spark: SparkSession, items: DataFrame | Iterable[Row], warehouse: Warehouse,
                 parallelism: int = 4) -> DataFrame:
    """Copy each item's source copy into its target with the job's
    dispositions.  WRITE_EMPTY fails on a target (or target partition) with
    rows, WRITE_APPEND appends, WRITE_TRUNCATE replaces (only the target
    partition); CREATE_NEVER fails when the target table is absent.  A failing
    item is 'Failed' and does not stop the others.  Items: id, source_table,
    target_table (structs), create_disposition, write_disposition, and job_id.

    Items of one target table run in the order of their ids, each seeing what
    the ones before it wrote: of two versions for one place WRITE_EMPTY takes
    the first and WRITE_TRUNCATE leaves the last.  Consecutive items for
    different partitions with one disposition and one schema are one Spark
    write; if it fails they are tried one by one.  Different tables run in
    parallel, one table is never written by two jobs at once.

    Writes are staged and published by `commit.Ledger`: a job that was stopped
    anywhere and runs again under the same job_id ends what was decided, gives
    the recorded outcome of each item that has one, and writes nothing twice.
    Items without a job_id have no record to come back to."""
    fs = _FS(spark)
    if isinstance(items, DataFrame):
        items = items.orderBy(F.col("target_table.project_id"), F.col("target_table.dataset_id"),
                              F.col("target_table.table_id"), "id")
    once = f"call-{uuid.uuid4().hex}"

    def target_of(r) -> tuple:
        t = r["target_table"]
        return t["project_id"], t["dataset_id"], t["table_id"]

    def job_of(r) -> str:
        job = r["job_id"] if "job_id" in (r.asDict() if isinstance(r, Row) else r) else None
        return once if job is None else f"job-{job}"

    def source(r) -> str:
        s = r["source_table"]
        return warehouse.path(s["project_id"], s["dataset_id"], s["table_id"])

    def outcome(r, started: dt.datetime, e: Exception | None = None, **more) -> dict:
        s, t = r["source_table"], r["target_table"]
        failed = {"error_reason": _reason(e), "error_message": str(e)} if e else {}
        return dict(source_project_id=s["project_id"], source_dataset_id=s["dataset_id"],
                    source_table_id=s["table_id"], source_partition_id=s["partition_id"],
                    target_project_id=t["project_id"], target_dataset_id=t["dataset_id"],
                    target_table_id=t["table_id"], target_partition_id=t["partition_id"],
                    start_time=started, end_time=_now(), item_id=r["id"], state="DONE", **failed, **more)

    def recorded(x: dict) -> dict:
        times = {c: dt.datetime.fromisoformat(x[c]) for c in ("start_time", "end_time")}
        return x | times

    def place(r) -> str:
        part = r["target_table"]["partition_id"]
        return "" if part is None else f"{PARTITION_COLUMN}={part}/"

    def refused(r, dst: str) -> dict | None:
        exists = fs.folder(dst)
        if r["create_disposition"] == "CREATE_NEVER" and not exists:
            return {"error_reason": "notFound", "error_message": f"Not found: Table {dst}"}
        if r["write_disposition"] == "WRITE_EMPTY" and exists:
            where = f"{dst}/{place(r)}".rstrip("/")
            if fs.data_files(where) and not spark.read.parquet(where).isEmpty():
                return {"error_reason": "duplicate", "error_message": f"Already Exists: Table {dst}"}
        return None

    def stage(batch: list, schema: T.StructType, staging: str) -> None:
        """One write of items with one schema and disposition, each for its own partition (or one whole table)."""
        data = spark.read.schema(schema).parquet(*[source(r) for r in batch])
        if batch[0]["target_table"]["partition_id"] is None:
            data.write.parquet(f"{staging}/data")
            return
        # a row's copy is the folder of its file; copies are flat folders named by their ids
        folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
        days = spark.createDataFrame([(r["source_table"]["table_id"], r["target_table"]["partition_id"]) for r in batch],
                                     f"_copy string, {PARTITION_COLUMN} string")
        data = data.withColumn("_copy", folder).drop(PARTITION_COLUMN).join(days, "_copy").drop("_copy")
        data.write.partitionBy(PARTITION_COLUMN).parquet(f"{staging}/data")

    def run(batch: list, schema: T.StructType, dst: str, ledger: Ledger) -> list[dict]:
        started, ready, out = _now(), [], []
        for r in batch:
            no = refused(r, dst)
            if no:
                out.append(outcome(r, started, **no))
            else:
                ready.append(r)
        if out:
            ledger.commit(out)
        if not ready:
            return out
        staging = ledger.staging()
        try:
            stage(ready, schema, staging)
            staged = fs.files(f"{staging}/data")
        except Exception as e:  # noqa: BLE001 - a failed item is a result row
            if len(ready) == 1:
                return [*out, outcome(ready[0], started, e)]
            return out + [x for r in ready for x in run([r], schema, dst, ledger)]
        done = [outcome(r, started, num_bytes=sum(n for f, n in staged.items() if f.startswith(place(r)))) for r in ready]
        replaced = []
        if ready[0]["write_disposition"] == "WRITE_TRUNCATE":
            replaced = [place(r) + f for r in ready for f in fs.files(f"{dst}/{place(r)}".rstrip("/"))]
        ledger.commit(done, dst, staging, [(f"{staging}/data/{f}", f) for f in staged], replaced)
        return out + done

    def one_table(group: list) -> list[tuple]:
        dst = warehouse.path(*target_of(group[0]))
        out: list[dict] = []
        ledgers = {job: restore_ledger(fs, warehouse.root, job, target_of(group[0])) for job in dict.fromkeys(map(job_of, group))}
        known = {(job, x["item_id"]): recorded(x) for job, ledger in ledgers.items() for x in ledger.recover()}
        batch: list = []
        shape = None
        for r in group:
            job, started = job_of(r), _now()
            if (job, r["id"]) in known:
                out.append(known[job, r["id"]])
                continue
            try:
                schema = spark.read.parquet(source(r)).schema
            except Exception as e:  # noqa: BLE001
                out.append(outcome(r, started, e))
                continue
            part = r["target_table"]["partition_id"]
            kind = (schema, r["write_disposition"], part is None, job)
            taken = {x["target_table"]["partition_id"] for x in batch} | {x["source_table"]["table_id"] for x in batch}
            if batch and (kind != shape or part is None or part in taken or r["source_table"]["table_id"] in taken):
                out += run(batch, shape[0], dst, ledgers[shape[3]])
                batch = []
            batch.append(r)
            shape = kind
        out += run(batch, shape[0], dst, ledgers[shape[3]]) if batch else []
        return [_result(**x) for x in out]

    # one group is the items of one target table
    groups = (list(g) for _, g in itertools.groupby(_iter_rows(items), key=target_of))
    results = _run_paged(spark, one_table, groups, parallelism, COPY_RESULT_SCHEMA)
    fs.delete(f"{warehouse.root.rstrip('/')}/_restores/{once}")
    return results


def create_targets(spark: SparkSession, targets: DataFrame | Iterable[Row], items: DataFrame,
                   warehouse: Warehouse) -> int:
    """Apply S15's actions before a restore: datasets are directories that
    appear with their first table; a partition target whose table does not
    exist is created empty with the schema and partitioning of the source
    copy (so CREATE_NEVER partition restores find it, as in the
    reference).  Returns the number of tables created."""
    fs = _FS(spark)
    src = (items.filter(F.col("target_table.partition_id").isNotNull())
           .select(F.col("target_table.project_id").alias("project_id"),
                   F.col("target_table.dataset_id").alias("dataset_id"),
                   F.col("target_table.table_id").alias("table_id"),
                   F.col("source_table.project_id").alias("s_project"),
                   F.col("source_table.dataset_id").alias("s_dataset"),
                   F.col("source_table.table_id").alias("s_table"))
           .dropDuplicates(["project_id", "dataset_id", "table_id"]))
    todo = (targets if isinstance(targets, DataFrame) else spark.createDataFrame(list(targets)))
    todo = todo.filter(F.col("action") == "create_table").join(src, ["project_id", "dataset_id", "table_id"])
    created = 0
    for r in _iter_rows(todo):
        dst = warehouse.path(r["project_id"], r["dataset_id"], r["table_id"])
        if fs.folder(dst):
            continue
        schema = spark.read.parquet(warehouse.path(r["s_project"], r["s_dataset"], r["s_table"])).schema
        empty = spark.createDataFrame([], schema)
        if PARTITION_COLUMN not in empty.columns:
            empty = empty.withColumn(PARTITION_COLUMN, F.lit(None).cast("string"))
        empty.write.partitionBy(PARTITION_COLUMN).mode("overwrite").parquet(dst)
        fs.touch(dst + "/_SUCCESS")  # an empty partitioned table has no files to show it exists
        created += 1
    return created


def restore_events(results: DataFrame) -> DataFrame:
    """Restore results as status events for M3 (first terminal one wins)."""
    failed = F.col("error_reason").isNotNull()
    return results.select(F.col("item_id"), F.col("end_time").alias("event_time"),
                          F.when(failed, "Failed").otherwise("Done").alias("status"),
                          F.when(failed, F.concat(F.col("error_reason"), F.lit(": "), F.col("error_message")))
                          .alias("message"))


# ---------------------------------------------------------------- S14
def delete_copies(spark: SparkSession, to_delete: DataFrame | Iterable[Row], warehouse: Warehouse,
                  backup_project: str, parallelism: int = 8) -> DataFrame:
    """Physically drop each chosen copy (rows: id, dataset_id,
    table_id).  Outcome per copy: deleted / not_found / error — the input of
    M4 (mark_deleted).  The folders are removed inside tasks (`files.remove`),
    their outcomes are the rows that the tasks write; the driver sees neither."""
    if not isinstance(to_delete, DataFrame):
        to_delete = spark.createDataFrame([(r["id"], r["dataset_id"], r["table_id"]) for r in to_delete],
                                          "id long, dataset_id string, table_id string")
    root = warehouse.path(backup_project, "", "").rstrip("/")
    # a row without both names would point above the table folders
    named = F.col("dataset_id").isNotNull() & F.col("table_id").isNotNull() & (F.length("dataset_id") > 0) & (F.length("table_id") > 0)
    folders = to_delete.filter(named).select("id", F.concat_ws("/", F.lit(root), "dataset_id", "table_id").alias("path"))
    gone = FT.remove(folders, tasks=max(parallelism, spark.sparkContext.defaultParallelism))
    return gone.unionByName(to_delete.filter(~F.coalesce(named, F.lit(False))).select("id", F.lit(FT.ERROR).alias("outcome")))


# ---------------------------------------------------------------- Q19
def row_text(df: DataFrame, columns: Iterable[str]) -> Column:
    """A row as one text: names, lengths and NULL marks, so that different rows have different texts.

    Structs, arrays and maps are written as JSON with their NULLs; maps are
    sorted by key first."""
    parts = []
    kinds = {f.name: f.dataType for f in df.schema.fields}
    for c in sorted(columns):
        v, t = F.col(f"`{c}`"), kinds[c]
        if isinstance(t, T.MapType):
            v = F.array_sort(F.map_entries(v))
        if isinstance(t, (T.MapType, T.ArrayType, T.StructType)):
            v = F.to_json(F.struct(v.alias("v")), {"ignoreNullFields": "false"})
        elif isinstance(t, T.BinaryType):
            v = F.hex(v)
        v = v.cast("string")
        parts.append(F.concat(F.lit(f"{c}="), F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-")), F.lit(";")))
    return F.concat(*parts) if parts else F.lit("")


def row_hash(df: DataFrame, columns: Iterable[str]) -> Column:
    """60 bits of the md5 of `row_text`; summed exactly, an order-free checksum."""
    return F.conv(F.substring(F.md5(row_text(df, columns)), 1, 15), 16, 10).cast("decimal(38,0)")


def verify_copy(source: DataFrame, copy: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Q19: rows, bytes of row text and checksum of source and copy side by
    side, + `same_schema` (names and types) and `equal` (all of them).
    Both sides are hashed in one pass over their union and reduced by one
    partial aggregate (no join)."""
    by = list(by)
    shape = lambda df: sorted((f.name, f.dataType.simpleString()) for f in df.schema.fields if f.name not in by)
    same = shape(source) == shape(copy)

    def hashed(df: DataFrame, side: str) -> DataFrame:
        cols = [c for c in df.columns if c not in by]
        return df.select(*by, row_hash(df, cols).alias("_h"), F.octet_length(row_text(df, cols)).cast("long").alias("_b"),
                         F.lit(side).alias("_side"))

    u = hashed(source, "source").unionByName(hashed(copy, "copy"))
    aggs = []
    for side in ("source", "copy"):
        on = F.col("_side") == side
        aggs += [F.count_if(on).alias(f"{side}_rows"), F.coalesce(F.sum(F.when(on, F.col("_b"))), F.lit(0)).alias(f"{side}_bytes"),
                 F.sum(F.when(on, F.col("_h"))).alias(f"{side}_checksum")]
    out = u.groupBy(*by).agg(*aggs) if by else u.agg(*aggs)
    return out.withColumn("same_schema", F.lit(same)).withColumn(
        "equal", F.lit(same) & (F.col("source_rows") == F.col("copy_rows")) & (F.col("source_bytes") == F.col("copy_bytes"))
        & F.col("source_checksum").eqNullSafe(F.col("copy_checksum")))
