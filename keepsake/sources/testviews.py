"""Adapter from the driver's generic test tables to the catalog schemas.

The driver ships TPC-H-like parquet tables; the library works on catalog
metadata (table entities, backup records, census snapshots, live catalog,
restore jobs).  This module derives those frames from the test tables with
plain column expressions, so every registered query reads the given tables
and its work grows with them.  The same rules are written as DuckDB CTEs in
`keepsake.checks.oracle`.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keepsake.config import Config, UNPARTITIONED
from keepsake.functions.timeutil import (days_after, days_before, hours_after, minutes_before,
                                         ts_lit, yyyymmdd)

# Fixed values of the adapter (shared with the oracle CTEs).
AS_OF = dt.datetime(2024, 1, 30, 0, 0, 0)
SHIFT_DAYS = 8217          # maps the last order date 2001-08-01 onto AS_OF
N_TABLES = 100             # table entities are o_custkey % 100
BACKUP_PROJECT = "backup"
RESTORATION_PROJECT = "restoration"


def default_config() -> Config:
    return Config(as_of=AS_OF, backup_project=BACKUP_PROJECT,
                  restoration_project=RESTORATION_PROJECT)


def _str(c: Column) -> Column:
    return c.cast("string")


def partition_rule(i: Column) -> Column:
    """partition id of entity i: pseudo partition, a recent day, or none."""
    as_of = ts_lit(AS_OF)
    return (F.when(i % 5 == 0, F.lit(UNPARTITIONED))
            .when(i % 2 == 0, yyyymmdd(days_before(as_of, (i % 7).cast("int"))))
            .otherwise(F.lit(None).cast("string")))


def is_partitioned_rule(i: Column) -> Column:
    return (i % 5 == 0) | (i % 2 == 0)


class TestViews:
    """Lazily built catalog frames over one scale-factor directory.

    `TestViews.of(spark, dir)` returns one instance per session and
    directory, so the view DataFrames (logical plans, like temp views) are
    defined once per session; every execution still reads the files.
    """

    _instances: dict = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "TestViews":
        key = (id(spark), spark.sparkContext.applicationId, sf_dir.rstrip("/"))
        if key not in cls._instances:
            # every timestamp is naive UTC (see session.REQUIRED_CONF)
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            cls._instances[key] = cls(spark, sf_dir)
        return cls._instances[key]

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- D1 table entities ------------------------------------------------
    @cached_property
    def tables(self) -> DataFrame:
        i = F.col("i")
        as_of = ts_lit(AS_OF)
        return (self._read("orders")
                .select((F.col("o_custkey") % N_TABLES).alias("i"))
                .distinct()
                .select(i.alias("id"),
                        F.concat(F.lit("p"), _str(i % 4)).alias("project_id"),
                        F.concat(F.lit("d"), _str(i % 3)).alias("dataset_id"),
                        F.concat(F.lit("t"), _str(i)).alias("table_id"),
                        partition_rule(i).alias("partition_id"),
                        days_before(as_of, ((i * 37) % 420).cast("int")).alias("last_checked")))

    # -- D2 backup records --------------------------------------------------
    @cached_property
    def backups(self) -> DataFrame:
        k = F.col("o_orderkey")
        parent = F.col("o_custkey") % N_TABLES
        shifted = days_after(F.col("o_orderdate"), SHIFT_DAYS)
        created = hours_after(shifted, (k % 24).cast("int"))
        table_id = F.when(parent == 7, F.concat(F.lit("20"), _str(F.floor(k / 1000))))\
            .otherwise(F.concat(F.lit("20"), _str(k)))
        return (self._read("orders")
                .select(k.alias("id"),
                        parent.alias("parent_id"),
                        minutes_before(created, 10).alias("last_modified"),
                        created.alias("created"),
                        F.concat(F.lit("bk"), _str(k % 5)).alias("dataset_id"),
                        table_id.alias("table_id"),
                        F.floor(F.col("o_totalprice")).cast("long").alias("num_bytes"),
                        F.when(F.col("o_orderstatus") == "P",
                               days_after(F.col("o_orderdate"), SHIFT_DAYS + 30))
                        .alias("deleted")))

    # -- D5/D6 census snapshots ---------------------------------------------
    def _census_base(self) -> DataFrame:
        n = F.col("user_id") % N_TABLES
        ts = F.col("ts")
        return (self._read("events")
                .select(n.alias("n"),
                        F.concat(F.lit("p"), _str(n % 4)).alias("projectId"),
                        F.concat(F.lit("d"), _str(n % 3)).alias("datasetId"),
                        F.concat(F.lit("t"), _str(n)).alias("tableId"),
                        ts.alias("snapshotTime"),
                        F.to_date(ts).alias("snapshot_date"),
                        days_before(ts, (F.col("event_id") % 9).cast("int")).alias("lastModifiedTime"),
                        days_before(ts, 100).alias("creationTime"),
                        F.floor(F.col("value")).cast("long").alias("numRows"),
                        F.floor(F.col("value") * 100).cast("long").alias("numBytes"),
                        F.when(F.col("event_type") == "error", "VIEW").otherwise("TABLE").alias("type")))

    @cached_property
    def census_tables(self) -> DataFrame:
        n = F.col("n")
        tp = F.when(is_partitioned_rule(n), F.struct(F.lit("DAY").alias("type")))\
            .otherwise(F.lit(None).cast("struct<type:string>"))
        return self._census_base().withColumn("timePartitioning", tp).drop("n")

    @cached_property
    def census_partitions(self) -> DataFrame:
        n = F.col("n")
        return (self._census_base()
                .filter(is_partitioned_rule(n))
                .withColumn("partitionId", partition_rule(n))
                .drop("n", "type"))

    @cached_property
    def census_copies(self) -> DataFrame:
        """Census rows of the backup project: one per recorded copy, plus
        copies nobody recorded."""
        b = self.backups
        idc = F.col("id")
        cols = [F.lit(BACKUP_PROJECT).alias("projectId"),
                F.col("dataset_id").alias("datasetId"),
                F.col("created").alias("creationTime"),
                F.col("created").alias("lastModifiedTime"),
                (idc % 50).alias("numRows"),
                (F.col("num_bytes") + idc % 3).alias("numBytes"),
                ts_lit(AS_OF).alias("snapshotTime")]
        recorded = b.filter(idc % 11 != 0).select(F.col("table_id").alias("tableId"), *cols)
        unrecorded = b.filter(idc % 101 == 0).select(
            F.concat(F.lit("20x"), _str(idc)).alias("tableId"), *cols)
        return recorded.unionByName(unrecorded)

    # -- D7 live catalog, raw documents ---------------------------------------
    @cached_property
    def live_raw(self) -> DataFrame:
        """One raw metadata document per table that still exists (id % 4 != 2).

        Content comes from the newest census row of the same n; lookups of
        every 23rd table and of every 50th from the 29th on fail
        (`lookup_status='error'`, no document).
        """
        from keepsake.operators.common import latest_by
        latest = latest_by(self._census_base(), ["n"], "snapshotTime")
        i = F.col("i")
        t = (self.tables.filter(F.col("id") % 4 != 2)
             .select(F.col("id").alias("i"), "project_id", "dataset_id", "table_id")
             .join(latest, F.col("i") == F.col("n"), "inner"))
        ms = lambda c: _str(F.unix_millis(c.cast("timestamp")))
        schema = F.when(i % 13 != 0, F.struct(F.array(F.struct(
            F.lit("value").alias("name"), F.lit("STRING").alias("type"),
            F.lit("NULLABLE").alias("mode"))).alias("fields")))
        tpart = F.when(is_partitioned_rule(i), F.struct(
            F.lit("DAY").alias("type"),
            F.when(i % 3 == 0, F.lit(2592000000)).cast("long").alias("expirationMs")))
        doc = F.to_json(F.struct(
            F.struct(F.col("project_id").alias("projectId"), F.col("dataset_id").alias("datasetId"),
                     F.col("table_id").alias("tableId")).alias("tableReference"),
            schema.alias("schema"),
            tpart.alias("timePartitioning"),
            _str(F.col("numBytes")).alias("numBytes"),
            _str(F.col("numRows")).alias("numRows"),
            ms(F.col("creationTime")).alias("creationTime"),
            ms(F.col("lastModifiedTime")).alias("lastModifiedTime"),
            F.col("type").alias("type"),
            F.when(i % 6 == 1, "EU").when(i % 6 != 0, "US").alias("location")))
        status = F.when((i % 23 == 0) | (i % 50 == 29), "error").otherwise("found")
        return t.select(F.col("project_id"), F.col("dataset_id"), F.col("table_id"),
                        status.alias("lookup_status"),
                        F.when(status == "found", doc).alias("document"))

    @cached_property
    def live(self) -> DataFrame:
        from keepsake.sources.catalog import live_catalog
        return live_catalog(self.live_raw)

    @cached_property
    def partitions(self) -> DataFrame:
        """Partition listing (S8) of every live partitioned table."""
        from keepsake.sources.catalog import list_partitions
        return list_partitions(self.census_partitions, self.live)

    # -- D8/D9 restore jobs and items -----------------------------------------
    @cached_property
    def restoration_jobs(self) -> DataFrame:
        o = self._read("orders").select("o_orderkey", "o_orderdate")
        n_items = (self._read("lineitem").groupBy("l_orderkey")
                   .agg(F.count(F.lit(1)).alias("n_items")))
        k = F.col("o_orderkey")
        return (o.join(n_items, k == F.col("l_orderkey"), "inner")
                .select(_str(k).alias("id"),
                        days_after(F.col("o_orderdate"), SHIFT_DAYS).alias("created"),
                        (F.col("n_items") + k % 2).alias("items_count"),
                        F.when(k % 3 == 0, "CREATE_NEVER").otherwise("CREATE_IF_NEEDED")
                        .alias("create_disposition"),
                        F.element_at(F.array(F.lit("WRITE_EMPTY"), F.lit("WRITE_APPEND"),
                                             F.lit("WRITE_TRUNCATE")),
                                     (k % 3 + 1).cast("int")).alias("write_disposition")))

    @cached_property
    def restore_items(self) -> DataFrame:
        li = self._read("lineitem")
        k, ln = F.col("l_orderkey"), F.col("l_linenumber")
        status = (F.when(F.col("l_returnflag") == "R", "Failed")
                  .when(F.col("l_returnflag") == "A", "Done").otherwise("In Progress"))
        part = F.when(ln % 2 == 0, yyyymmdd(F.col("l_shipdate")))
        src = F.struct(F.lit(BACKUP_PROJECT).alias("project_id"),
                       F.concat(F.lit("bk"), _str(k % 5)).alias("dataset_id"),
                       F.concat(F.lit("20"), _str(k)).alias("table_id"),
                       part.alias("partition_id"))
        tgt = F.struct(F.concat(F.lit("p"), _str(F.col("l_partkey") % 4)).alias("project_id"),
                       F.concat(F.lit("d"), _str(F.col("l_suppkey") % 3)).alias("dataset_id"),
                       F.concat(F.lit("t"), _str(F.col("l_partkey") % 100)).alias("table_id"),
                       part.alias("partition_id"))
        custom = (F.when(ln % 3 == 0, F.concat(F.lit('{"line": '), _str(ln), F.lit("}")))
                  .when(ln % 3 == 1, F.lit("not json")))
        return li.select((k * 8 + ln).alias("id"), _str(k).alias("job_id"),
                         status.alias("status"),
                         F.when(status == "Failed",
                                F.concat(F.lit("Copy job failed: line "), _str(ln)))
                         .alias("status_message"),
                         F.when(status != "In Progress",
                                days_after(F.col("l_shipdate"), SHIFT_DAYS)).alias("completed"),
                         src.alias("source_table"), tgt.alias("target_table"),
                         custom.alias("custom_parameters"))

    @cached_property
    def status_events(self) -> DataFrame:
        """Two terminal status events per restore item; line parity decides
        which one arrives first (for M3)."""
        li = self._read("lineitem")
        k, ln = F.col("l_orderkey"), F.col("l_linenumber")
        t0 = days_after(F.col("l_shipdate"), SHIFT_DAYS)
        even = ln % 2 == 0
        first = F.struct(F.when(even, "Done").otherwise("Failed").alias("status"), t0.alias("t"))
        second = F.struct(F.when(even, "Failed").otherwise("Done").alias("status"),
                          hours_after(t0, 1).alias("t"))
        return (li.select((k * 8 + ln).alias("item_id"), F.explode(F.array(first, second)).alias("e"))
                .select("item_id", F.col("e.t").alias("event_time"), F.col("e.status").alias("status"),
                        F.when(F.col("e.status") == "Failed",
                               F.concat(F.lit("error on item "), _str(F.col("item_id"))))
                        .alias("message")))

    @cached_property
    def list_requests(self) -> DataFrame:
        """Backup-list restore requests: one per backup record, in lists of
        `id % 1000`, with malformed keys, both-keys rows and repeated
        requests (a rule on the key decides which); every 130th names a wrong
        parent."""
        b = self.backups
        idc = F.col("id")
        parent = F.col("parent_id") + F.when(idc % 130 == 0, 1).otherwise(0)
        good = F.base64(F.encode(F.concat(F.lit('"Table", '), _str(parent),
                                          F.lit(', "Backup", '), _str(idc)), "UTF-8"))
        three = F.base64(F.encode(F.concat(F.lit('"Table", '), _str(F.col("parent_id")),
                                           F.lit(', "Backup"')), "UTF-8"))
        key = (F.when(idc % 350 == 0, F.lit("!!not-base64!!"))
               .when(idc % 200 == 0, three).otherwise(good))
        base = b.select((idc % 1000).alias("list_id"), idc.alias("request_id"),
                        key.alias("backupBqKey"),
                        F.when(idc % 300 == 0, F.lit("ahFzfmJhY2t1cA")).alias("backupUrlSafeKey"))
        repeat = base.filter(F.col("request_id") % 450 == 0)\
            .withColumn("request_id", -F.col("request_id"))
        return base.unionByName(repeat)

    @cached_property
    def live_copies(self) -> DataFrame:
        """Live metadata of the copies in the backup project: every available
        copy exists; every 7th reports one byte more than its record."""
        return self.listed_copies.select("dataset_id", "table_id", "num_bytes")

    @cached_property
    def listed_copies(self) -> DataFrame:
        """`live_copies` with the rest of what the backup project lists of a copy: whose it is and its times."""
        from keepsake.operators.common import latest_by
        avail = self.backups.filter(F.col("deleted").isNull()).drop("deleted")
        one = latest_by(avail, ["dataset_id", "table_id"], "id")
        return one.withColumn("num_bytes", F.col("num_bytes") + F.when(F.col("id") % 7 == 0, 1).otherwise(0))

    def copy_results(self, plan: DataFrame, as_of: dt.datetime = AS_OF) -> DataFrame:
        """Copy-job result documents (D12) the warehouse returns for the
        copies of a backup plan.  k = table number + partition day mod 7
        decides the outcome: k % 9 = 0 still running, k % 5 = 0 backend error,
        k % 7 = 0 'duplicate'; the copy ends k seconds after it starts."""
        k = (F.substring(F.col("table_id"), 2, 10).cast("long")
             + F.coalesce(F.col("partition_id").try_cast("long") % 7, F.lit(0)))
        reason = F.when(k % 5 == 0, "backendError").when(k % 7 == 0, "duplicate")
        err = F.when(reason.isNotNull(), F.struct(reason.alias("reason"),
                                                  F.lit("copy failed").alias("message")))
        start_ms = F.lit(int((as_of - dt.datetime(1970, 1, 1)).total_seconds() * 1000))
        src_tid = F.concat(F.col("table_id"), F.coalesce(F.concat(F.lit("$"), F.col("partition_id")), F.lit("")))
        ref = lambda p, d, t: F.struct(p.alias("projectId"), d.alias("datasetId"), t.alias("tableId"))
        return plan.filter(F.col("needs_backup")).select(
            F.struct(F.lit(BACKUP_PROJECT).alias("projectId"),
                     F.concat(F.lit("job_"), F.col("target_table_id")).alias("jobId")).alias("jobReference"),
            F.struct(F.struct(ref(F.col("project_id"), F.col("dataset_id"), src_tid).alias("sourceTable"),
                              ref(F.lit(BACKUP_PROJECT), F.col("target_dataset_id"),
                                  F.col("target_table_id")).alias("destinationTable"),
                              F.lit("CREATE_IF_NEEDED").alias("createDisposition"),
                              F.lit("WRITE_EMPTY").alias("writeDisposition")).alias("copy"))
            .alias("configuration"),
            F.struct(F.when(k % 9 == 0, "RUNNING").otherwise("DONE").alias("state"),
                     err.alias("errorResult"),
                     F.when(err.isNotNull(), F.array(err)).alias("errors")).alias("status"),
            F.struct(start_ms.cast("string").alias("startTime"),
                     (start_ms + k * 1000).cast("string").alias("endTime")).alias("statistics"),
            (k % 8).alias("retry_count"),
            F.col("unit_num_bytes").alias("copied_bytes") if "unit_num_bytes" in plan.columns
            else F.lit(None).cast("long").alias("copied_bytes"))
