"""Table entities and copy records stored by table, so that joins between them need no exchange.

Both are written in the same number of buckets of the table id: a record lies
in the bucket of its table, and J1, J12, W7 and Q1 read both sides as they lie.
A table with more records than an average bucket would make its bucket one long
task. Such tables lie apart, entity and records, in files without buckets;
fewer than `buckets` tables can be that large. A job that decides table by
table runs on both parts (`over_parts`): the hot part spreads its records by
copy id and reduces them before any exchange by table, as the plain plans do.

    <path>/<n>.json           manifest of version n; the highest n is the state
           v-<uuid>/<part>-<kind>   its files

A version appears with its manifest, in one rename. The version before stays
for readers that hold it; older ones go with the next write.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepsake.session import checkpoint_root, written
from keepsake.sources.commit import FileSystem

BUCKETS = 64
#: Column that names the table, for each kind of row.
KEYS = {"tables": "id", "backups": "parent_id"}


@dataclass(frozen=True)
class Part:
    """Entities and records of the same tables; `even`: in buckets, no table larger than an average one."""

    tables: DataFrame
    backups: DataFrame
    even: bool


def _versions(fs: FileSystem, path: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in fs.names(path) if n.endswith(".json"))


def _table_name(version: str, kind: str) -> str:
    return f"keepsake_{version.replace('-', '_')}_{kind}"


def hot_tables(backups: DataFrame, buckets: int) -> DataFrame:
    """(parent_id) of the tables with more records than an average bucket: fewer than `buckets`."""
    counts = written(backups.groupBy("parent_id").agg(F.count(F.lit(1)).alias("n")), "records-per-table")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.filter(F.col("n") * buckets > total).select("parent_id")


def write_parts(spark: SparkSession, tables: DataFrame, backups: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Replace what is stored at `path`; `tables` has a column id, `backups` parent_id, others as they come.

    Records without a table lie with the even part, tables without records too.
    """
    path, version = path.rstrip("/"), f"v-{uuid.uuid4().hex}"
    fs = FileSystem(spark)
    hot = F.broadcast(written(hot_tables(backups, buckets), "hot-tables"))  # fewer rows than buckets
    schemas = {}
    for kind, df in (("tables", tables), ("backups", backups)):
        key = KEYS[kind]
        at = hot.select(F.col("parent_id").alias(key))
        schemas[kind] = json.loads(df.schema.json())
        # one task writes one bucket: Spark deals rows and buckets by the same hash
        (df.join(at, key, "left_anti").select(*df.columns).repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
         .option("path", f"{path}/{version}/even-{kind}").saveAsTable(_table_name(version, kind), format="parquet"))
        df.join(at, key, "left_semi").select(*df.columns).write.parquet(f"{path}/{version}/hot-{kind}")
    before = _versions(fs, path)
    number = before[-1] + 1 if before else 0
    fs.write(f"{path}/{version}.tmp", json.dumps({"version": version, "buckets": buckets, "schemas": schemas}))
    if not fs.rename(f"{path}/{version}.tmp", f"{path}/{number}.json"):
        raise OSError(f"another writer took version {number} of {path}")
    for n in before[:-1]:
        old = json.loads(fs.read(f"{path}/{n}.json"))["version"]
        for kind in KEYS:
            spark.sql(f"DROP TABLE IF EXISTS {_table_name(old, kind)}")
        fs.delete(f"{path}/{n}.json")
        fs.delete(f"{path}/{old}")


def read_parts(spark: SparkSession, path: str) -> list[Part]:
    """The newest version at `path`: its even part in buckets, its hot part as plain files."""
    path = path.rstrip("/")
    fs = FileSystem(spark)
    found = _versions(fs, path)
    if not found:
        raise FileNotFoundError(f"nothing stored at {path}")
    state = json.loads(fs.read(f"{path}/{found[-1]}.json"))
    schemas = {kind: T.StructType.fromJson(s) for kind, s in state["schemas"].items()}
    even, hot = {}, {}
    for kind, schema in schemas.items():
        name, folder = _table_name(state["version"], kind), f"{path}/{state['version']}"
        # another session's catalog does not know the table; the bucket is part of its files' names
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{KEYS[kind]}`) SORTED BY (`{KEYS[kind]}`) "
                  f"INTO {state['buckets']} BUCKETS LOCATION '{folder}/even-{kind}'")
        even[kind], hot[kind] = spark.table(name), spark.read.schema(schema).parquet(f"{folder}/hot-{kind}")
    return [Part(**even, even=True), Part(**hot, even=False)]


def stored_parts(spark: SparkSession, tables: DataFrame, backups: DataFrame, buckets: int = BUCKETS) -> list[Part]:
    """`write_parts` to a new place in the checkpoint folder, and `read_parts`."""
    path = f"{checkpoint_root(spark)}/by-table-{uuid.uuid4().hex}"
    write_parts(spark, tables, backups, path, buckets)
    return read_parts(spark, path)


def over_parts(parts: list[Part], job: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """The rows of `job(tables, backups)`, for a job that decides each table by its own rows."""
    return reduce(DataFrame.unionByName, (job(p.tables, p.backups) for p in parts))
