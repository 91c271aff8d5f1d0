"""Sharding by histogram sort.

Rows are ordered by (hash of the text, doc_id), written as one string of 32
hexadecimal digits. Candidate boundaries are digit prefixes: one grouped sum
over all partitions counts the exact bytes below each, and the next round puts
new probes only into the intervals that still hold an unmet splitter. When
every splitter is within the tolerance the rows are exchanged once.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from keepsake.llm.common import require, stored

ROW_BYTES = 8
#: Digits of the key that each round of probes looks at; 16 digits of text hash come before 16 of doc_id.
ROUNDS = (3, 5, 7, 9, 11, 13, 16, 18, 20, 22, 24, 26, 28, 30, 32)
#: Text bytes that one task orders, and the least and most runs that a shard is cut into for that.
RUN_BYTES = 64 << 20
RUNS = (8, 128)


def sort_key(text: Column, doc_id: Column, integral: bool = True) -> Column:
    """Equal texts are neighbours and, among them, whole-number ids ascend; a null id comes first, a null text counts as empty.

    Other ids (`integral` False) stand in the order of their md5.
    """
    body = F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, 16)
    order = F.lower(F.hex(doc_id.cast("long").bitwiseXOR(F.lit(-2 ** 63)))) if integral else F.substring(F.md5(doc_id.cast("string")), 1, 16)
    return F.concat(body, F.lpad(F.coalesce(order, F.lit("")), 16, "0"))


def row_bytes(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def _after(prefix: str) -> str:
    """The least string above all keys that start with `prefix`."""
    up = f"{int(prefix, 16) + 1:x}"
    return up.zfill(len(prefix)) if len(up) <= len(prefix) else "g"


def splitters(rows: DataFrame, cuts: int, slack: float) -> list[tuple[str, int]]:
    """(boundary, rows below it) for the `cuts - 1` inner ends of runs with near-equal bytes.

    rows: (key, size). A boundary is met when the bytes below it miss its goal by
    `slack` at most, or when it has reached a single row or key. Boundaries within the
    first 16 digits never part equal texts, so these are parted only if no end
    of their group is near enough. The first round collects 4,096 counts, later
    ones 256 (once 4,096) for each open interval, of which there are fewer than
    `cuts`, for any input.
    """
    spark = rows.sparkSession
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    goals = [total * i // cuts for i in range(1, cuts)]
    met: dict[int, tuple[str, int]] = {}
    open_ = {i: ("", 0, 0) for i in range(len(goals))}  # prefix, bytes and rows below it
    done = 0
    for digits in ROUNDS:
        if not open_:
            break
        inside = spark.createDataFrame([(p,) for p in sorted({x[0] for x in open_.values()})], "prefix string")
        counts = rows.select(F.substring("key", 1, done).alias("prefix"), F.substring("key", 1, digits).alias("probe"), "size").join(
            F.broadcast(inside), "prefix").groupBy("prefix", "probe").agg(F.sum("size"), F.count("*")).collect()
        by_prefix: dict[str, list] = {}
        for p, probe, size, n in counts:
            by_prefix.setdefault(p, []).append((probe, size, n))
        for p, probes in by_prefix.items():
            probes.sort()
            sizes, ns = list(accumulate(x[1] for x in probes)), list(accumulate(x[2] for x in probes))
            at = 0
            for i in sorted(i for i, x in open_.items() if x[0] == p):
                _, size, n = open_[i]
                while at < len(probes) - 1 and size + sizes[at] <= goals[i]:
                    at += 1
                probe, own, members = probes[at]
                low, high = size + sizes[at] - own, size + sizes[at]
                rows_low = n + ns[at] - members
                near_low = goals[i] - low <= high - goals[i]
                if min(goals[i] - low, high - goals[i]) <= slack or members == 1 or digits == ROUNDS[-1]:
                    met[i] = (probe, rows_low) if near_low else (_after(probe), rows_low + members)
                    del open_[i]
                else:
                    open_[i] = (probe, low, rows_low)
        if not counts:
            met |= {i: ("g", 0) for i in open_}
            break
        done = digits
    return [met[i] for i in range(len(goals))]


def shard(docs: DataFrame, shards: int = 24, tolerance: float = 0.005, ranges: int | None = None) -> DataFrame:
    """`docs` with columns size, shard and slot; bytes of shards differ by about `tolerance` of a shard.

    `ranges` runs (by default as many as RUN_BYTES asks for, within RUNS) are
    cut in each shard, so that no task orders a whole shard: slot is the number of rows below a run plus the place within it, gapless
    from 0. Input columns of these names are replaced. Null texts have
    8 bytes. Rows that repeat doc_id and text stay together; an empty table
    gives an empty table.
    """
    require(docs, "doc_id", "text")
    key = sort_key(F.col("text"), F.col("doc_id"), isinstance(docs.schema["doc_id"].dataType, IntegralType))
    narrow = stored(docs.select(key.alias("key"), row_bytes(F.col("text")).alias("size")), "shard-keys")
    total = narrow.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    ranges = ranges or max(RUNS[0], min(RUNS[1], total // shards // RUN_BYTES + 1))
    ends = splitters(narrow, shards * ranges, tolerance * total / shards / 2)
    starts = [("", 0), *ends]
    outer = F.array(*[F.lit(starts[i][0]) for i in range(0, len(starts), ranges)])
    inner = F.array(*[F.array(*[F.lit(k) for k, _ in starts[i:i + ranges]]) for i in range(0, len(starts), ranges)])
    below = F.array(*[F.lit(n).cast("long") for _, n in starts])

    def place(bounds: Column) -> Column:
        return F.size(F.filter(bounds, lambda b: b <= F.col("_key"))) - 1

    out = docs.drop("size", "shard", "slot", "_key", "_run").withColumn("_key", key).withColumn(
        "size", row_bytes(F.col("text"))).withColumn("shard", place(outer).cast("int"))
    out = out.withColumn("_run", F.col("shard") * ranges + place(F.element_at(inner, F.col("shard") + 1)))
    order = F.row_number().over(Window.partitionBy("_run").orderBy("_key")) - 1
    first = F.element_at(below, F.col("shard") * ranges + 1)
    return out.withColumn("slot", (F.element_at(below, F.col("_run") + 1) - first + order).cast("long")).drop("_key", "_run")
