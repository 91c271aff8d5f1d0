"""Mixing sources to target weights with hash-threshold histograms.

Every row gets a fixed pseudo-random 60-bit draw from its `doc_id`. Taking all
rows of a source whose draw is below a threshold gives nested samples, so a
larger budget only adds rows. The threshold is found from histograms: words are
summed by (source, leading bits of the draw); the prefix of buckets that fits
the budget is taken whole and only the bucket that crosses it is split by the
next bits, until it is one draw. Nothing is sorted by draw.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepsake.llm.common import SPACE_WORD, require, stored

DRAW_BITS = 60
STEP_BITS = 12
WEIGHTS = (5, 2, 1)


def draw(doc_id: Column, seed: int) -> Column:
    """60 bits of md5(seed:doc_id); null ids share one draw."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_WORD)), F.lit(0)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """`sources` with its rank by code point, null last: range partitions, then an offset for each.

    Spark compares strings by their UTF-8 bytes, which is code point order.
    """
    key = [F.col("source").isNull(), F.col("source")]
    parts = stored(sources.repartitionByRange(*key).withColumn("part", F.spark_partition_id()), "mix-sources")
    sizes = parts.groupBy("part").count()
    # one row per shuffle partition: bounded by the partition count, not by the sources
    before = sizes.withColumn("before", F.coalesce(F.sum("count").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    inner = F.row_number().over(Window.partitionBy("part").orderBy(*key)) - 1
    return parts.withColumn("inner", inner).join(before, "part").select(
        "source", "source_size", (F.col("inner") + F.col("before")).alias("rank"))


def targets(sources: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """(source, source_size, target): `share` of all sizes by weight, none above `cap` times its size.

    The excess of capped sources is reshared by weight until none is above:
    with level L, target = min(cap * size, L * weight), and L rises as sources
    are capped. Each pass is one aggregate of the source table.
    """
    rank = _ranked(sources)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    s = stored(rank.select("source", "source_size", weight.cast("long").alias("weight"),
                           (F.col("source_size") * F.lit(cap)).alias("top")), "mix-targets")
    total = s.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * share
    level = 0.0
    while True:
        is_open = F.col("top") > F.lit(level) * F.col("weight") if level else F.lit(True)
        open_weight, capped = s.agg(F.coalesce(F.sum(F.when(is_open, F.col("weight"))), F.lit(0)),
                                    F.coalesce(F.sum(F.when(~is_open, F.col("top"))), F.lit(0.0))).first()
        raised = (total - capped) / open_weight if open_weight else level
        if raised <= level:
            break
        level = raised
    return s.select("source", "source_size", F.least("top", F.lit(level) * F.col("weight")).alias("target"))


def thresholds(rows: DataFrame, goals: DataFrame, step_bits: int = STEP_BITS) -> DataFrame:
    """goals + (copies, threshold): whole copies of the source and the draw below which one more is taken.

    rows: (source, draw, size). The budget of the partial copy is
    target - copies * size; the draw that crosses it is taken if that ends nearer.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    open_ = goals.withColumn("copies", whole.cast("long")).withColumn(
        "budget", F.col("target") - F.col("copies") * F.col("source_size"))
    base = open_
    open_ = open_.select("source", "budget", F.lit(0).cast("long").alias("prefix"))
    for shift in range(DRAW_BITS - step_bits, -1, -step_bits):
        size = rows.withColumn("bucket", F.shiftright("draw", shift))
        size = size.withColumn("prefix", F.shiftright("bucket", step_bits))
        hit = size.join(open_, size["source"].eqNullSafe(open_["source"]) & (size["prefix"] == open_["prefix"])).select(
            size["source"], "bucket", "budget", "size")
        sums = hit.groupBy("source", "bucket").agg(F.sum("size").alias("size"), F.first("budget").alias("budget"))
        w = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        run = sums.withColumn("upto", F.sum("size").over(w))
        # the first bucket that passes the budget; a source that never passes keeps no bucket and takes its prefix whole
        cross = run.filter(F.col("upto") > F.col("budget")).groupBy("source").agg(
            F.min(F.struct("bucket", "upto", "size", "budget")).alias("x")).select(
            "source", (F.col("x.budget") - (F.col("x.upto") - F.col("x.size"))).alias("budget"),
            F.col("x.bucket").alias("prefix"), F.col("x.size").alias("last"))
        open_ = stored(cross, "mix-level")
    # what is left is one draw for each source: take it if over half of it is within the budget
    near = open_.select(F.col("source").alias("s"), (F.col("prefix") + (F.col("budget") * 2 >= F.col("last")).cast("long")).alias("threshold"))
    full = F.lit(1 << DRAW_BITS)
    return base.join(near, base["source"].eqNullSafe(near["s"]), "left").select(
        base["source"], "source_size", "target", "copies",
        F.when((F.col("source_size") == 0) | (F.col("budget") <= 0), F.lit(0)).otherwise(F.coalesce("threshold", full)).cast("long").alias("threshold"))


def plan(docs: DataFrame, weights: tuple[int, ...], share: float, cap: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """The narrow rows (doc_id, source, size, draw) of `docs`, and (s, source_size, target, copies, threshold) for each source s."""
    require(docs, "doc_id", "text", "source")
    rows = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                              draw(F.col("doc_id"), seed).alias("draw")), "mix-rows")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    return rows, stored(thresholds(rows, targets(sources, weights, share, cap)), "mix-plan").withColumnRenamed("source", "s")


def _copies(own_draw: Column) -> Column:
    return F.col("copies") + (own_draw < F.col("threshold")).cast("long")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0, seed: int = 7) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies (0 to cap), taken.

    Sources in code point order, null last, weigh `weights` in turn. Null or
    empty text has size 0 and is never needed, though it is taken with its draw;
    repeated rows are rows of their own with the same draw; an empty table gives
    an empty table. Other columns of `docs` are ignored.
    """
    rows, goals = plan(docs, weights, share, cap, seed)
    out = rows.join(goals, rows["source"].eqNullSafe(goals["s"])).withColumn("copies", _copies(F.col("draw")))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def repeat(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0, seed: int = 7) -> DataFrame:
    """The mix itself: every row of `docs`, unchanged, as many times as it is taken (perhaps not at all)."""
    _, goals = plan(docs, weights, share, cap, seed)
    goals = goals.select(F.col("s").alias("_s"), "copies", "threshold").withColumnsRenamed({"copies": "_copies", "threshold": "_threshold"})
    times = F.col("_copies") + (draw(docs["doc_id"], seed) < F.col("_threshold")).cast("long")
    out = docs.join(goals, docs["source"].eqNullSafe(goals["_s"])).withColumn("_times", times).filter("_times > 0")
    return out.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))).alias("_copy")).select(*docs.columns)
