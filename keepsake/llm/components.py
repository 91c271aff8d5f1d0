"""Connected components of an edge table by alternating star contraction.

Every round is two grouped minima and a join. A hub is reduced by partial
aggregates; the minima are stored before they are joined back, as AQE can split
the hub's side of the join only if both sides are plain. No neighbour list is
ever built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepsake.llm.common import discard, stored


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-low")
    return both.join(low, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    low = stored(e.groupBy("u").agg(F.min("v").alias("m")), "cc-low")
    kept = low.select("u", F.col("m").alias("v"))
    moved = e.join(low, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return kept.unionByName(moved)


def components(edges: DataFrame, left: str = "a", right: str = "b", max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node that has an edge; root is the smallest node of its component.

    Self-loops and null ends are ignored, an empty table gives an empty table,
    repeated edges count once. Rounds grow with the logarithm of the size.
    """
    e = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).filter(
        F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col("u") != F.col("v"))).distinct()
    e = stored(e, "cc")
    seen = None
    for _ in range(max_rounds):
        wide = stored(_large_star(e).distinct(), "cc")
        nxt = stored(_small_star(wide).distinct(), "cc")
        discard(wide)
        n, roots = nxt.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(e)
        e = nxt
        if (n, roots) == seen:
            break
        seen = (n, roots)
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
