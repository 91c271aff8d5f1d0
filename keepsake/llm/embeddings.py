"""Embedding near-dedup by an epsilon grid order join.

Unit vectors with cosine >= c are at most eps = sqrt(2 - 2c) apart, and so are
their projections on any orthonormal directions. Vectors are sorted by the grid
cells (side eps) of their leading principal coordinates; blocks of consecutive
vectors are the leaves of an interval tree. Pairs of intervals are split level
by level, and a pair whose bounding boxes are more than eps apart is skipped.
Surviving block pairs are split on in their task, down to small products.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keepsake.llm.common import require, stored
from keepsake.llm.components import components

COSINE = 0.9
#: Principal directions are fitted on this many vectors, chosen by hash; they steer the order, not the result.
SAMPLE = 4096
GRID_DIMS, BOX_DIMS = 8, 16
BLOCK = 4096
LEAF = 256
FAN_BITS = 4
ROUNDING = 1e-9


def _clean(vectors: DataFrame) -> DataFrame:
    """Vectors that can link: not null, finite in every component, not zero."""
    v = vectors.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.filter(F.coalesce(finite, F.lit(False)) & F.exists("embedding", lambda x: x != 0))


def _directions(distinct: DataFrame, dim: int):
    """Orthonormal principal directions of a bounded sample, as a (dim, dims) matrix."""
    import numpy as np

    rows = distinct.select("embedding", F.xxhash64("embedding").alias("h")).orderBy("h").limit(SAMPLE).select("embedding").collect()
    x = _unit(np.array([list(r[0]) + [0.0] * (dim - len(r[0])) for r in rows], np.float64))
    x = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(x.T @ x)
    return np.ascontiguousarray(vectors[:, np.argsort(-values)][:, :max(GRID_DIMS, BOX_DIMS)])


def _unit(x):
    import numpy as np

    x = x / np.abs(x).max(axis=1, keepdims=True)  # first to a harmless scale: squares of tiny or huge values would not be finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _ordered(distinct: DataFrame, directions, dim: int, eps: float) -> DataFrame:
    """`distinct` (gid, raw, copies) with its rank in grid order."""
    dims = min(GRID_DIMS, directions.shape[1])

    def run(batches):
        import numpy as np
        import pandas as pd

        for b in batches:
            if len(b):
                x = _unit(np.stack([np.frombuffer(r, np.float64) for r in b["raw"]])) @ directions[:, :dims]
                cells = np.floor(x / eps).astype(int).tolist()
                yield pd.DataFrame({"gid": b["gid"], "raw": b["raw"], "copies": b["copies"], "cells": cells, "lead": x[:, 0]})

    placed = distinct.mapInPandas(run, "gid long, raw binary, copies long, cells array<int>, lead double")
    keys = ["cells", "lead", "gid"]
    parts = stored(placed.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), "ego-order")
    # one row for each shuffle partition
    before = parts.groupBy("part").count().withColumn("before", F.coalesce(F.sum("count").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    inner = F.row_number().over(Window.partitionBy("part").orderBy(*keys)) - 1
    return parts.withColumn("inner", inner).join(before, "part").select("gid", "raw", "copies", (F.col("inner") + F.col("before")).alias("rank"))


def _blocks(ordered: DataFrame, directions, dim: int) -> DataFrame:
    """(block, low, high, gids, copies, raw): BLOCK consecutive vectors each, with the box of their projections."""
    rows = ordered.groupBy(F.floor(F.col("rank") / BLOCK).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "gid", "copies", "raw"))).alias("v"))

    def run(batches):
        import numpy as np
        import pandas as pd

        for b in batches:
            for block, v in zip(b["block"], b["v"]):
                raw = b"".join(x["raw"] for x in v)
                x = _unit(np.frombuffer(raw, np.float64).reshape(-1, dim)) @ directions
                yield pd.DataFrame({"block": [block], "low": [x.min(axis=0).tolist()], "high": [x.max(axis=0).tolist()],
                                    "gids": [np.array([x["gid"] for x in v], np.int64).tobytes()],
                                    "copies": [np.array([x["copies"] for x in v], np.int64).tobytes()], "raw": [raw]})

    return rows.mapInPandas(run, "block long, low array<double>, high array<double>, gids binary, copies binary, raw binary")


def _near(limit: float):
    """Whether two boxes may hold points within the distance whose square is `limit`."""
    gap = F.aggregate(
        F.zip_with(F.arrays_zip("a_low", "a_high"), F.arrays_zip("b_low", "b_high"),
                   lambda a, b: F.greatest(F.lit(0.0), a["a_low"] - b["b_high"], b["b_low"] - a["a_high"])),
        F.lit(0.0), lambda s, g: s + g * g)
    return gap <= limit


def _pairs(boxes: DataFrame, dims: int, limit: float) -> DataFrame:
    """(a, b), a <= b: the block pairs that the recursive interval join leaves."""
    top = boxes.agg(F.coalesce(F.max("block"), F.lit(0))).first()[0]
    bits = max(int(top).bit_length(), 1)
    pairs = boxes.sparkSession.createDataFrame([(0, 0)], "a long, b long")
    low = F.array(*[F.min(F.col("low")[i]) for i in range(dims)]).alias("low")
    high = F.array(*[F.max(F.col("high")[i]) for i in range(dims)]).alias("high")
    while bits > 0:
        step = min(FAN_BITS, bits)
        bits -= step
        nodes = stored(boxes.groupBy(F.shiftright("block", bits).alias("node")).agg(low, high).withColumn(
            "parent", F.shiftright("node", step)), "ego-nodes")
        a = nodes.select(*[F.col(c).alias(f"a_{c}") for c in nodes.columns])
        b = nodes.select(*[F.col(c).alias(f"b_{c}") for c in nodes.columns])
        pairs = stored(pairs.join(a, pairs["a"] == a["a_parent"]).join(b, F.col("b") == b["b_parent"]).filter(
            (F.col("a_node") <= F.col("b_node")) & _near(limit)).select(F.col("a_node").alias("a"), F.col("b_node").alias("b")), "ego-pairs")
    return pairs


def _join(left, right, same: bool, directions, cosine: float, limit: float):
    """Links of two blocks (gids, copies, unit vectors): copies linked to each row, and a spanning forest."""
    import numpy as np

    (ga, ca, xa), (gb, cb, xb) = left, right
    pa, pb = xa @ directions, xb @ directions
    na, nb = np.zeros(len(ga), np.int64), np.zeros(len(gb), np.int64)
    labels = np.arange(len(ga) + (0 if same else len(gb)))
    shift = 0 if same else len(ga)
    edges: list[tuple[int, int]] = []

    def leaf(i0, i1, j0, j1):
        hit = xa[i0:i1] @ xb[j0:j1].T >= cosine
        if same and i0 == j0:
            np.fill_diagonal(hit, False)
        if not hit.any():
            return
        na[i0:i1] += hit @ cb[j0:j1]
        if not (same and i0 == j0):
            nb[j0:j1] += ca[i0:i1] @ hit
        for i in np.flatnonzero(hit.any(axis=1)):
            cols = np.flatnonzero(hit[i]) + j0
            other, own = labels[cols + shift], labels[i + i0]
            if (other != own).any():
                for lab, k in zip(*np.unique(other, return_index=True)):
                    if lab != own:
                        edges.append((int(ga[i + i0]), int(gb[cols[k]])))
                labels[np.isin(labels, other)] = own

    todo = [(0, len(ga), 0, len(gb))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        gap = np.maximum(0, np.maximum(pa[i0:i1].min(0) - pb[j0:j1].max(0), pb[j0:j1].min(0) - pa[i0:i1].max(0)))
        if (gap * gap).sum() > limit:
            continue
        if max(i1 - i0, j1 - j0) <= LEAF:
            leaf(i0, i1, j0, j1)
        elif same and i0 == j0 and i1 == j1:
            m = (i0 + i1) // 2
            todo += [(i0, m, i0, m), (i0, m, m, i1), (m, i1, m, i1)]
        elif i1 - i0 >= j1 - j0:
            m = (i0 + i1) // 2
            todo += [(i0, m, j0, j1), (m, i1, j0, j1)]
        else:
            m = (j0 + j1) // 2
            todo += [(i0, i1, j0, m), (i0, i1, m, j1)]
    return na, nb, edges


def links(distinct: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Of `distinct` (gid, embedding, copies): rows (gid, other, n).

    other null: n copies of other vectors are linked to gid, to be summed.
    other not null: an edge of a forest that connects what links connect. A
    shorter vector counts as if zeros followed.
    """
    spark: SparkSession = distinct.sparkSession
    schema = "gid long, other long, n long"
    dim = distinct.agg(F.max(F.size("embedding"))).first()[0]
    if not dim:
        return spark.createDataFrame([], schema)
    eps = math.sqrt(2 - 2 * cosine)
    limit = eps * eps + ROUNDING
    directions = _directions(distinct, dim)

    def pack(batches):
        import numpy as np
        import pandas as pd

        for b in batches:
            raw = [np.r_[np.asarray(e, np.float64), np.zeros(dim - len(e))].tobytes() for e in b["embedding"]]
            yield pd.DataFrame({"gid": b["gid"], "raw": raw, "copies": b["copies"]})

    packed = distinct.select("gid", "embedding", "copies").mapInPandas(pack, "gid long, raw binary, copies long")
    blocks = stored(_blocks(_ordered(packed, directions, dim, eps), directions, dim), "ego-blocks")
    pairs = _pairs(blocks.select("block", "low", "high"), directions.shape[1], limit)

    def run(batches):
        import numpy as np
        import pandas as pd

        def block(g, c, r):
            return np.frombuffer(g, np.int64), np.frombuffer(c, np.int64), _unit(np.frombuffer(r, np.float64).reshape(-1, dim))

        for b in batches:
            for i in range(len(b)):
                r = b.iloc[i]
                left = block(r["a_gids"], r["a_copies"], r["a_raw"])
                same = r["a"] == r["b"]
                right = left if same else block(r["b_gids"], r["b_copies"], r["b_raw"])
                na, nb, edges = _join(left, right, same, directions, cosine, limit)
                n = na + nb if same else np.concatenate([na, nb])
                gid = left[0] if same else np.concatenate([left[0], right[0]])
                out = [(int(g), None, int(k)) for g, k in zip(gid[n > 0], n[n > 0])] + [(a, z, None) for a, z in edges]
                yield pd.DataFrame(out, columns=["gid", "other", "n"]).astype("Int64")

    data = blocks.select("block", "gids", "copies", "raw")
    a = data.select(*[F.col(c).alias(f"a_{c}") for c in data.columns])
    b = data.select(*[F.col(c).alias(f"b_{c}") for c in data.columns])
    both = pairs.join(a, pairs["a"] == a["a_block"]).join(b, F.col("b") == b["b_block"]).drop("a_block", "b_block")
    # a row holds two blocks of some megabytes: a few at a time go to Python
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "4")
    try:
        return stored(both.mapInPandas(run, schema), "ego-links")
    finally:
        spark.conf.set(name, before)


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Copies of a vector are compared once and count as often as they stand.
    Vectors that are null, empty, zero or hold null or non-finite components
    have no links and are their own component. A null vec_id is nobody's
    component_id and is never kept; rows that repeat a vec_id are rows of their
    own. An empty table gives an empty table; other columns are ignored.
    """
    require(vectors, "vec_id", "embedding")
    rows = vectors.select("vec_id", "embedding")
    h = F.xxhash64("embedding")
    each = _clean(rows).groupBy(h.alias("h"), "embedding").agg(F.count("*").alias("copies"), F.min("vec_id").alias("low"))
    each = stored(each.withColumn("gid", F.monotonically_increasing_id()), "ego-distinct")
    found = links(each, cosine)
    degree = found.filter(F.col("other").isNull()).groupBy("gid").agg(F.sum("n").alias("n"))
    comp = components(found.filter(F.col("other").isNotNull()).select(F.col("gid").alias("a"), F.col("other").alias("b")))
    named = each.join(degree, "gid", "left").join(comp, F.col("gid") == F.col("node"), "left").select(
        "gid", "h", "embedding", "low", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "gid").alias("root"))
    named = stored(named, "ego-named")
    # stored before it is joined back: a component may hold most rows, and AQE can split only plain exchanges
    low = stored(named.groupBy("root").agg(F.min("low").alias("component_id")), "ego-low")
    facts = named.join(low, "root").select(F.col("h").alias("_h"), F.col("embedding").alias("_e"), F.col("n_links"), "component_id")
    keyed = rows.withColumn("_k", h)
    out = keyed.join(facts, (F.col("_k") == F.col("_h")) & (F.col("embedding") == F.col("_e")), "left")
    linked = F.col("_h").isNotNull()
    component = F.when(linked, F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
