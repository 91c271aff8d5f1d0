"""Vector code compression: product codes whose entries are searched through a GNAT.

Vectors become integers and are cut into equal parts; each part position has a
codebook that a fixed number of rounds refines (assign every part to its nearest
entry, then replace each entry by the floored mean of its parts). The entries of
a codebook stand in a geometric near-neighbour access tree: a node holds split
points, every other entry goes to the subtree of its nearest split point, and
each split point keeps the range of its distances to the entries of each
subtree. The distances from a query to the split points rule whole subtrees out,
only where every entry there is strictly farther than the best one so far: roots
are rounded towards keeping, and what is left is compared as integer squares, so
that ties go to the lower index.

Only codebooks (entries times dimension integers) and their sums pass the driver.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepsake.llm.common import require, stored

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Split points of a node.
FAN = 4
#: Integers up to this size, squared and summed over a part, are added as 64-bit numbers; larger ones as Python integers.
SAFE = 1 << 62
LIMB = 32


@dataclass(frozen=True)
class Node:
    """splits: entries; low and high[i][j]: whole bounds of the distances from splits[i] to all entries of children[j]."""

    splits: tuple[int, ...]
    children: tuple["Node", ...]
    low: tuple[tuple[int, ...], ...]
    high: tuple[tuple[int, ...], ...]


def _square(a, b) -> int:
    return sum((x - y) ** 2 for x, y in zip(a, b))


def gnat(book: list[list[int]], among: list[int] | None = None) -> Node:
    """Tree over the entries `among` of `book`: split points are far from each other, the first is the lowest entry."""
    among = list(range(len(book))) if among is None else among
    splits = among[:1]
    while len(splits) < min(FAN, len(among)):
        splits.append(max((e for e in among if e not in splits), key=lambda e: (min(_square(book[e], book[s]) for s in splits), -e)))
    under: list[list[int]] = [[] for _ in splits]
    for e in among:
        if e not in splits:
            under[min(range(len(splits)), key=lambda i: (_square(book[e], book[splits[i]]), i))].append(e)
    under = [u for u in under if u]
    apart = [[[_square(book[s], book[e]) for e in u] for u in under] for s in splits]
    return Node(tuple(splits), tuple(gnat(book, u) for u in under),
                tuple(tuple(math.isqrt(min(d)) for d in row) for row in apart),
                tuple(tuple(math.isqrt(max(d)) + 1 for d in row) for row in apart))


def _roots(squares):
    """Whole numbers at most and at least the roots of `squares`."""
    import numpy as np

    if squares.dtype == object:
        low = np.frompyfunc(math.isqrt, 1, 1)(squares)
        return low, low + 1
    low = np.sqrt(squares.astype(np.float64)).astype(np.int64)  # off by less than one
    return low - 1, low + 2


def nearest(tree: Node, book, x):
    """(index, square) of the entry nearest to each row of `x`, ties to the lower index; int64 or Python integers."""
    import numpy as np

    best = ((x - book[tree.splits[0]]) ** 2).sum(axis=1)
    index = np.full(len(x), tree.splits[0])

    def visit(node: Node, rows):
        apart = []
        for s in node.splits:
            d = ((x[rows] - book[s]) ** 2).sum(axis=1)
            nearer = ((d < best[rows]) | ((d == best[rows]) & (s < index[rows]))).astype(bool)
            best[rows[nearer]], index[rows[nearer]] = d[nearer], s
            apart.append(_roots(d))
        for j, child in enumerate(node.children):
            reach = _roots(best[rows])[1]
            open_ = np.ones(len(rows), bool)
            for i, (low, high) in enumerate(apart):
                open_ &= ((low - reach <= node.high[i][j]) & (high + reach >= node.low[i][j])).astype(bool)
            if open_.any():
                visit(child, rows[open_])

    if len(x):
        visit(tree, np.arange(len(x)))
    return index, best


def _kept(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def _whole(x: float) -> int:
    return math.floor(x * SCALE) if abs(x) < 1 << 52 else int(x) * SCALE


def _integers(column, dim: int):
    """(mask of the kept rows, their integers as rows of `dim`) of an Arrow list column without null lists."""
    import numpy as np

    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    bad = np.r_[0, np.cumsum(~np.isfinite(values))]
    keep = bad[offsets[1:]] == bad[offsets[:-1]]
    length = np.diff(offsets)
    row = np.repeat(np.arange(len(length)), length)
    at = np.arange(len(values)) - np.repeat(offsets[:-1], length)
    here = keep[row]
    top = np.abs(values[here]).max(initial=0.0)
    if top * SCALE < 1 << 52:
        out, whole = np.zeros((len(length), dim), np.int64), np.floor(values[here] * SCALE).astype(np.int64)
    else:
        out, whole = np.zeros((len(length), dim), object), np.array([_whole(v) for v in values[here].tolist()], object)
    out[row[here], at[here]] = whole
    return keep, out[keep]


def _assign(x, books, trees, width: int):
    """Per part: (index, square) of the nearest entry, and the part's integers."""
    import numpy as np

    most = max([abs(c) for book in books for e in book for c in e] + [int(np.abs(x).max(initial=0))], default=0)
    kind = np.int64 if max(width, 1) * (2 * most) ** 2 < SAFE else object
    x = x.astype(kind)
    for p, (book, tree) in enumerate(zip(books, trees)):
        part = x[:, p * width:(p + 1) * width]
        yield part, *nearest(tree, np.array(book, kind).reshape(len(book), width), part)


def _sums(vectors: DataFrame, books: list[list[list[int]]], width: int) -> dict[tuple[int, int, int], int]:
    """(part, entry, position) -> sum of the parts that are nearest to the entry; position -1: their number.

    Each task adds up its rows first; sums leave it in limbs of 32 bits, so that no size of component overflows.
    """
    trees = [gnat(b) for b in books]
    dim = width * len(books)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        total: dict[tuple[int, int, int], int] = {}
        for batch in batches:
            _, x = _integers(batch.column(0), dim)
            for p, (part, index, _) in enumerate(_assign(x, books, trees, width)):
                for e in np.unique(index).tolist():
                    mine = part[index == e]
                    for i, v in enumerate([len(mine), *mine.sum(axis=0).tolist()]):
                        total[p, e, i - 1] = total.get((p, e, i - 1), 0) + int(v)
        out = []
        for key, v in total.items():
            sign, v, limb = (-1 if v < 0 else 1), abs(v), 0
            while v:
                out.append((*key, limb, sign * (v & ((1 << LIMB) - 1))))
                v, limb = v >> LIMB, limb + 1
        cols = list(zip(*out)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int32()] * 4 + [pa.int64()])],
                                         names=["part", "entry", "position", "limb", "v"])

    rows = vectors.select("embedding").mapInArrow(run, "part int, entry int, position int, limb int, v long")
    sums: dict[tuple[int, int, int], int] = {}
    for r in rows.groupBy("part", "entry", "position", "limb").agg(F.sum("v").alias("v")).collect():
        key = (r["part"], r["entry"], r["position"])
        sums[key] = sums.get(key, 0) + (r["v"] << (LIMB * r["limb"]))
    return sums


def _typed(vectors: DataFrame) -> Column:
    kind = dict(vectors.dtypes)["embedding"]
    return F.col("embedding") if kind in ("array<float>", "array<double>") else F.col("embedding").cast("array<double>")


def codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[list[list[int]]]:
    """Entries of each part position after `rounds` rounds; they start as the vectors with the smallest vec_ids.

    Rows that repeat a vec_id are rows of their own, ordered by their vectors;
    a null vec_id comes last. Fewer vectors than `entries` give as many entries.
    Vectors shorter than the longest kept one count as if zeros followed, also
    up to a multiple of `parts`. No vector that counts: no entries.
    """
    require(vectors, "vec_id", "embedding")
    v = vectors.select("vec_id", _typed(vectors).alias("embedding"))
    dim = v.agg(F.max(F.when(_kept(F.col("embedding")), F.size("embedding")))).first()[0]
    if dim is None:
        return [[] for _ in range(parts)]
    width = -(-dim // parts)
    first = [[_whole(x) for x in r["embedding"]] + [0] * (width * parts - len(r["embedding"]))
             for r in v.filter(_kept(F.col("embedding"))).orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).collect()]
    books = [[f[p * width:(p + 1) * width] for f in first] for p in range(parts)]
    rows = v.filter(F.col("embedding").isNotNull())
    for _ in range(rounds):
        sums = _sums(rows, books, width)
        books = [[[sums.get((p, e, i), 0) // n for i in range(width)] if (n := sums.get((p, e, -1), 0)) else old
                  for e, old in enumerate(book)] for p, book in enumerate(books)]
    return books


def encode(vectors: DataFrame, books: list[list[list[int]]]) -> DataFrame:
    """vec_id, label, code (index of each part's entry, two hex digits each or as many as needed), error (sum of squares).

    Vectors that are null or hold null or non-finite components are left out;
    an error beyond 64 bits is null. Other columns are ignored.
    """
    require(vectors, "vec_id", "embedding", "label")
    trees, width = [gnat(b) if b else None for b in books], len(books[0][0]) if books[0] else 0
    rows = vectors.select("vec_id", "label", _typed(vectors).alias("embedding")).filter(
        F.col("embedding").isNotNull() if books[0] else F.lit(False))
    digits = max(2, len(f"{max(len(books[0]) - 1, 0):x}"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            keep, x = _integers(batch.column(2), width * len(books))
            code, error = np.full(len(x), "", object), np.zeros(len(x), object)
            for _, index, square in _assign(x, books, trees, width):
                code = code + np.array([f"{e:0{digits}x}" for e in index.tolist()], object)
                error = error + square.astype(object)
            head = batch.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays(
                [head.column(0), head.column(1), pa.array(code.tolist(), pa.string()),
                 pa.array([e if e < 1 << 63 else None for e in error.tolist()], pa.int64())], names=["vec_id", "label", "code", "error"])

    schema = rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).schema
    return rows.mapInArrow(run, schema)


def fingerprint(books: list[list[list[int]]]) -> str:
    return hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """One row per vector that counts: vec_id, label, code, error, label_error, codebooks_sha256.

    label_error: sum of the errors of equal labels, nulls together; null if one
    of them or the sum is beyond 64 bits. Repeated rows are rows of their own
    and weigh as often as they stand. An empty table gives an empty table; other
    columns are ignored.
    """
    books = codebooks(vectors, parts, entries, rounds)
    rows = stored(encode(vectors, books), "codes")
    whole = F.when(F.count("error") == F.count(F.lit(1)), F.try_sum("error")).alias("label_error")
    # stored before it is joined back: a label may hold most rows, and AQE can split only plain exchanges
    sums = stored(rows.groupBy(F.col("label").alias("_label")).agg(whole), "codes-labels")
    return rows.join(sums, rows["label"].eqNullSafe(sums["_label"])).select(
        "vec_id", "label", "code", "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256"))
