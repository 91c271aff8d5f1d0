"""Ranked lexical search by presence-mask grouping.

Documents are reduced once to the terms that the items of a block use (term,
occurrences, length). Then every task takes its documents in batches: each term
has a bitmap over the batch, the bitmaps of an item's terms give every document
its mask of present terms, and documents are grouped by mask. The highest score
that a mask allows (the sum of its terms' highest parts in the batch) orders the
masks; they are evaluated from the top until the next one cannot reach the
item's k-th score any more. That score lives on from batch to batch in a task,
so most masks of later batches fall at once. The k best of each task meet in two
grouped rankings.

Items are a query set that goes through in blocks of bounded size, each against
all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keepsake.llm.common import discard, require, stored

TOP = 50
#: Bytes of item text in a block (a longer item is a block of its own): bounds what every task gets.
BLOCK_BYTES = 4 << 20
#: Documents that are looked at together, and masks that are evaluated together.
BATCH, STEP = 4096, 16
#: Tasks' lists of one item are ranked in so many groups before they meet.
GROUPS = 64
# Fixed values of the score.
IMPACT, SATURATION, LENGTH = 1_000_000_000, 1000, 20
#: Fixed value: every byte that is no ASCII digit or letter, and no part of a longer character, ends a term.
_FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of all other characters beyond ASCII; A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split(b" ") if text else []


@dataclass(frozen=True)
class Block:
    """Items of one block: their ids, their distinct terms as numbers, and the numbers of all terms."""

    ids: list
    items: list[list[int]]
    vocabulary: dict[bytes, int]


def blocks(items: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Every row of `items` once; the driver holds one block at a time."""
    ids, own, vocabulary, size = [], [], {}, 0
    for r in items.select("item_id", "text").toLocalIterator():
        if ids and size + len(r["text"] or "") > limit:
            yield Block(ids, own, vocabulary)
            ids, own, vocabulary, size = [], [], {}, 0
        found = sorted({t for t in terms(r["text"]) if t})
        ids.append(r["item_id"])
        own.append([vocabulary.setdefault(t, len(vocabulary)) for t in found])
        size += len(r["text"] or "")
    if ids:
        yield Block(ids, own, vocabulary)


def forward(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms with repeats), terms, times: the terms of `vocabulary` in each document that has any term at all."""
    schema = docs.select("doc_id", F.lit(0).cast("long").alias("n"), F.lit(None).cast("array<int>").alias("terms"),
                         F.lit(None).cast("array<long>").alias("times")).schema

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            n, numbers, times = [], [], []
            for text in batch.column(1):
                count = Counter(text.as_buffer().to_pybytes().translate(_FOLD).split(b" "))
                n.append(count.total() - count.pop(b"", 0))
                known = count.keys() & vocabulary.keys()
                numbers.append([vocabulary[t] for t in known])
                times.append([count[t] for t in known])
            out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(numbers, pa.list_(pa.int32())),
                                              pa.array(times, pa.list_(pa.int64()))], names=["doc_id", "n", "terms", "times"])
            yield out.filter(pa.array([x > 0 for x in n]))

    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("text")
    return docs.select("doc_id", text).mapInArrow(run, schema)


@dataclass(frozen=True)
class Statistics:
    """Of all documents with a term: their number, all their terms, and the weight of each term of the block."""

    documents: int
    length: int
    weights: list[int]

    @staticmethod
    def of(rows: DataFrame, vocabulary: dict[bytes, int]) -> "Statistics":
        n, length = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = dict.fromkeys(vocabulary.values(), 0)
        df |= {r["term"]: r["df"] for r in rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()}
        return Statistics(n, length, [math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in range(len(df))])


def _offer(best: list, ids: list, scores, rows, top: int) -> list:
    """The first `top` of `best` and the offered documents: (-score, doc_id is null, doc_id)."""
    import numpy as np

    if len(rows) > top:  # ties with the last one stay
        least = np.partition(scores, len(scores) - top)[len(scores) - top]
        rows, scores = rows[scores >= least], scores[scores >= least]
    found = [(-int(s), ids[r] is None, ids[r] if ids[r] is not None else 0) for s, r in zip(scores.tolist(), rows.tolist())]
    return sorted(best + found)[:top]


def _packed(where, n: int):
    import numpy as np

    bits = np.zeros(n, bool)
    bits[where] = True
    return np.packbits(bits)


def _search(best: list[list], block: Block, weights, ids: list, rows, numbers, parts, top: int) -> None:
    """Brings the documents of one batch into `best`, per item. rows, numbers, parts: document, term and score part of each posting."""
    import numpy as np

    order = np.lexsort((rows, numbers))
    rows, numbers, parts = rows[order], numbers[order], (parts * weights[numbers])[order]
    present, start = np.unique(numbers, return_index=True)
    end = np.append(start[1:], len(numbers))
    lists = {t: (rows[a:z], parts[a:z]) for t, a, z in zip(present.tolist(), start.tolist(), end.tolist())}
    most = {t: int(p.max()) for t, (_, p) in lists.items()}
    bitmaps = {t: _packed(r, len(ids)) for t, (r, _) in lists.items()}
    for i, wanted in enumerate(block.items):
        own = [t for t in wanted if most.get(t, 0) > 0]
        if not own:
            continue
        least = -best[i][-1][0] if len(best[i]) == top else 1
        if sum(most[t] for t in own) < least:
            continue
        # one row of bytes a document: bit j tells whether its j-th term is there
        masks = np.packbits(np.unpackbits(np.stack([bitmaps[t] for t in own]), axis=1, count=len(ids)), axis=0).T
        keys = np.ascontiguousarray(masks).view(f"V{masks.shape[1]}").ravel()
        _, first, group = np.unique(keys, return_index=True, return_inverse=True)
        reach = np.unpackbits(masks[first], axis=1, count=len(own)) @ np.array([most[t] for t in own], np.int64)
        by_reach = np.argsort(-reach, kind="stable")
        members = np.argsort(group, kind="stable")
        begin = np.searchsorted(group[members], np.arange(len(reach) + 1))
        for at in range(0, len(by_reach), STEP):
            least = -best[i][-1][0] if len(best[i]) == top else 1
            some = [g for g in by_reach[at:at + STEP].tolist() if reach[g] >= least]
            if not some:
                break
            docs = np.sort(np.concatenate([members[begin[g]:begin[g + 1]] for g in some]))
            scores = np.zeros(len(docs), np.int64)
            for t in own:
                r, p = lists[t]
                k = np.minimum(np.searchsorted(r, docs), len(r) - 1)
                scores += np.where(r[k] == docs, p[k], 0)
            good = scores >= least
            best[i] = _offer(best[i], ids, scores[good], docs[good], top)


def _best(rows: DataFrame, block: Block, known: Statistics, top: int) -> DataFrame:
    """item (number within the block), doc_id, score: the `top` best documents of each item in each task."""
    schema = rows.select(F.lit(0).alias("item"), "doc_id", F.lit(0).cast("long").alias("score")).schema

    def run(batches):
        import numpy as np
        import pyarrow as pa

        weights = np.array(known.weights, np.int64)
        best: list[list] = [[] for _ in block.items]
        kind = None
        for whole in batches:
            kind = whole.schema.field(0).type
            for at in range(0, whole.num_rows, BATCH):
                b = whole.slice(at, BATCH)
                n = b.column(1).to_numpy()
                listed = b.column(2)
                doc = np.repeat(np.arange(len(n)), np.diff(listed.offsets.to_numpy()))
                numbers = listed.flatten().to_numpy()
                length = 50 + (50 * n * known.documents) // known.length
                parts = (IMPACT * b.column(3).flatten().to_numpy()) // (SATURATION * b.column(3).flatten().to_numpy() + LENGTH * length[doc])
                _search(best, block, weights, b.column(0).to_pylist(), doc, numbers, parts, top)
        if kind is not None:
            out = [(i, None if none else doc, -score) for i, found in enumerate(best) for score, none, doc in found]
            cols = list(zip(*out)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), kind, pa.int64()))], names=["item", "doc_id", "score"])

    return rows.mapInArrow(run, schema)


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    by_group = Window.partitionBy("item", "_group").orderBy(*order)
    some = found.withColumn("_group", F.spark_partition_id() % GROUPS).withColumn("_r", F.row_number().over(by_group)).filter(F.col("_r") <= top)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= top)


def rank(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's `top` best documents with a score above 0, ties by doc_id.

    Null and empty texts have no term: such documents are not counted, such
    items get no rows. Every row is a document or an item of its own, also where
    ids repeat (rows that tie in everything take the ranks in any order, with
    equal contents); a null doc_id comes after all others of its score. Empty
    tables give an empty table; other columns are ignored.
    """
    require(docs, "doc_id", "text")
    require(items, "item_id", "text")
    spark, out = docs.sparkSession, None
    schema = items.select("item_id", F.lit(0).alias("rank")).schema.add(docs.schema["doc_id"]).add("score", "long")
    for block in blocks(items, block_bytes):
        rows = stored(forward(docs, block.vocabulary), "search-forward")
        found = stored(_ranked(_best(rows, block, Statistics.of(rows, block.vocabulary), top), top), "search-ranked")
        discard(rows)
        names = spark.createDataFrame(list(enumerate(block.ids)), schema=f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
        part = found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")  # as many names as items in a block
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out
