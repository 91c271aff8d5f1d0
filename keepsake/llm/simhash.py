"""SimHash near-duplicates by pigeonring filtering.

A fingerprint is cut into m segments on a ring. If two fingerprints differ in
at most t bits, some segment starts a chain in which every prefix of l segments
differs in at most l*t/m bits. So the first segments of the chain (those whose
budget is below one bit) agree, and the stretch whose budget is below two bits
differs once at most: one half of it agrees. These bits are the join key; the
chain budgets then prune candidates before the full Hamming check.

A bucket with too many fingerprints is split again: of the bits that its key
leaves open, cut into t+1 groups, one group must agree. This is exact, and after
the last level a bucket cannot hold more than 2**(open bits) fingerprints.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepsake.llm.common import require, stored
from keepsake.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEGMENTS = 8
SEED = 42
#: Fingerprints of a bucket that are compared in one task; larger buckets are split by further bits.
BUCKET = 2048
LEVELS = 4
#: Bytes of text cut into words at once, so that memory does not follow a text's length.
SLICE = 1 << 20


def _word_slices(body: bytes) -> Iterator[list[bytes]]:
    space, at = re.compile(rb"[\x20\x09-\x0D]"), 0
    while at < len(body):
        cut = space.search(body, at + SLICE)
        end = cut.start() if cut else len(body)
        yield body[at:end].lower().split()
        at = end


def fingerprint(body: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits, each the majority of that bit over the XXH64 of all word shingles; no words: 0."""
    import numpy as np
    import xxhash

    ones, n, tail = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_digest

    def count(grams) -> None:
        nonlocal ones, n
        got = np.frombuffer(b"".join([digest(g, seed) for g in grams]), np.uint8).reshape(-1, 8)
        ones += np.unpackbits(got, axis=1).sum(axis=0, dtype=np.int64)
        n += len(got)

    for words in _word_slices(body or b""):
        words = tail + words
        if len(words) >= shingle:
            count(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
            tail = words[len(words) - shingle + 1:] if shingle > 1 else []
        else:
            tail = words
    if not n and tail:
        count([b" ".join(tail)])
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big") if n else 0


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """`docs` without text, with fp (the fingerprint as a signed long)."""
    require(docs, "text")
    rest = [f for f in docs.schema.fields if f.name not in ("text", "fp")]
    names = [f.name for f in rest]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            bodies = b.column(len(names))
            fp = np.array([fingerprint(x.as_py(), shingle) for x in bodies], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(names))), pa.array(fp)], [*names, "fp"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rest] + ["fp long"])
    return docs.select(*names, F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def _bits(positions) -> int:
    """A mask with bits at `positions`, counted from the highest."""
    return sum(1 << (63 - p % 64) for p in positions)


def _budget(l: int) -> int:
    return l * MAX_BITS // SEGMENTS


def _chain_keys() -> list[tuple[int, int]]:
    """(start segment, mask) of the bits on which fingerprints agree that some chain lets through."""
    width = 64 // SEGMENTS
    agree = max(l for l in range(SEGMENTS + 1) if _budget(l) < 1)
    once = max(l for l in range(SEGMENTS + 1) if _budget(l) < 2)
    keys = []
    for start in range(SEGMENTS):
        at = start * width
        sure, rest = range(at, at + agree * width), range(at + agree * width, at + once * width)
        for half in (rest[:len(rest) // 2], rest[len(rest) // 2:]):
            keys.append((start, _bits(sure) | _bits(half)))
    return keys


def _levels(keys: list[tuple[int, int]]) -> list[list[tuple[int, int, int, int]]]:
    """For each level the (id, parent, start, mask) of its keys; each splits the open bits of the level above."""
    levels = [[(i, -1, start, mask) for i, (start, mask) in enumerate(keys)]]
    while len(levels) < LEVELS:
        nxt: list = []
        for i, _, start, mask in levels[-1]:
            left = [p for p in range(64) if not mask & _bits([p])]
            nxt += [(len(nxt) + g, i, start, mask | _bits(left[g::MAX_BITS + 1])) for g in range(MAX_BITS + 1)]
        levels.append(nxt)
    return levels


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _forest(fps, start: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among `fps` that the chain from segment `start` lets through (-1: all links)."""
    import numpy as np

    width = 64 // SEGMENTS
    # budgets rise at these lengths only: the longest prefix with each budget implies the shorter ones
    ends = [max(l for l in range(1, SEGMENTS + 1) if _budget(l) == b) for b in range(MAX_BITS + 1)]
    prefixes = [(np.uint64(_bits(range(start * width, (start + l) * width))), b) for b, l in enumerate(ends) if start >= 0 or l == SEGMENTS]
    left, edges = np.unique(np.asarray(fps, np.int64)).view(np.uint64), []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            diff = left ^ at
            hit = np.flatnonzero(np.bitwise_count(diff & prefixes[0][0]) <= prefixes[0][1])
            for mask, most in prefixes[1:]:  # the last prefix is the whole ring: the Hamming check
                hit = hit[np.bitwise_count(diff[hit] & mask) <= most]
            if len(hit):
                edges += [(int(at.view(np.int64)), int(x)) for x in left[hit].view(np.int64)]
                queue += list(left[hit])
                left = np.delete(left, hit)
    return edges


def links(distinct: DataFrame, keys: list[tuple[int, int]] | None = None) -> DataFrame:
    """(a, b): edges that connect exactly the fingerprints of `distinct` (fp) that links of MAX_BITS bits connect.

    keys: (start segment, mask) such that linked fingerprints agree on a mask at
    least; start -1 does without the chain test. By default the chains' keys.
    """
    spark = distinct.sparkSession
    found = None
    rows = distinct
    levels = _levels(keys or _chain_keys())
    for level, masks in enumerate(levels):
        if level:
            below = spark.createDataFrame([(p, i, s, _signed(m)) for i, p, s, m in masks], "parent int, id int, start int, mask long")
            keyed = rows.withColumnRenamed("id", "parent").join(F.broadcast(below), "parent")  # a few keys, times 4 for each level
        else:
            keyed = rows.select("fp", F.inline(F.array(*[F.struct(F.lit(i).alias("id"), F.lit(s).alias("start"), F.lit(_signed(m)).alias("mask"))
                                                         for i, _, s, m in masks])))
        keyed = keyed.select("fp", "id", "start", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
        counts = stored(keyed.groupBy("id", "key").count().filter("count > 1"), "simhash-buckets")
        last = level == len(levels) - 1
        small = counts if last else counts.filter(F.col("count") <= BUCKET)
        groups = keyed.join(small.drop("count"), ["id", "key"]).groupBy("id", "key").agg(
            F.first("start").alias("start"), F.collect_list("fp").alias("fps"))
        edges = stored(groups.select("start", "fps").mapInArrow(_edges, "a long, b long"), "simhash-links")
        found = edges if found is None else found.unionByName(edges)
        hot = counts.filter(F.col("count") > BUCKET)
        if last or hot.isEmpty():
            return found
        rows = stored(keyed.join(hot.drop("count"), ["id", "key"]).select("fp", "id"), "simhash-hot")
    return found


def _edges(batches):
    import pyarrow as pa

    for b in batches:
        out = [e for start, fps in zip(b.column(0).to_pylist(), b.column(1)) for e in _forest(fps.values.to_numpy(), start)]
        yield pa.RecordBatch.from_arrays([pa.array([e[i] for e in out], pa.int64()) for i in (0, 1)], ["a", "b"])


def groups(fps: DataFrame) -> DataFrame:
    """(fp, root, component_id) for every fingerprint of `fps` (doc_id, fp).

    root names the component; component_id is its smallest doc_id that is not
    null (null if there is none).
    """
    each = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    comp = components(links(each.select("fp")))
    named = stored(each.join(comp, each["fp"] == comp["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "low"), "simhash-roots")
    # stored before it is joined back: a component may hold most rows, and AQE can split only plain exchanges
    low = stored(named.groupBy("root").agg(F.min("low").alias("component_id")), "simhash-low")
    return stored(named.select("fp", "root").join(low, "root").select("fp", "root", "component_id"), "simhash-groups")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Null and empty texts have fingerprint 0 and are linked like any other;
    repeated rows are rows of their own in one group; an empty table gives an
    empty table; other columns are ignored.
    """
    require(docs, "doc_id", "text")
    fps = stored(fingerprints(docs.select("doc_id", "text")), "simhash-fps")
    return fps.join(groups(fps).drop("root"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def row_name(doc_id: Column, text: Column) -> Column:
    """A row by value: a recomputed task gives it again, unlike a running number."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), F.hex(F.xxhash64(text)))


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with one of each group: the smallest doc_id (nulls last), then the smallest text hash.

    All columns stay; of rows that repeat doc_id and text one stays.
    """
    require(docs, "doc_id", "text")
    name = row_name(F.col("doc_id"), F.col("text"))
    fps = stored(fingerprints(docs.select("doc_id", name.alias("name"), "text")), "simhash-fps")
    best = fps.join(groups(fps).drop("component_id"), "fp").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "name")).alias("best"))
    keep = stored(best.select(F.col("best.name").alias("_name")), "simhash-keep")
    return docs.withColumn("_name", name).join(keep, "_name", "left_semi").dropDuplicates(["_name"]).drop("_name")
