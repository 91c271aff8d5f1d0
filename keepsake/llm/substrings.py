"""Substring dedup by min-hash anchors and counting of windows, in place of relative Lempel-Ziv parsing.

Every window of WINDOW words has one anchor: the k-gram in it with the least
hash. Consecutive windows with the same anchor place form a phrase (the words
that these windows span); no reference is looked at for that. Phrases are
counted by hash: one that stands twice or more is found whole. Where a phrase
stands once but its anchor does not, each of its windows is counted by itself.
Runs of found windows are the duplicate spans. Nothing is matched greedily:
factoring each document against each block of the corpus would be quadratic.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepsake.llm.common import discard, require, stored, text_key

WINDOW = 35
ANCHOR = 8
#: Bytes of text hashed at once, and window starts whose anchors are found at once: memory follows these.
SLICE = 1 << 20
STARTS = 1 << 16


def _word_hashes(body: bytes | None):
    """XXH64 of each word of a text, as uint64."""
    import numpy as np
    import xxhash

    out, space, at, body = [], re.compile(rb"[\x20\x09-\x0D]"), 0, body or b""
    while at < len(body):
        cut = space.search(body, at + SLICE)
        end = cut.start() if cut else len(body)
        out.append(np.frombuffer(b"".join(map(xxhash.xxh64_digest, body[at:end].split())), ">u8").astype(np.uint64))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


class _Rolling:
    """Hashes of any word runs of a text: a polynomial modulo 2**64 in an odd base, then mixed."""

    def __init__(self, words, base: int):
        import numpy as np

        n = len(words) + 1
        powers = np.ones(n, np.uint64)
        powers[1:] = np.uint64(base)
        inverse = np.ones(n, np.uint64)
        inverse[1:] = np.uint64(pow(base, -1, 1 << 64))
        powers, self.inverse = np.cumprod(powers), np.cumprod(inverse)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(words * powers[:-1], out=self.sums[1:])

    def runs(self, starts, lengths):
        import numpy as np

        h = (self.sums[starts + lengths] - self.sums[starts]) * self.inverse[starts]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(29))


BASES = (0x2545F4914F6CDD1D, 0x5851F42D4C957F2D)


def _phrases(words, window: int, k: int):
    """(anchor hash, phrase hash, first start, number of starts, anchor's offset) of the phrases of a text."""
    import numpy as np

    n = len(words) - window + 1
    if n <= 0:
        return None
    roll = _Rolling(words, BASES[0])
    grams = roll.runs(np.arange(len(words) - k + 1), k)
    width = window - k + 1
    place = np.empty(n, np.int64)
    for at in range(0, n, STARTS):
        end = min(at + STARTS, n)
        view = np.lib.stride_tricks.sliding_window_view(grams[at:end + width - 1], width)
        place[at:end] = view.argmin(axis=1) + np.arange(at, end)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    count = np.diff(np.r_[first, n])
    offset = place[first] - first
    phrase = roll.runs(first, count + window - 1) + (count * 256 + offset).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return grams[place[first]], phrase, first, count, offset


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", text_key(F.col("text")).alias("th"), F.col("text").cast("binary").alias("text"))


def phrase_table(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR) -> DataFrame:
    """(anchor, phrase, doc_id, th, start, n): each phrase of each text, with the number n of its windows."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            out, at = [], []
            for i, body in enumerate(b.column(2)):
                got = _phrases(_word_hashes(body.as_py()), window, k)
                if got:
                    out.append(got)
                    at.append(np.full(len(got[0]), i))
            if out:
                anchor, phrase, first, count, _ = (np.concatenate(x) for x in zip(*out))
                rows = pa.array(np.concatenate(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(phrase.view(np.int64)), b.column(0).take(rows), b.column(1).take(rows),
                     pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32))], ["anchor", "phrase", "doc_id", "th", "start", "n"])

    kind = dict(docs.dtypes)["doc_id"]
    return _keyed(docs).mapInArrow(run, f"anchor long, phrase long, doc_id {kind}, th long, start int, n int")


def _windows(docs: DataFrame, parts: DataFrame, window: int) -> DataFrame:
    """(w1, w2, doc_id, th, start, copies): the windows of `parts` (doc_id, th, start, n, copies), by 128 bits of hash."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            out = []
            for i, (body, spots) in enumerate(zip(b.column(2), b.column(3).to_pylist())):
                words = _word_hashes(body.as_py())
                n = np.array([s["n"] for s in spots])
                starts = np.concatenate([np.arange(s["start"], s["start"] + s["n"]) for s in spots])
                out.append((*(_Rolling(words, base).runs(starts, window) for base in BASES), starts,
                            np.repeat([s["copies"] for s in spots], n), np.full(len(starts), i)))
            if out:
                w1, w2, starts, copies, rows = (np.concatenate(x) for x in zip(*out))
                rows = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64)), b.column(0).take(rows), b.column(1).take(rows),
                     pa.array(starts.astype(np.int32)), pa.array(copies.astype(np.int32))], ["w1", "w2", "doc_id", "th", "start", "copies"])

    lists = parts.groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "n", "copies")).alias("spots"))
    kind = dict(docs.dtypes)["doc_id"]
    # rows that repeat doc_id and text are one here; their phrases stood twice, so they are not looked up again
    one = _keyed(docs)
    return _with(one, lists, "inner").select("doc_id", "th", "text", "spots").mapInArrow(
        run, f"w1 long, w2 long, doc_id {kind}, th long, start int, copies int")


def _with(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    other = lists.withColumnsRenamed({"doc_id": "_d", "th": "_t"})
    return docs.join(other, docs["doc_id"].eqNullSafe(other["_d"]) & (docs["th"] == other["_t"]), how).drop("_d", "_t")


def duplicate_starts(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR) -> DataFrame:
    """(doc_id, th, start, n): runs of window starts whose window also starts elsewhere."""
    table = stored(phrase_table(docs, window, k), "rlz-phrases")
    # sums are written before they are joined: a join with a fresh exchange on both sides is one that AQE can split
    twice = stored(table.groupBy("anchor").count().filter("count > 1").select("anchor"), "rlz-anchors")
    shared = stored(table.join(twice, "anchor"), "rlz-shared")
    discard(table)
    first = F.min(F.struct("doc_id", "th", "start")).alias("at")
    reference = stored(shared.groupBy("anchor", "phrase", "n").agg(F.count("*").alias("copies"), first), "rlz-reference")
    whole = shared.join(reference.filter("copies > 1").select("anchor", "phrase", "n"), ["anchor", "phrase", "n"], "left_semi").select(
        "doc_id", "th", "start", "n")
    # blocks in which some phrase stands once: one place of each phrase there is looked at window by window
    ends = stored(reference.filter("copies = 1").select("anchor").distinct(), "rlz-ends")
    parts = reference.join(ends, "anchor", "left_semi").select("at.doc_id", "at.th", "at.start", "n", "copies")
    looked = stored(_windows(docs, parts, window), "rlz-windows")
    seen = stored(looked.groupBy("w1", "w2").agg(F.sum("copies").alias("times")).filter("times > 1").select("w1", "w2"), "rlz-seen")
    loose = looked.filter("copies = 1").join(seen, ["w1", "w2"], "left_semi").select("doc_id", "th", "start", F.lit(1).alias("n"))
    return whole.unionByName(loose)


def _strip(body: bytes | None, spots: list[dict], window: int) -> tuple[int, int, bytes, list[tuple[int, int]]]:
    """(words, words removed, kept words, spans [from, to) of the factors) of a text."""
    words = (body or b"").split()
    spans: list[list[int]] = []
    for s in sorted(spots, key=lambda s: s["start"]):
        a, b = s["start"], s["start"] + s["n"] - 1 + window
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b])
    kept, at = [], 0
    for a, b in spans:
        kept += words[at:a]
        at = b
    kept += words[at:]
    return len(words), len(words) - len(kept), b" ".join(kept), [(a, b) for a, b in spans]


def deduplicate(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (the other words, joined by a space), spans.

    A word goes if a window that covers it has the same words as a window that
    starts at another place of the corpus, its own text included. Null texts
    have no words; texts shorter than a window are kept; rows that repeat a
    text repeat its windows, so both lose them; an empty table gives an empty
    table; other columns are ignored.
    """
    require(docs, "doc_id", "text")
    starts = stored(duplicate_starts(docs, window, k), "rlz-starts")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            got = [_strip(body.as_py(), spots or [], window) for body, spots in zip(b.column(2), b.column(3).to_pylist())]
            words, removed, kept, spans = zip(*got) if got else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array([x.decode() for x in kept], pa.string()),
                 pa.array([[{"from": a, "to": e} for a, e in x] for x in spans],
                          pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())])))], ["doc_id", "n_words", "n_removed", "kept", "spans"])

    lists = starts.groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "n")).alias("spots"))
    kind = dict(docs.dtypes)["doc_id"]
    return _with(_keyed(docs), lists, "left").select("doc_id", "th", "text", "spots").mapInArrow(
        run, f"doc_id {kind}, n_words long, n_removed long, kept string, spans array<struct<from:int,to:int>>")
