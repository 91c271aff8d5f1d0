"""Language identification by compression with one zstandard raw-content dictionary for each language.

A text is compressed with each language's dictionary, in pieces so that the
dictionary counts to its end; the language whose dictionary makes it smallest
is the prediction. Sizes are whole bytes, so short texts tie: the tied
languages then compress the text's suffixes too. If the next language comes
within a small margin, the prediction is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepsake.llm.common import require, stored

#: Bytes of training text in a dictionary, and the texts that it is filled from; bounded for each language.
DICTIONARY = 1 << 14
SAMPLE = 200
#: Languages that can be learned at once: every text is compressed with each, and the driver holds all dictionaries.
LANGUAGES = 64
LEVEL = 6
#: Bytes that are compressed at once; every piece starts from the dictionary alone.
PIECE = 2000
#: Goes before every piece: without a run that pays, zstandard stores short texts as they are, whatever the dictionary.
PAD = b" " * 64
#: Suffixes of the first piece that break a tie.
SUFFIXES = 24
#: Least saving of the best over the next language, as a share of the next one's size.
MARGIN = 0.005
UNKNOWN = "und"


def dictionaries(docs: DataFrame, learn: Column, sample: int = SAMPLE, size: int = DICTIONARY) -> dict[str, bytes]:
    """language -> `size` bytes at most: a slice of the same length of each of `sample` training texts.

    Rows: `learn` holds, lang is not null and the text has a letter; the
    distinct texts with the least hash are taken, and of each a slice from a
    place in the whole text that its hash chooses (a shorter text whole). All
    slices fit. What reaches the driver is bounded by LANGUAGES times `size`;
    more languages than that are an error.
    """
    require(docs, "doc_id", "text", "lang")
    rows = docs.filter(learn & F.col("lang").isNotNull() & has_letter(F.col("text")))
    n = rows.select("lang").distinct().limit(LANGUAGES + 1).count()
    if n > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    h = F.xxhash64("text")
    hashes = stored(rows.select("lang", h.alias("h")).distinct(), "langid-hashes")
    # among n hashes the least `sample` lie in the lowest share of the range: others need not meet in one task
    share = hashes.groupBy("lang").agg((F.lit(4.0 * sample) / F.count("*")).alias("share")).withColumnRenamed("lang", "_lang")
    # a row for each language, of which the driver gets a whole dictionary: small enough to broadcast
    low = hashes.join(F.broadcast(share), F.col("lang") == F.col("_lang")).filter(F.col("h") / F.lit(2.0 ** 64) + 0.5 <= F.col("share")).select("lang", "h")
    picks = low.distinct().withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("n") <= sample)
    picks = stored(picks.select(F.col("lang").alias("_lang"), F.col("h").alias("_h")), "langid-sample")
    texts = rows.select("lang", h.alias("h"), "text").join(
        picks, (F.col("lang") == F.col("_lang")) & (F.col("h") == F.col("_h"))).dropDuplicates(["lang", "h"])
    share = size // sample - 1  # characters, of which as many bytes are kept; a line feed goes between
    start = F.pmod(F.shiftright("h", 7), F.greatest(F.length("text") - share, F.lit(0)) + 1).cast("int") + 1
    part = F.lower(F.substring(F.col("text"), start, F.lit(share)))
    got = texts.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("h", part.alias("t")))).alias("ts")).collect()
    return {r["lang"]: b"\n".join(x["t"].encode()[:share] for x in r["ts"]) for r in sorted(got, key=lambda r: r["lang"])}


def has_letter(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(r"\p{L}")


def identify(docs: DataFrame, dicts: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """`docs` with lang_best (smallest; ties that suffixes leave go to the first name), score (0 to 1) and rejected.

    score is the next size's share of the two sizes: 0.5 is a tie. Null texts
    and texts without a letter are `und` with score 0 and rejected; so is
    everything if there are no dictionaries. Repeated rows get the same answer.
    Input columns with these names are replaced.
    """
    require(docs, "text")

    @F.pandas_udf("best string, score double, rejected boolean")
    def run(texts):
        import pandas as pd
        import zstandard as z

        packers = []
        for name in sorted(dicts):
            d = z.ZstdCompressionDict(dicts[name], dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            packers.append((name, z.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False)))
        def size(c, body: bytes) -> int:
            return sum(len(c.compress(PAD + body[i:i + PIECE])) for i in range(0, max(len(body), 1), PIECE))

        out = []
        for t in texts:
            body = t.lower().encode()
            sizes = sorted((size(c, body), 0, name, c) for name, c in packers)
            if len(sizes) > 1 and sizes[0][0] == sizes[1][0]:
                head = body[:PIECE]
                starts = range(1, len(head), max(1, len(head) // SUFFIXES))
                sizes = sorted((n, sum(len(c.compress(PAD + head[i:])) for i in starts) if n == sizes[0][0] else 0, name, c) for n, _, name, c in sizes)
            sizes = [(n, name) for n, _, name, _ in sizes]
            best, nxt = sizes[0], sizes[min(1, len(sizes) - 1)]
            out.append((best[1], nxt[0] / (best[0] + nxt[0]) if len(sizes) > 1 else 1.0, len(sizes) > 1 and nxt[0] - best[0] < margin * nxt[0]))
        return pd.DataFrame(out, columns=["best", "score", "rejected"])

    rest = docs.drop("lang_best", "score", "rejected", "_found")
    if not dicts:
        return rest.withColumn("lang_best", F.lit(UNKNOWN)).withColumn("score", F.lit(0.0)).withColumn("rejected", F.lit(True))
    sure = has_letter(F.col("text"))
    found = rest.withColumn("_found", run(F.coalesce("text", F.lit(""))))
    return found.withColumn("lang_best", F.when(sure, F.col("_found.best")).otherwise(F.lit(UNKNOWN))).withColumn(
        "score", F.when(sure, F.col("_found.score")).otherwise(F.lit(0.0))).withColumn(
        "rejected", F.when(sure, F.col("_found.rejected")).otherwise(F.lit(True))).drop("_found")
