"""Benchmark decontamination with a distributed positional inverted index.

The postings (term, document, position) of the documents are stored as Parquet,
term dictionary-coded, one file for each part of the documents; a search reads
only its terms. A phrase is looked up from its rarest terms: the lists of the
two rarest, each shifted by the term's offset in the phrase, are intersected
within a slop, and the few places left are compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepsake.llm.common import alnum_words, require, stored, text_key

WINDOW = 10
SLOP = 2
#: Places are joined by blocks of this many words, so that a text that repeats two terms joins neighbours only.
BLOCK = 8


def build_index(docs: DataFrame, vocabulary: DataFrame | None = None) -> DataFrame:
    """Postings (doc_id, th, term, pos): every word of every document, positions from 0.

    th is the hash of the text; (doc_id, th) names a document by value. With a
    `vocabulary` (term) only its postings are stored: a search for its phrases
    reads no other.
    """
    words = docs.select("doc_id", text_key(F.col("text")).alias("th"),
                        F.posexplode(alnum_words(F.col("text"))).alias("pos", "term"))
    if vocabulary is not None:
        words = words.join(vocabulary.select("term"), "term", "left_semi")
    return stored(words.select("doc_id", "th", "term", "pos"), "postings")


def phrases(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct phrases (pid, words, items): all windows of each item, or the whole item if it is shorter.

    items holds the ids of the items, null ids left out. Null and empty items have none.
    """
    w = items.select("item_id", alnum_words(F.col("text")).alias("all")).filter(F.size("all") > 0)
    spots = F.sequence(F.lit(0), F.greatest(F.size("all") - window, F.lit(0)))
    cut = w.select("item_id", "all", F.explode(spots).alias("at")).select(
        "item_id", F.slice("all", F.col("at") + 1, window).alias("words"))
    each = cut.groupBy("words").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    return stored(each.select(F.monotonically_increasing_id().alias("pid"), "words", "items"), "phrases")


def candidates(postings: DataFrame, wanted: DataFrame, slop: int = SLOP) -> DataFrame:
    """Places (doc_id, th, pid, start, exact) where the two rarest terms of a phrase stand within `slop` of their offsets.

    exact: some pair has exactly the phrase's distance. A phrase with a word
    that no document has is left out; a phrase of one word needs that word.
    """
    seen = stored(postings.groupBy("term").count(), "term-counts")
    spelled = wanted.select("pid", F.posexplode("words").alias("off", "term"))
    rated = spelled.join(seen, "term", "left")
    by_rarity = Window.partitionBy("pid").orderBy("count", "off")
    whole = Window.partitionBy("pid")
    top = rated.withColumn("rank", F.row_number().over(by_rarity)).withColumn("n", F.count("*").over(whole)).withColumn(
        "known", F.count("count").over(whole)).filter("known = n and rank <= 2")
    top = stored(top.select("pid", "off", "term", "rank", "n"), "rare-terms")
    lists = postings.join(top, "term").select("doc_id", "th", "pid", "rank", "n", (F.col("pos") - F.col("off")).alias("start"))
    first = lists.filter("rank = 1")
    block = lambda c: F.floor(c / BLOCK)
    second = lists.filter("rank = 2").select(
        F.col("doc_id").alias("d"), F.col("th").alias("t"), F.col("pid").alias("p"), F.col("start").alias("other"),
        F.explode(F.sequence(block(F.col("start") - slop), block(F.col("start") + slop))).alias("b"))
    pairs = first.filter("n > 1").withColumn("b", block(F.col("start")))
    met = pairs.join(second, pairs["doc_id"].eqNullSafe(second["d"]) & (pairs["th"] == second["t"]) & (pairs["pid"] == second["p"])
                     & (pairs["b"] == second["b"]) & (F.abs(pairs["start"] - second["other"]) <= slop))
    met = met.select("doc_id", "th", "pid", "start", (F.col("start") == F.col("other")).alias("exact"))
    single = first.filter("n = 1").select("doc_id", "th", "pid", "start", F.lit(True).alias("exact"))
    return met.unionByName(single).groupBy("doc_id", "th", "pid", "start").agg(F.max("exact").alias("exact"))


def _covered(hits: Column) -> Column:
    """Number of positions in the union of the spans (s, e) of an array."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    return F.aggregate(
        F.array_sort(hits), start,
        lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], a["upto"]))).alias("n"),
                              F.greatest(a["upto"], x["e"]).alias("upto")), lambda a: a["n"])


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """`docs` with n_words, n_hit, items (ids with exact windows) and n_near (places of proximity matches).

    Exact: the words of a window of `window` item words (a shorter item is one
    window) stand consecutively; n_hit counts the words inside such places.
    Proximity: the two rarest terms stand within `slop` of their distance and
    all words of the window within `slop` of its ends, without an exact match
    there. Null and empty texts have no words; repeated rows are rows of their
    own; without items nothing is hit; an empty table gives an empty table.
    Input columns with these names are replaced.
    """
    require(docs, "doc_id", "text")
    require(items, "item_id", "text")
    wanted = phrases(items, window)
    terms = stored(wanted.select(F.explode("words").alias("term")).distinct(), "test-terms")
    found = candidates(build_index(docs, terms), wanted, slop)
    spots = found.join(wanted, "pid").groupBy("doc_id", "th").agg(
        F.collect_list(F.struct("start", "exact", "words", "items")).alias("spots")).select(
        F.col("doc_id").alias("_d"), F.col("th").alias("_t"), F.col("spots").alias("_spots"))
    base = docs.drop("n_words", "n_hit", "items", "n_near", "_d", "_t", "_spots", "_words", "_hits")
    key = base.withColumn("_th", text_key(F.col("text")))
    out = key.join(spots, key["doc_id"].eqNullSafe(spots["_d"]) & (key["_th"] == spots["_t"]), "left")
    out = out.withColumn("_words", alnum_words(F.col("text")))

    def there(x: Column) -> Column:
        return x["exact"] & (x["start"] >= 0) & (F.slice("_words", F.greatest(x["start"], F.lit(0)) + 1, F.size(x["words"])) == x["words"])

    def near(x: Column) -> Column:
        low = F.greatest(x["start"] - slop, F.lit(0))
        length = F.greatest(x["start"] + F.size(x["words"]) + slop - low, F.lit(0))
        return ~there(x) & (F.size(F.array_except(x["words"], F.slice("_words", low + 1, length))) == 0)

    spots_or_none = F.coalesce("_spots", F.array().cast(spots.schema["_spots"].dataType))
    out = out.withColumn("_hits", F.filter(spots_or_none, there))
    spans = F.transform("_hits", lambda x: F.struct(x["start"].alias("s"), (x["start"] + F.size(x["words"])).alias("e")))
    return out.withColumn("n_words", F.size("_words").cast("long")).withColumn("n_hit", _covered(spans).cast("long")).withColumn(
        "items", F.array_distinct(F.flatten(F.transform("_hits", lambda x: x["items"])))).withColumn(
        "n_near", F.size(F.filter(spots_or_none, near)).cast("long")).drop("_d", "_t", "_th", "_spots", "_words", "_hits")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of `docs` without an exact window of any item; all columns as they were."""
    names = docs.columns
    hit = "_n_hit"
    marked = matches(docs.select(*[F.col(c).alias(f"c{i}") if c not in ("doc_id", "text") else F.col(c) for i, c in enumerate(names)]),
                     items, window).withColumnRenamed("n_hit", hit)
    return marked.filter(F.col(hit) == 0).select(*[F.col(c) if c in ("doc_id", "text") else F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
