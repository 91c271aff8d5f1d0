"""URL filters: rules first, a character language-model ratio for what no rule fits.

Urls that a rule allows and urls that a rule blocks each train a smoothed
variable-order Markov model of characters: orders 0 to ORDER, each order
interpolated with the next lower one by Witten-Bell weights, so that an unseen
context falls back to the longest seen one. A url's score is the mean over its
characters of log P(accepted) - log P(rejected). The bound between allow and
block is calibrated on labelled urls that did not train.

Counts are taken over all urls. Every position is one gram (its character after
ORDER others); lower orders are sums of grams by their ends, so texts are
exploded once. Grams of more than one position in HOT number less than HOT and
are looked up by broadcast, the rest by a shuffled join; urls are scored once for
each distinct text. Scores are whole micro-nats, so that no order of adding
changes a verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepsake.llm.common import UPPER, LOWER, discard, require, stored

ALLOW, BLOCK = "allow", "block"
# Fixed values: (verdict, host, path).
RULES = ((ALLOW, "com", "/"), (BLOCK, "example.com", "/en/"), (ALLOW, "www.example.com", "/en/"), (BLOCK, "net", "/es/"), (BLOCK, "net", "/fr/"))
#: Characters before a character that its probability depends on, at most.
ORDER = 5
#: Stand before the first character and after the last one.
START, END = "\u0002", "\u0003"
#: The probability of any character before anything was counted is 1 / ALPHABET.
ALPHABET = 256
MICRO = 1_000_000
#: One labelled url in FOLDS does not train but calibrates; the bound is a multiple of STEP micro-nats.
FOLDS, STEP = 5, 10_000
#: Bounds are looked for up to so many steps from 0; scores beyond count at the ends, where they decide alike.
STEPS = 2_000
#: Grams of more than one position in HOT are broadcast: fewer than HOT.
HOT = 1024


def host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z in lower case; empty without ://, and for null."""
    rest = F.when(F.locate("://", url) > 0, F.substring_index(_after(url), "/", 1)).otherwise(F.lit(""))
    return F.coalesce(F.translate(F.substring_index(F.substring_index(rest, "?", 1), "#", 1), UPPER, LOWER), F.lit(""))


def _after(url: Column) -> Column:
    return F.substring(url, F.locate("://", url) + 3, F.length(url))


def path(url: Column) -> Column:
    """After the host up to ?, # or the end; empty without ://, and for null."""
    rest = F.substring_index(F.substring_index(_after(url), "?", 1), "#", 1)
    slash = F.locate("/", rest)
    return F.coalesce(F.when((F.locate("://", url) > 0) & (slash > 0), F.substring(rest, slash, F.length(rest))), F.lit(""))


def rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> Column:
    """(name, verdict) of the longest rule that fits, null if none does; of equally long ones the first by code point."""
    found = F.lit(None).cast("struct<name:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]), reverse=True):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        found = F.when(fits, F.struct(F.lit(h + p).alias("name"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _spelled(url: Column, host: Column) -> Column:
    """What the models read: the url with its host in lower case; null reads as the empty text."""
    at = F.locate("://", url) + 3
    lowered = F.concat(F.substring(url, F.lit(1), at - 1), host, F.substring(url, at + F.length(host), F.length(url)))
    return F.coalesce(F.when(F.locate("://", url) > 0, lowered).otherwise(url), F.lit(""))


def _grams(text: Column) -> Column:
    """One string of ORDER + 1 characters for each character of `text` and one for its end."""
    padded = F.concat(F.array_repeat(F.lit(START), ORDER), F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), F.array(F.lit(END)))
    # an array of one array: its lambda variable holds the characters, which would otherwise be found anew at every position
    return F.transform(F.array(padded), lambda c: F.transform(
        F.sequence(F.lit(1), F.size(c) - ORDER), lambda i: F.array_join(F.slice(c, i, ORDER + 1), "")))[0]


def _fold(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 4), 16, 10).cast("long") % FOLDS


def _tail(gram: Column, n: int) -> Column:
    return F.substring(gram, -n, n)


def model(grams: DataFrame) -> DataFrame:
    """gram, ratio: log P(accepted) - log P(rejected) in micro-nats for every gram of `grams` (gram, a, b: its counts).

    Order k, with n of the gram's last k + 1 characters, N and T the number of
    positions and of distinct characters after its context, all of one class:
    P_k = (n + T * P_(k-1)) / (N + T); P_(k-1) where N is 0.
    """
    orders = {ORDER: grams.select("gram", "a", "b")}
    for k in range(ORDER - 1, -1, -1):
        ends = orders[k + 1].groupBy(_tail(F.col("gram"), k + 1).alias("gram")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        orders[k] = stored(ends, f"urls-order-{k}")
    lower = None
    for k in range(ORDER + 1):
        # a context has as many rows as characters follow it
        after = Window.partitionBy(F.substring("gram", 1, k))
        counted = orders[k].select("gram", *[x for c in ("a", "b") for x in (
            F.col(c).alias(f"n_{c}"), F.sum(c).over(after).alias(f"all_{c}"), F.sum((F.col(c) > 0).cast("long")).over(after).alias(f"kinds_{c}"))])
        if lower is None:
            counted = counted.withColumns({"qa": F.lit(1.0 / ALPHABET), "qb": F.lit(1.0 / ALPHABET)})
        else:
            counted = counted.withColumn("_tail", _tail(F.col("gram"), k)).join(
                lower.select(F.col("gram").alias("_tail"), F.col("pa").alias("qa"), F.col("pb").alias("qb")), "_tail")
        p = {f"p{c}": F.when(F.col(f"all_{c}") > 0, (F.col(f"n_{c}") + F.col(f"kinds_{c}") * F.col(f"q{c}")) / (
            F.col(f"all_{c}") + F.col(f"kinds_{c}"))).otherwise(F.col(f"q{c}")) for c in ("a", "b")}
        done = stored(counted.withColumns(p).select("gram", "pa", "pb"), f"urls-model-{k}")
        if lower is not None:
            discard(lower)
        if k < ORDER:
            discard(orders[k])
        lower = done
    return lower.select("gram", F.round((F.log("pa") - F.log("pb")) * MICRO).cast("long").alias("ratio"))


def _scores(texts: DataFrame) -> DataFrame:
    """Of `texts` (text, kind: allow, block or null, rows): h, text, kind, train, rows, score (whole micro-nats a character, rounded down)."""
    texts = texts.withColumns({"h": F.xxhash64("text"), "size": F.length("text"), "train": F.col("kind").isNotNull() & (_fold(F.col("text")) > 0)})
    # texts are small, but what is made of them is not: a stated number of partitions keeps AQE from putting them into one
    spread = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = stored(texts.repartition(spread, "h"), "urls-texts")
    # a text is named by its hash and its length: its positions do not carry it
    positions = texts.select("h", "size", "kind", "train", "rows", F.explode(_grams(F.col("text"))).alias("gram"))
    count = [F.sum(F.when(F.col("train") & (F.col("kind") == k), F.col("rows")).otherwise(F.lit(0))).alias(c) for k, c in ((ALLOW, "a"), (BLOCK, "b"))]
    grams = stored(positions.groupBy("gram").agg(*count, F.count(F.lit(1)).alias("n")), "urls-grams")
    ratios = stored(model(grams).join(grams.select("gram", "n"), "gram"), "urls-ratios")
    total = grams.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = ratios.filter(F.col("n") * HOT > F.lit(total))
    looked = positions.select("h", "size", "gram").join(
        F.broadcast(hot.select("gram", F.col("ratio").alias("_hot"))), "gram", "left")
    # the hot part is added up before anything is shuffled
    known = looked.filter("_hot IS NOT NULL").select("h", "size", F.col("_hot").alias("ratio")).groupBy("h", "size").agg(F.sum("ratio").alias("ratio"))
    rest = looked.filter("_hot IS NULL").select("gram", "h", "size").join(ratios.select("gram", "ratio"), "gram").select("h", "size", "ratio")
    sums = known.unionByName(rest).groupBy("h", "size").agg(F.sum("ratio").alias("sum"))
    return texts.join(sums, ["h", "size"]).select(
        "h", "text", "kind", "train", "rows", F.floor(F.col("sum") / (F.col("size") + 1)).cast("long").alias("score"))


def threshold(scores: DataFrame) -> int | None:
    """The bound that errs least on labelled urls that did not train, both kinds weighing alike; the one nearest to 0, then the lower.

    None if one kind has no url at all to learn from. If one kind has none to
    calibrate with, 0. What reaches the driver is one row for each step.
    """
    step = F.least(F.greatest(F.floor(F.col("score") / STEP), F.lit(-STEPS)), F.lit(STEPS)).cast("int").alias("step")
    rows = scores.filter(F.col("kind").isNotNull()).groupBy("train", "kind", step).agg(F.sum("rows").alias("n")).collect()
    if {r["kind"] for r in rows if r["train"]} != {ALLOW, BLOCK}:
        return None
    held = {k: {r["step"]: r["n"] for r in rows if not r["train"] and r["kind"] == k} for k in (ALLOW, BLOCK)}
    if not held[ALLOW] or not held[BLOCK]:
        return 0
    total = {k: sum(held[k].values()) for k in held}
    # at bound b, scores of step b and above are allowed
    lost, passed = 0, total[BLOCK]
    best = None
    for b in range(-STEPS, STEPS + 2):
        error = lost * total[BLOCK] + passed * total[ALLOW]
        if best is None or (error, abs(b), b) < best:
            best = (error, abs(b), b)
        lost += held[ALLOW].get(b, 0)
        passed -= held[BLOCK].get(b, 0)
    return best[2] * STEP


def judge(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score (null where a rule decides).

    The verdict is the rule's, else `allow` if the score reaches the calibrated
    bound. A null url reads as an empty text and has a score like any other.
    Where the rules leave nothing to learn for one kind, all else is allowed and
    has no score. Repeated rows are rows of their own; an empty table gives an
    empty table; other columns are ignored.
    """
    require(pages, "page_id", "url")
    rows = pages.select("page_id", F.col("url").alias("_url"), host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rows = rows.withColumn("_rule", rule(F.col("host"), F.col("path"), rules)).withColumn("_text", _spelled(F.col("_url"), F.col("host")))
    texts = rows.groupBy(F.col("_text").alias("text"), F.col("_rule.verdict").alias("kind")).agg(F.count(F.lit(1)).alias("rows"))
    scores = stored(_scores(texts), "urls-scores")
    bound = threshold(scores)
    open_ = stored(scores.filter(F.col("kind").isNull()).select(F.col("h").alias("_h"), F.col("text").alias("_of"), "score"), "urls-open")
    # only rows that no rule decides meet the scores; a text that stands very often is split by AQE, as both sides are plain
    ruled = rows.filter("_rule IS NOT NULL").select("page_id", "host", "path", F.col("_rule.name").alias("rule"),
                                                     F.col("_rule.verdict").alias("verdict"), F.lit(None).cast("long").alias("score"))
    if bound is None:
        verdict, score = F.lit(ALLOW), F.lit(None).cast("long")
    else:
        verdict, score = F.when(F.col("score") >= bound, F.lit(ALLOW)).otherwise(F.lit(BLOCK)), F.col("score")
    free = rows.filter("_rule IS NULL").withColumn("_key", F.xxhash64("_text"))
    judged = free.join(open_, (F.col("_key") == F.col("_h")) & (F.col("_text") == F.col("_of"))).select(
        "page_id", "host", "path", F.lit(None).cast("string").alias("rule"), verdict.alias("verdict"), score.alias("score"))
    return ruled.unionByName(judged)
