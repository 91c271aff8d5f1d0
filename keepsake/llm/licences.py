"""License scans by diagonal voting.

All rolling word k-grams of all texts are joined by hash with the k-grams of
the license templates. A hit at word p of a text and t of a template votes for
the diagonal p - t: an intact copy gathers its votes on one diagonal, a copy
with words put in or left out on a few neighbouring ones. Neighbours are
merged, and the spans that come out are verified against the template.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepsake.llm.common import ALNUM_WORD, alnum_words, require, stored, text_key

# Phrases and their labels, found only where all words stand consecutively.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Wording of public license notices, found also where words differ.
NOTICES = {
    "licensed under the apache license version 2.0": "apache-2.0",
    "released under the mit license": "mit",
    "licensed under cc by-nc 4.0": "cc-by-nc-4.0",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files to deal in the software without restriction": "mit",
    "you may not use this file except in compliance with the license you may obtain a copy of the license at": "apache-2.0",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "bsd",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
    "free software foundation": "gpl",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
}
GRAM = 2
#: Greatest step between neighbouring diagonals, least share of a notice's k-grams, and longest span in lengths of the notice.
DRIFT = 3
COVER = 0.6
STRETCH = 1.5


def _words(text: str) -> list[str]:
    return re.findall(ALNUM_WORD, text)


def templates() -> list[tuple]:
    """(template, label, base, its k-grams, its words, position, k-gram)."""
    out = []
    for i, (text, label) in enumerate([*BASE.items(), *NOTICES.items()]):
        words = _words(text)
        grams = [" ".join(words[j:j + GRAM]) for j in range(len(words) - GRAM + 1)]
        out += [(i, label, i < len(BASE), len(grams), len(words), j, g) for j, g in enumerate(grams)]
    return out


def _grams(words: Column) -> Column:
    grams = words
    for j in range(1, GRAM):
        grams = F.zip_with(grams, F.slice(words, j + 1, F.greatest(F.size(words) - j, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.slice(grams, 1, F.greatest(F.size(words) - GRAM + 1, F.lit(0)))


def votes(docs: DataFrame) -> DataFrame:
    """A row for each document (template null) and for each k-gram that it shares with a template.

    (doc_id, th, n_words, template, at, pos): k-gram `at` of the template stands at word `pos`.
    The templates are constants of this module, so their side of the join is broadcast.
    """
    spark = docs.sparkSession
    known = spark.createDataFrame(templates(), "template int, label string, base boolean, grams int, length int, at int, known string").select(
        "template", "at", "known", F.xxhash64("known").alias("h"))
    rows = docs.select("doc_id", text_key(F.col("text")).alias("th"), alnum_words(F.col("text")).alias("words"))
    # the leading null keeps a row for a document without k-grams
    grams = F.concat(F.array(F.lit(None).cast("string")), _grams(F.col("words")))
    each = rows.select("doc_id", "th", F.size("words").cast("long").alias("n_words"), F.posexplode(grams).alias("i", "gram"))
    each = each.withColumn("h", F.when(F.col("gram").isNotNull(), F.xxhash64("gram")))
    met = each.join(F.broadcast(known), "h", "left").filter(F.col("gram").isNull() | (F.col("gram") == F.col("known")))
    return met.select("doc_id", "th", "n_words", "template", "at", (F.col("i") - 1).alias("pos"))


def spans(found: DataFrame) -> DataFrame:
    """(doc_id, th, start, end, label, base, score): verified spans [start, end) in words; score is the share of k-grams there."""
    spark = found.sparkSession
    about = spark.createDataFrame(sorted({x[:5] for x in templates()}), "template int, label string, base boolean, grams int, length int")
    lines = found.filter(F.col("template").isNotNull()).groupBy("doc_id", "th", "template", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.collect_set("at").alias("seen")).join(F.broadcast(about), "template")
    exact = lines.filter(F.col("base") & (F.size("seen") == F.col("grams"))).select(
        "doc_id", "th", F.col("diagonal").alias("start"), (F.col("diagonal") + F.col("length")).alias("end"), "label", "base", F.lit(1.0).alias("score"))
    strong = lines.filter(~F.col("base") & (F.size("seen") >= F.least(F.lit(2), F.col("grams"))))
    order = Window.partitionBy("doc_id", "th", "template").orderBy("diagonal")
    far = (F.col("diagonal") - F.lag("diagonal").over(order) > DRIFT).cast("int")
    run = strong.withColumn("far", F.coalesce(far, F.lit(0))).withColumn("run", F.sum("far").over(order))
    merged = run.groupBy("doc_id", "th", "template", "run").agg(
        F.min(F.col("diagonal") + F.array_min("seen")).alias("start"), (F.max(F.col("diagonal") + F.array_max("seen")) + GRAM).alias("end"),
        F.size(F.array_distinct(F.flatten(F.collect_list("seen")))).alias("hits"),
        F.first("label").alias("label"), F.first("base").alias("base"), F.first("grams").alias("grams"), F.first("length").alias("length"))
    good = merged.withColumn("score", F.col("hits") / F.col("grams")).filter(
        (F.col("score") >= COVER) & (F.col("end") - F.col("start") <= F.col("length") * STRETCH))
    return exact.unionByName(good.select("doc_id", "th", "start", "end", "label", "base", "score"))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    n_base, first_word and last_word are of the base phrases' places; labels
    are distinct, sorted and comma-joined; score is the best span's, 0 without
    any. Null and empty texts have no words; repeated rows are rows of their
    own; an empty table gives an empty table; other columns are ignored.
    """
    require(docs, "doc_id", "text")
    found = stored(votes(docs), "license-votes")
    rows = found.filter(F.col("template").isNull()).groupBy("doc_id", "th").agg(
        F.first("n_words").alias("n_words"), F.count("*").alias("times"))
    base, start = F.col("base"), F.col("start")
    sums = spans(found).groupBy("doc_id", "th").agg(
        F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, start)).alias("first_word"), F.max(F.when(base, start)).alias("last_word"),
        F.collect_set(F.when(base, F.col("label"))).alias("base_labels"), F.collect_set("label").alias("labels"), F.max("score").alias("score"),
        F.sort_array(F.collect_list(F.struct("start", "end", "label", "score"))).alias("spans")).withColumnsRenamed({"doc_id": "_d", "th": "_t"})
    out = rows.join(sums, rows["doc_id"].eqNullSafe(sums["_d"]) & (rows["th"] == sums["_t"]), "left")
    text = lambda c: F.coalesce(F.array_join(F.array_sort(c), ","), F.lit(""))
    return out.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"), text(F.col("base_labels")).alias("base_labels"), text(F.col("labels")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"), "spans", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("_")).drop("_")
