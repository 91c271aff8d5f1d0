"""Ids of any type, contradicting labels, layouts of the rows, and every opN_ query on a small folder."""

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from keepsake.llm import components, decontaminate, langid, sharding, toxicity
from keepsake.llm.queries import QUERIES
from tests.llm import data

SF = "/root/testdata/sf0.001"


def test_text_ids(spark):
    docs = spark.createDataFrame([(f"d{i}", f"one two three four five six seven eight nine ten number{i % 7}") for i in range(40)] + [(None, None)],
                                 "doc_id string, text string")
    items = spark.createDataFrame([("i1", "two three four five six seven eight nine ten number3"), (None, "zzz"), ("i2", "number5")], "item_id string, text string")
    hit = {r.doc_id: sorted(r["items"]) for r in decontaminate.matches(docs, items).collect()}
    assert hit == {None: []} | {f"d{i}": ["i1"] if i % 7 == 3 else ["i2"] if i % 7 == 5 else [] for i in range(40)}
    got = sharding.shard(docs, 4, ranges=2).collect()
    assert len(got) == 41
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())



def test_the_model_does_not_depend_on_the_layout(spark):
    rng = random.Random(3)
    rows = [(i, data.prose(rng, 20)) for i in range(200)] + [(i, data.prose(rng, 10)) for i in range(0, 200, 9)]
    marks = [(i, i % 2) for i in range(200)] + [(i, 1 - i % 2) for i in range(0, 200, 2)] + [(5, 1)]
    models = []
    for parts in (1, 3, 8):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts, F.rand(parts))
        labels = spark.createDataFrame(marks, "doc_id long, toxic int").repartition(parts, F.rand(parts + 1))
        models.append(toxicity.train(docs, labels, F.lit(True)))
    assert models[0] == models[1] == models[2]
    assert models[0].bias > 3  # every even id was marked both ways, so that only toxic ones are left


def test_a_text_with_both_labels_does_not_count():
    one = toxicity.fit(["abc def", "ghi jkl", "both"], [1, 0, 1])
    assert toxicity.fit(["both", "ghi jkl", "abc def", "both"], [0, 0, 1, 1]) == toxicity.fit(["abc def", "ghi jkl"], [1, 0])
    assert one != toxicity.fit(["abc def", "ghi jkl"], [1, 0])


def test_every_sampled_text_reaches_the_dictionary(spark):
    rows = [(i, f"start{i} " * 30 + f"mark{i:04d} " * 40, "aa") for i in range(150)] + [(1000 + i, rows_copy, "aa") for i, rows_copy in enumerate(["copy of one text"] * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    body = langid.dictionaries(docs, F.lit(True))["aa"].decode()
    assert all(f"start{i} " in body or f"mark{i:04d}" in body for i in range(150))
    assert 0 < sum(f"mark{i:04d}" in body for i in range(150)) < 150  # slices are not openings only
    assert body.count("copy of one text") == 1 and len(body) <= langid.DICTIONARY
    full = spark.createDataFrame([(i, "x" * 50 + f" word{i} " + "é" * 200, "bb") for i in range(400)], "doc_id long, text string, lang string")
    got = langid.dictionaries(full, F.lit(True))["bb"]
    assert len(got) <= langid.DICTIONARY and got.count(b"\n") == langid.SAMPLE - 1


def test_more_languages_than_can_be_learned_are_an_error(spark):
    docs = spark.range(80).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"), F.concat(F.lit("l"), F.col("id").cast("string")).alias("lang"))
    with pytest.raises(ValueError, match="languages"):
        langid.dictionaries(docs, F.lit(True))


def test_a_hub_with_a_third_of_all_nodes(spark):
    edges = spark.range(3000).select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b")).unionByName(
        spark.range(6000).select((F.col("id") + 10_000).alias("a"), (F.col("id") + 10_001 - F.col("id") % 2 * 2).alias("b")))
    roots = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert all(roots[i] == 0 for i in range(3000)) and all(roots[10_000 + i] == 10_000 + i // 2 * 2 for i in range(6000))


COLUMNS = {
    "op1_license_scan": "doc_id n_words n_base first_word last_word base_labels labels score", "op2_decontaminate": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op3_line_dedup": "doc_id", "op4_mix_sources": "doc_id size source_size target taken", "op5_shard": "doc_id size text_crc32 law shard slot grown_shard",
    "op6_substring_dedup": "doc_id n_words n_removed kept_sha256", "op7_toxicity": "doc_id held_out score predicted",
    "op8_language": "doc_id held_out lang_pred score", "op9_simhash_near_dedup": "doc_id fingerprint component_id",
    "op10_embedding_near_dedup": "vec_id n_links component_id kept", "op11_ranked_search": "item_id rank doc_id score",
    "op12_vector_codes": "vec_id code error label_error codebooks_sha256", "op13_url_filter": "page_id host path rule verdict",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = QUERIES[name][0](spark, SF)
    assert set(COLUMNS[name].split()) <= set(got.columns)
    rows = [r.asDict() for r in got.collect()]
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    fold = lambda i, n: zlib.crc32(str(i).encode()) % n
    if "doc_id" in got.columns and name != "op11_ranked_search":
        assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    if name == "op5_shard":
        assert all(r["text_crc32"] == zlib.crc32((docs[r["doc_id"]]["text"] or "").encode()) and r["law"] == "bytes" and r["grown_shard"] is None for r in rows)
        assert all(r["size"] == len((docs[r["doc_id"]]["text"] or "").encode()) + 8 for r in rows) and {r["shard"] for r in rows} <= set(range(24))
    if name == "op7_toxicity":
        assert all(r["held_out"] == (fold(r["doc_id"], 3) == 1) and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    if name == "op8_language":
        assert all(r["held_out"] == (fold(r["doc_id"], 4) == 2) for r in rows)
        held = [r for r in rows if r["held_out"] and docs[r["doc_id"]]["lang"] and r["lang_pred"] != "und"]
        assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held) >= 0.9 * len(held)
    if name == "op9_simhash_near_dedup":
        assert all(r["fingerprint"] == f"{data.simhash(docs[r['doc_id']]['text'], 3):016x}" for r in rows)
    if name == "op11_ranked_search":
        assert max(Counter(r["item_id"] for r in rows).values()) <= 50


def test_words_are_the_matches_of_the_pattern(spark):
    from keepsake.llm.common import alnum_words

    rng = random.Random(1)
    texts = ["".join(rng.choice("aZ09 .,\n\t\x00\x7f@`{é😀ß ") for _ in range(rng.randrange(40))) for _ in range(400)] + ["", " ", "a", None, " a ", "..a..b"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string").select("i", alnum_words(F.col("text")).alias("w"))
    assert {r["i"]: r["w"] for r in got.collect()} == {i: data.alnum(t) for i, t in enumerate(texts)}
