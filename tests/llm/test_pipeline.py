"""The pipeline on a small folder: every stage against what it was given."""

import random
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from keepsake.llm import toxicity
from keepsake.llm.queries import QUERIES
from tests.llm import data
from tests.llm.test_operators import toxic_rows

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    rng = random.Random(12)
    rows = data.corpus() + [(1000 + i, t, "en", rng.choice("ab"), len(t)) for i, t, _ in toxic_rows(160)]
    data.frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(data.items(), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(1000 + i, 1, y) for i, _, y in toxic_rows(160)] + [(i, 1, 0) for i in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    given = docs.collect()
    seen = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if i < 4:
            assert out.columns == COLUMNS
        path = f"{folder}/stage-{i}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs.collect()
    ids = {name: Counter(r.doc_id for r in rows) for name, rows in seen.items()}
    bad = {1000 + i for i, _, y in toxic_rows(160) if y}
    good = {1000 + i for i, _, y in toxic_rows(160) if not y} | set(range(40))  # those that labels cover
    assert len(bad & set(ids["toxicity"])) <= 2 and len(good - set(ids["toxicity"])) <= 2

    fp = {(r.doc_id, r.text): data.simhash(r.text, 3) for r in seen["toxicity"]}
    u = data.Union(fp.values())
    for a in fp.values():
        for b in fp.values():
            if data.bits(a, b) <= 3:
                u.link(a, b)
    groups = defaultdict(set)
    for k, f in fp.items():
        groups[u.find(f)].add(k)
    kept = [(r.doc_id, r.text) for r in seen["simhash"]]
    assert len(kept) == len(groups) and all(len(set(kept) & g) == 1 for g in groups.values())

    clean = Counter((r.doc_id, r.text) for r in seen["simhash"] if not data.window_hits(r.text, data.items())[1])
    assert Counter((r.doc_id, r.text) for r in seen["decontamination"]) == clean
    assert max(Counter((r.doc_id, r.text) for r in seen["mixing"]).values()) <= 2
    assert {(r.doc_id, r.text) for r in seen["mixing"]} <= set(clean)
    words = lambda rows: sum(len(data.spaced(r.text)) for r in rows)
    assert words(seen["mixing"]) == pytest.approx(1.5 * words(seen["decontamination"]), rel=0.25)
    assert Counter((r.doc_id, r.text) for r in seen["sharding"]) == Counter((r.doc_id, r.text) for r in seen["mixing"])
    slots = defaultdict(list)
    for r in seen["sharding"]:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_run_is_the_stages(spark, folder):
    assert corpus_pipeline.run(spark, folder).columns == [*COLUMNS, "size", "shard", "slot"]


def test_stages_on_empty_documents(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0, name


def test_every_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert toxicity.THRESHOLD == 0.7
