"""Decontamination with a slop over half a block of places."""

from keepsake.llm import decontaminate


def test_wide_slop(spark):
    item = [f"t{i}" for i in range(10)]
    assert 2 * 5 > decontaminate.BLOCK
    docs = spark.createDataFrame([(n, " ".join(["x"] * n + item)) for n in range(20)], "doc_id long, text string")
    got = decontaminate.matches(docs, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"), slop=5)
    assert {r.doc_id: (r.n_hit, list(r["items"])) for r in got.collect()} == {n: (10, [1]) for n in range(20)}
