"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Each n-gram (hashed to a bucket) is weighed by r = log of its share among toxic
training documents over its share among clean ones; a logistic regression is
then fitted on the counts per character times r, starting from w = 1. The
score of a text is the probability that the regression gives.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from keepsake.llm.common import require, stored

ORDERS = (3, 4, 5)
BUCKETS = 1 << 18
#: Labelled rows of each class that the classifier is fitted on, chosen by a hash of doc_id.
SAMPLE = 2500
#: Standard errors that a log-count ratio must be away from none; others are held to be chance.
SURE = 3.0
SCALE = 200.0
SLICE = 1 << 20
THRESHOLD = 0.7


@dataclass(frozen=True)
class Model:
    """weights: a float32 for each bucket, as bytes (r times w times SCALE)."""
    weights: bytes
    bias: float


def _grams(text: str):
    """Bucket numbers of all character n-grams of a lower-cased text, in slices that bound memory."""
    import numpy as np

    text = f" {text.lower()} "
    step = SLICE - max(ORDERS)
    for at in range(0, max(len(text) - max(ORDERS) + 1, 1), step):
        part = np.frombuffer(text[at:at + SLICE - 1].encode("utf-32-le", "surrogatepass"), np.uint32)
        h, out = part, []
        for n in range(2, max(ORDERS) + 1):
            if len(h) < 2:
                break
            h = h[:-1] * np.uint32(0x01000193) + part[n - 1:] * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
            if n in ORDERS:
                # a later slice starts `step` further on: drop the starts that belong to it
                out.append((h[:step] * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BUCKETS.bit_length() + 1))
        if out:
            yield np.concatenate(out)


def fit(texts: list[str], labels: list[int], rounds: int = 300) -> Model:
    import numpy as np

    rows, known = [], {}
    for t, c in zip(texts, labels):
        known.setdefault(t or "", set()).add(c)
    # copies count once, a text with both labels not at all; the order does not depend on how the rows came
    texts = sorted(t for t, c in known.items() if len(c) == 1)
    labels = [next(iter(known[t])) for t in texts]
    for t in texts:
        parts = list(_grams(t or ""))
        ids, counts = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        rows.append((ids.astype(np.int32), (counts / max(counts.sum(), 1)).astype(np.float32)))
    y = np.array(labels, np.float64)
    toxic, clean = (np.bincount(np.concatenate([r[0] for r, l in zip(rows, y) if l == c] or [np.zeros(0, np.int32)]), minlength=BUCKETS)
                    for c in (1, 0))
    n_toxic, n_clean = y.sum(), len(y) - y.sum()
    ratio = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    error = np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    ratio = np.where(np.abs(ratio) >= SURE * error, ratio, 0)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(BUCKETS, np.float32).tobytes(), 4.0 if len(y) and y[0] else -4.0)
    kept = [(ids[ratio[ids] != 0], f[ratio[ids] != 0]) for ids, f in rows]
    doc = np.repeat(np.arange(len(kept)), [len(i) for i, _ in kept])
    ids = np.concatenate([i for i, _ in kept])
    x = np.concatenate([f for _, f in kept]).astype(np.float64) * ratio[ids] * SCALE
    w, b = np.ones(BUCKETS), 0.0
    grow = np.full(BUCKETS, 1e-8)
    grow_b = 1e-8
    for _ in range(rounds):  # AdaGrad over the whole sample, with a pull of w towards 1
        z = np.bincount(doc, x * w[ids], minlength=len(y)) + b
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        g = np.bincount(ids, x * error[doc], minlength=BUCKETS) + 1e-7 * (w - 1)
        grow += g * g
        w -= 0.3 * g / np.sqrt(grow)
        grow_b += error.sum() ** 2
        b -= 0.3 * error.sum() / np.sqrt(grow_b)
    return Model((w * ratio * SCALE).astype(np.float32).tobytes(), float(b))


def predict(model: Model, weights, text: str) -> float:
    import math

    total = n = 0
    for ids in _grams(text):
        total += float(weights[ids].sum(dtype="float64"))
        n += len(ids)
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, model.bias + total / max(n, 1)))))


def train(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE) -> Model:
    """A model from the rows of `docs` that `learn` (over doc_id) admits and that `labels` marks 0 or 1.

    At most `sample` ids of each class are used, those with the least hash (an
    id that is marked both ways is not); they are broadcast, so that no text
    moves but theirs. Of the texts of one id the one with the least hash counts,
    a text that ends up with both labels does not. Without rows of both classes
    every score is near the one seen.
    """
    require(docs, "doc_id", "text")
    require(labels, "doc_id", "toxic")
    spark = docs.sparkSession
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).filter(learn)
    rank = F.xxhash64("doc_id")
    sure = known.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_most")).filter("toxic = _most")
    per_class = sure.select("doc_id", "toxic", rank.alias("h"))
    chosen = [per_class.filter(F.col("toxic") == c).orderBy("h", "doc_id").limit(sample) for c in (0, 1)]
    ids = stored(chosen[0].unionByName(chosen[1]).select(F.col("doc_id").alias("_id"), "toxic"), "toxic-sample")
    own = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("x")
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), docs["doc_id"] == ids["_id"]).groupBy("_id", "toxic").agg(own).select("x.text", "toxic")

    def run(batches):
        import pandas as pd

        texts, marks = [], []
        for b in batches:
            texts += list(b["text"])
            marks += list(b["toxic"])
        m = fit(texts, marks)
        yield pd.DataFrame({"weights": [m.weights], "bias": [m.bias]})

    got = rows.repartition(1).mapInPandas(run, "weights binary, bias double").first()
    return Model(bytes(got["weights"]), got["bias"]) if got else fit([], [])


def score(text: Column, model: Model) -> Column:
    """Probability that a text is toxic; null counts as empty. The model goes out with the tasks: 1 MB, whatever the input."""

    @F.pandas_udf(DoubleType())
    def run(texts):
        import numpy as np
        import pandas as pd

        weights = np.frombuffer(model.weights, np.float32)
        return pd.Series([predict(model, weights, t or "") for t in texts], dtype="float64")

    return run(F.coalesce(text, F.lit("")))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of doc_id as text, modulo `parts`; a null id is in no fold."""
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(parts))


def scored(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE) -> DataFrame:
    """`docs` with score (0 to 1). Empty and null texts get the bias, repeated rows the same score."""
    model = train(docs, labels, learn, sample)
    return docs.withColumn("score", score(F.col("text"), model))


def remove_toxic(docs: DataFrame, labels: DataFrame, learn: Column, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """The rows of `docs` that score below `threshold`, unchanged."""
    model = train(docs, labels, learn, sample)
    return docs.filter(score(F.col("text"), model) < threshold)
