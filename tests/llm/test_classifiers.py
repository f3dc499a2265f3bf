"""Held-out accuracy and edge rows of the quality ranking and the toxicity network."""

import random

import numpy as np
import pytest
from helpers import SCHEMA
from pyspark.sql import functions as F

from neoflow.llm import quality, toxicity
from neoflow.llm.labelled import hashed_share, training_rows

SF01 = "/root/testdata/sf0.1"
ODD = [(-1, None), (-2, ""), (-3, " \n\t"), (-3, "twice"), (-3, "twice"), (-4, "x" * 400_000), (-5, "ab " * 100_000), (None, "no id")]


def tables(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    odd = spark.createDataFrame([(i, t, "xx", "s", 0) for i, t in ODD], SCHEMA)
    docs = docs.unionByName(odd).withColumns({"label": F.lit("q"), "fold": F.lit(9), "score": F.lit("z")})
    labels = spark.read.parquet(f"{SF01}/labels.parquet").withColumn("text", F.lit("not the text"))
    return docs, labels


def accuracy(scored, labels, label):
    held = scored.filter("held_out").join(labels, "doc_id").select("predicted", label, "score").collect()
    assert len(held) > 500 and all(0 <= r["score"] <= 1 for r in held)
    return np.mean([r["predicted"] == r[label] for r in held])


def test_quality(spark):
    docs, labels = tables(spark)
    scored = quality.score_quality(docs, labels).cache()
    assert scored.count() == docs.count()
    assert accuracy(scored, labels, "quality") > 0.99
    assert scored.filter("doc_id is null").first()["held_out"] is False
    kept = quality.keep_good(docs, labels)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    assert kept.count() == scored.filter("predicted = 1").count()


def test_toxicity(spark):
    docs, labels = tables(spark)
    scored = toxicity.score_toxicity(docs, labels).cache()
    assert scored.count() == docs.count()
    assert accuracy(scored, labels, "toxic") > 0.97
    assert scored.filter("doc_id < 0 and predicted = 1").count() == 0


def test_the_held_out_fold_is_never_read(spark):
    docs, labels = tables(spark)
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
                                                  1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (training_rows(docs, x, "quality").select("doc_id", "label").collect() for x in (labels, flipped))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert all(r["doc_id"] is not None for r in a)


def test_without_labels_or_with_one_class(spark):
    docs, labels = tables(spark)
    few = docs.filter("doc_id < 50")
    none = labels.limit(0)
    assert {r["score"] for r in quality.score_quality(few, none).collect()} == {0.5}
    assert {r["score"] for r in toxicity.score_toxicity(few, none).collect()} == {0.0}
    ones = labels.withColumn("quality", F.lit(1)).withColumn("toxic", F.lit(0))
    assert {r["score"] for r in quality.score_quality(few, ones).collect()} == {1.0}
    assert {r["score"] for r in toxicity.score_toxicity(few, ones).collect()} == {0.0}
    assert quality.score_quality(docs.limit(0), labels).count() == 0
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0


def test_contradicting_and_null_labels(spark):
    docs = spark.createDataFrame([(i, "t", "xx", "s", 0) for i in range(30)], SCHEMA)
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 1), (3, 1), (3, 1), (4, 7), (6, 0)], "doc_id long, quality int")
    got = {(r["doc_id"], r["label"]) for r in training_rows(docs, labels, "quality").collect()}
    assert got <= {(3, 1), (6, 0)} and got


def test_hashed_share(spark):
    ids = spark.range(100_000)
    n = ids.filter(hashed_share(F.col("id"), 5_000, 100_000)).count()
    assert 4_300 < n <= 5_000
    assert ids.filter(hashed_share(F.col("id"), 200_000, 100_000)).count() == 100_000


def test_pairwise_ranking_orders_and_cuts():
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (600, quality.N_FEATURES))
    y = (x[:, 1] - 0.5 * x[:, 3] > -0.8).astype(int)
    s = quality.fit_pairs(x, y).score(x)
    assert ((s >= quality.CUT) == y).mean() > 0.97
    with np.errstate(all="raise"):
        quality.fit_pairs(np.zeros((4, quality.N_FEATURES)), np.array([0, 1, 0, 1]))


def brute_logit(net, words):
    """The network's answer, window by window."""
    e = [net.table[list(toxicity.buckets(w))].sum(0) for w in words] + [np.zeros(toxicity.DIM)] * toxicity.PAD
    out = []
    for w, f, b in zip(toxicity.WIDTHS, net.filters, net.bias):
        answers = [sum(e[i + o] @ f[o] for o in range(w)) for i in range(len(words))] or [np.zeros(toxicity.FILTERS)]
        out.append(np.maximum(np.max(answers, axis=0) + b, 0))
    return float(np.concatenate(out) @ net.out + net.base)


def test_scorer_is_the_network(monkeypatch):
    rng = random.Random(1)
    pool = [f"w{k}" for k in range(300)]
    docs = [[rng.choice(pool) for _ in range(rng.randint(0, 60))] + (["bad"] if k % 2 else []) for k in range(80)]
    vocabulary = toxicity.Vocabulary()
    net = toxicity.train([vocabulary.number(d) for d in docs], _rows(vocabulary, docs),
                         np.arange(80) % 2)
    monkeypatch.setattr(toxicity, "CACHE_WORDS", 64)
    scorer = toxicity.Scorer(net)
    for d in docs + [[], ["one"], ["a", "b"], [f"n{k}" for k in range(500)]]:
        assert scorer(" ".join(d))[0] == pytest.approx(brute_logit(net, d), abs=1e-3)


def _rows(vocabulary, docs):
    for d in docs:
        vocabulary.number(d)
    return vocabulary.rows()


def test_language_guess():
    assert toxicity.LANGUAGES[toxicity.guess("der und das von".split())] == "de"
    assert toxicity.LANGUAGES[toxicity.guess([])] == "other"
