import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from quadra.llm import quality as Q
from quadra.llm.common import labels_of, sampled, text_key

SF = "/root/testdata/sf0.01"


def test_pairs_rank_good_above_bad():
    rng = np.random.default_rng(1)
    good = rng.random(500) < 0.8
    rows = rng.normal(size=(500, 4)) + np.where(good, 0.0, 2.0)[:, None] * np.array([1, 0, -1, 0])
    model = Q.fit(rows, good)
    score = model.score(rows)
    assert ((score >= Q.CALL).sum(), (score >= 0).all(), (score <= 1).all()) == (good.sum(), True, True)
    wins = (score[good][:, None] > score[~good][None, :]).mean()
    assert wins > 0.97


def test_one_kind_of_label_or_none_gives_one_score():
    rows = np.ones((5, 3))
    for good in (np.ones(5, bool), np.zeros(5, bool), np.zeros(0, bool)):
        model = Q.fit(rows[: len(good)], good)
        assert len(set(model.score(rows).tolist())) == 1
    assert (Q.fit(rows, np.ones(5, bool)).score(rows) >= Q.CALL).all()
    assert (Q.fit(rows, np.zeros(5, bool)).score(rows) < Q.CALL).all()


def test_held_out_accuracy(spark):
    found = {r["doc_id"]: r for r in Q.op10_bradley_terry(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    held = [(found[x["doc_id"]]["predicted"], x["quality"]) for x in labels if found[x["doc_id"]]["held_out"]]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) >= 0.95


def test_fit_equals_a_plain_pairwise_loop():
    """All pairs of a small set: the gradient at the weights found is zero, scores are plain sums."""
    rng = np.random.default_rng(4)
    good = np.arange(24) % 3 != 0
    rows = rng.normal(size=(24, 2)) + np.where(good, 0.0, 1.0)[:, None]
    model = Q.fit(rows, good, pairs=400_000)
    x = model.features(rows)
    pulls = np.zeros(x.shape[1])
    rng = np.random.default_rng(Q.SEED)
    wins, losses = np.flatnonzero(good), np.flatnonzero(~good)
    count = len(wins) * len(losses)
    for a, b in zip(rng.choice(wins, count), rng.choice(losses, count), strict=True):
        ahead = [x[a, k] - x[b, k] for k in range(x.shape[1])]
        lost = 1 - 1 / (1 + math.exp(-sum(w * d for w, d in zip(model.weights, ahead, strict=True))))
        pulls += np.array(ahead) * lost / count
    assert np.allclose(pulls, Q.RIDGE * model.weights, atol=1e-6)
    for row, raw in zip(rows, model.raw(rows), strict=True):
        z = [(v - c) / s for v, c, s in zip(row, model.centre, model.scale, strict=True)]
        plain = [math.tanh(v) for v in z] + [math.tanh(max(v - 2, 0)) for v in z] + [math.tanh(max(-v - 2, 0)) for v in z]
        assert abs(sum(w * v for w, v in zip(model.weights, plain, strict=True)) - raw) < 1e-9


def test_value_at_a_rank(spark):
    rng = np.random.default_rng(6)
    values = np.round(rng.normal(size=4000), 6)
    df = spark.createDataFrame([(float(v),) for v in values], "raw double")
    for rank in (1, 37, 2000, 4000):
        assert abs(Q.value_at(df, "raw", rank) - np.sort(values)[rank - 1]) < 1e-5
    assert Q.value_at(spark.createDataFrame([(2.0,)] * 9, "raw double"), "raw", 4) == 2.0


def test_threshold_over_all_labelled_rows(spark):
    """The cut counts every labelled row, however few were learned from."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    ranker = Q.train(docs, labels, rows=60)
    raw = Q.raw_scores(docs, ranker, "doc_id")
    cut = Q.threshold(raw, labels, ranker)
    good = {r["doc_id"]: r["quality"] > 0 for r in labels.collect() if r["quality"] is not None}
    known = sorted(r["raw"] for r in raw.collect() if r["doc_id"] in good)
    bad = sum(not g for i, g in good.items() if i is not None)
    assert abs(cut - known[bad - 1]) <= 1e-6 * (known[-1] - known[0]) + 1e-9


def test_repeated_ids_and_conflicting_labels(spark):
    docs = spark.createDataFrame([(7, f"text number {k} of one id") for k in range(500)] + [(8, "other")] * 300, "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1), (7, 0), (7, 1), (8, 0), (8, 1), (9, None)], "doc_id long, quality int")
    assert {r["of"]: r["good"] for r in labels_of(labels).collect()} == {7: True, 8: False}
    keys = docs.select("doc_id", *text_key(F.col("text")))
    assert sampled(keys, 10, 1).count() == 10 and sampled(keys, 9999, 1).count() == 501
    assert sorted(sampled(keys, 10, 1).collect()) == sorted(sampled(keys.repartition(7), 10, 1).collect())


def test_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, "x"), (2, 1, "x"), (9, 0, "x"), (9, 0, "x"), (None, 1, "x"), (3, None, "x")], "doc_id long, quality int, text string")
    rows = Q.score_quality(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (3, 4)}) == 1
    assert Q.score_quality(no_docs, labels).count() == 0
    nothing = labels.where("false")
    assert len({r["score"] for r in Q.score_quality(edge_docs, nothing).collect()}) == 1
