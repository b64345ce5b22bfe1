import math
import tracemalloc
from collections import Counter
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from quadra.llm import langid as L

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = L.op8_language(spark, SF).collect()
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [langs[r["doc_id"]] == r["lang_pred"] for r in rows if r["held_out"]]
    assert len(rows) == len(langs) and len(held) > 150 and np.mean(held) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_svm_margin_parts_two_classes():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 5)).astype(np.float32)
    y = np.where(x @ np.array([1, -2, 0, 0.5, 0]) + 0.3 > 0, 1.0, -1.0)
    w = L.train_svm(x, y, cost=100.0)
    assert (np.sign(x @ w[:-1] + w[-1]) == y).mean() > 0.97


def test_family_first(spark):
    model = L.train(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang"))
    assert model.families.classes == ["germanic", "romance"]
    assert {k: v.classes for k, v in model.languages.items()} == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    assert L.family("xx") == "only xx"


def test_edges(spark, edge_docs, no_docs):
    model = L.train(edge_docs.select("doc_id", "text", "lang"))
    rows = edge_docs.select("doc_id", L.identify(edge_docs["text"], model).alias("p")).select("doc_id", "p.*").collect()
    for r in rows:
        if r["doc_id"] in (3, 4, 5, 6):
            assert (r["lang_pred"], r["score"]) == (L.UNKNOWN, 0.0)
        elif r["doc_id"] is not None:
            assert r["lang_pred"] in ("en", "fr") and 0 < r["score"] <= 1
    assert no_docs.select(L.identify(no_docs["text"], model).alias("p")).count() == 0
    nothing = L.train(no_docs.select("doc_id", "text", "lang"))
    assert nothing.predict("some text") == (L.UNKNOWN, 0.0)
    one = L.train(edge_docs.where("doc_id = 1").select("doc_id", "text", "lang"))
    assert one.predict("some text") == ("en", 1.0)


def plain_vote(votes, text):
    """Winner and certainty of a set of machines by dot products over the text's trigrams, one at a time."""
    if len(votes.classes) == 1:
        return votes.classes[0], 1.0
    counts = Counter(L.trigrams(text).tolist())
    length = math.sqrt(sum(c * c for c in counts.values())) or 1.0
    won, margin, sure = Counter(), {}, Counter()
    for k, (a, b) in enumerate(combinations(votes.classes, 2)):
        m = sum(c / length * float(votes.weights[t, k]) for t, c in counts.items()) + votes.bias[k]
        won[a if m >= 0 else b] += 1
        margin[a, b], margin[b, a] = m, -m
        sure[a] += math.tanh(m)
        sure[b] -= math.tanh(m)
    best = max(votes.classes, key=lambda c: (won[c], sure[c]))
    return best, 1 / (1 + math.exp(-3 * min(m for (a, _), m in margin.items() if a == best)))


def test_prediction_equals_plain_dot_products(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = L.train(docs)
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()][:150]
    texts += ["der die das und nicht the of", "la casa y le chat", "zzz qqq", "a"]
    for text in texts:
        group, first = plain_vote(model.families, text)
        lang, second = plain_vote(model.languages[group], text)
        got, score = model.predict(text)
        assert got == lang and abs(score - min(first, second)) < 1e-4


def test_the_sample_depends_on_texts_alone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = L.train(docs, rows=200)
    hot = docs.orderBy("doc_id").limit(1).crossJoin(spark.range(3000).select()).unionAll(docs)
    for other in (docs.withColumn("doc_id", F.lit(7)), docs.withColumn("doc_id", F.lit(None).cast("long")).repartition(5), hot):
        same = L.train(other, rows=200)
        assert np.array_equal(same.families.weights, model.families.weights)
        assert all(np.array_equal(same.languages[f].weights, v.weights) for f, v in model.languages.items())


def test_a_verdict_that_is_filtered_on_and_read_is_made_once(spark):
    known = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = L.train(known)
    judged = known.select("lang", L.judge(F.col("text"), model).alias("p")).where(F.col("p.lang_pred") == F.col("lang"))
    read = judged.select("p.score", "p.likeness")
    assert read._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    right = [model.predict(r["text"])[0] == r["lang"] for r in known.collect()]
    assert read.count() == sum(right)


def test_training_keeps_no_whole_profiles(spark):
    """The driver holds the entries that are not 0, with the same order and weights as of whole profiles."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(k, " ".join(letters[(k * j + j) % 20 : (k * j + j) % 20 + 5] for j in range(1, 12)) + f" {letters[k % 26]}{letters[k // 26]}", ("en", "fr")[k % 2]) for k in range(500)]
    known = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    L.train(known)
    tracemalloc.start()
    model = L.train(known)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    whole = sorted((lang, L.profile(text).tobytes()) for _, text, lang in rows)
    x = np.array([np.frombuffer(b, dtype=np.float16) for _, b in whole], dtype=np.float32)
    y = np.array([1.0 if family_ == "germanic" else -1.0 for family_ in (L.family(lang) for lang, _ in whole)])
    assert sorted(set(map(L.family, ("en", "fr")))) == ["germanic", "romance"] and len(x) == 500
    assert np.array_equal(model.families.weights[:, 0], L.train_svm(x, y)[:-1].astype(np.float32))
    assert peak < x.nbytes / 2
    texts = [text for _, text, _ in rows]
    assert sorted(texts, key=L.packed_profile) == sorted(texts, key=lambda t: L.profile(t).tobytes())
