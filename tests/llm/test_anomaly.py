import random
import re
from collections import Counter

import numpy as np

from pyspark.sql import functions as F

from quadra.llm import anomaly as A
from quadra.llm import textstats as T


def test_counts_equal_plain_definitions():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice(["a", "b", "a b c", " ", "\n", "#", "|", "é", "\t", "a b c\n"]) for _ in range(rng.randrange(40)))
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        often = Counter(windows)
        inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
        seen, lines = set(), 0
        for line in text.split("\n"):
            lines += line in seen and bool(line.strip(" \t\n\v\f\r"))
            seen.add(line)
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), lines, len(inside))
        assert T.statistics(text)[:5] == want


def test_forest_finds_what_lies_apart():
    rng = np.random.default_rng(0)
    rows = np.vstack([rng.normal(0, 1, (2000, 3)), rng.normal(9, 0.2, (6, 3))])
    score = A.Forest(rows, trees=100).score(rows)
    assert set(np.argsort(score)[-6:]) == set(range(2000, 2006))
    assert (A.Forest(rows, trees=20).score(rows) == A.Forest(rows, trees=20).score(rows)).all()
    assert A.Forest(np.zeros((0, 3))).score(rows).max() == 0


def plain_depth(tree, row):
    feature, cut, left, length = tree
    k = 0
    while left[k] != k:
        k = left[k] + (row[feature[k]] > cut[k])
    return length[k]


def test_scores_equal_walking_each_tree():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(300, 4))
    forest = A.Forest(rows, trees=15, tree_rows=64)
    mean = [np.mean([plain_depth(t, r) for t in forest.trees]) for r in rows]
    want = 2.0 ** (-np.array(mean) / float(A.expected_depth(64)))
    assert np.allclose(forest.score(rows), want)


def labelled(spark):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(900)]
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(60, 120))]
        bad = i % 25 == 0
        marked = (w + "#$%&*"[: rng.randrange(2, 6)] if rng.random() < 0.7 else w for w in words)
        rows.append((i, " ".join(marked) if bad else " ".join(w + rng.choice(["", "", ",", "."]) for w in words)))
        labels.append((i, 0 if bad else 1, "clash"))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, text string")


def test_threshold_from_labels_parts_good_from_bad(spark):
    docs, labels = labelled(spark)
    rows = A.judge(docs, labels).collect()
    assert len(rows) == 400 and all(r["kept"] == (r["doc_id"] % 25 != 0) for r in rows)
    assert sum(r["base_failed"] for r in rows) == 0


def test_a_shared_or_null_id_is_sampled_by_its_texts(spark):
    docs, labels = labelled(spark)
    shared = docs.withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")))
    stats = A.rule_table(shared.select("doc_id", "text", F.xxhash64("text").alias("k1")), "doc_id", "k1")
    assert len(A.fit_forest(stats).trees) > 0 and len(A.fit_forest(stats, 30).trees) > 0
    rows = A.judge(shared, labels).collect()
    assert sum(r["anomaly"] > 0 for r in rows) == 400


def test_edges(spark, edge_docs, no_docs):
    _, labels = labelled(spark)
    rows = A.judge(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        if r["n_words"] < 50:
            assert r["base_failed"] and not r["kept"]
    assert {r["n_words"] for r in rows if r["doc_id"] in (3, 4, 5)} == {0}
    assert A.judge(no_docs, labels).count() == 0
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    assert {r["threshold"] for r in A.judge(edge_docs, none).collect()} == {A.DEFAULT_THRESHOLD}
