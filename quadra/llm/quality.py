"""Quality classifier: Bradley-Terry ranking learned from preference pairs.

Every pair holds a document labelled good and one labelled bad; the chance
that the good one wins is the logistic function of the difference of their
scores, and the scores are linear in squashed text statistics. So the model
is a logistic regression without intercept on feature differences, fitted on a
bounded sample. The threshold is the quantile of the scores of all labelled rows
at the share of bad ones.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadra.llm import textstats as T
from quadra.llm.common import bounded_batches, crc_mod, documents, labels_of, sampled, text_key, written

# Labelled rows to learn from, and preference pairs drawn among them, at most.
TRAIN_ROWS, PAIRS, SEED = 6000, 40_000, 3
# A document is called good from this score on; the threshold quantile is mapped to it.
CALL = 0.3
RIDGE, STEPS = 1e-3, 30


@dataclass
class Ranker:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float = 0.0

    def features(self, rows: np.ndarray) -> np.ndarray:
        z = (rows - self.centre) / self.scale
        return np.hstack([np.tanh(z), np.tanh(np.maximum(z - 2, 0)), np.tanh(np.maximum(-z - 2, 0))])

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return self.features(rows) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1; ``CALL`` at the threshold."""
        shift = np.log(CALL / (1 - CALL))
        return 1 / (1 + np.exp(-np.clip(self.raw(rows) - self.cut + shift, -30, 30)))


def fit(rows: np.ndarray, good: np.ndarray, pairs: int = PAIRS, seed: int = SEED) -> Ranker:
    """Newton steps on the pairwise logistic loss; all scores are equal without both kinds of labels."""
    n = rows.shape[1]
    if not good.any() or good.all():
        return Ranker(np.zeros(n), np.ones(n), np.zeros(3 * n), -30.0 if good.any() or not len(good) else 30.0)
    centre = np.median(rows[good], axis=0)
    spread = np.percentile(rows[good], 90, axis=0) - np.percentile(rows[good], 10, axis=0)
    model = Ranker(centre, np.maximum(spread, 0.02), np.zeros(3 * n))
    x = model.features(rows)
    rng = np.random.default_rng(seed)
    wins, losses = np.flatnonzero(good), np.flatnonzero(~good)
    count = min(pairs, len(wins) * len(losses))
    ahead = x[rng.choice(wins, count)] - x[rng.choice(losses, count)]
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(ahead @ model.weights, -30, 30)))
        gradient = ahead.T @ (1 - p) / count - RIDGE * model.weights
        curve = (ahead * (p * (1 - p))[:, None]).T @ ahead / count + RIDGE * np.eye(x.shape[1])
        step = np.linalg.solve(curve, gradient)
        model.weights = model.weights + step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-6:
            break
    raw = np.sort(model.raw(rows))
    bad = int((~good).sum())
    model.cut = float((raw[bad - 1] + raw[bad]) / 2)
    return model


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Ranker:
    """Learn from at most ``rows`` distinct labelled documents (id and text), chosen by a hash of both."""
    texts = bounded_batches(docs).select("doc_id", "text", *text_key(F.col("text"))).join(labels_of(labels), F.col("doc_id") == F.col("of"))
    chosen = sampled(texts.select("doc_id", "k1", "k2"), rows, 21)
    same = (F.col("doc_id") == F.col("of_doc_id")) & (F.col("k1") == F.col("of_k1")) & (F.col("k2") == F.col("of_k2"))
    learn = texts.join(F.broadcast(chosen), same).dropDuplicates(["doc_id", "k1", "k2"])

    def measure(batches):
        for pdf in batches:
            yield pd.concat([pdf[["doc_id", "good"]], T.table(pdf["text"])[list(T.RATIOS)]], axis=1)

    kinds = learn.select("doc_id", "good").schema.simpleString()[len("struct<") : -1]
    found = learn.select("doc_id", "good", "text").mapInPandas(measure, f"{kinds}, {', '.join(f'{c} double' for c in T.RATIOS)}").toPandas()
    found = found.sort_values(["doc_id", *T.RATIOS])
    return fit(T.matrix(found), found["good"].to_numpy(dtype=bool))


def raw_scores(docs: DataFrame, ranker: Ranker, *keep: str) -> DataFrame:
    """The columns ``keep`` and the score before its threshold of every document; a null text is scored as an empty one."""
    kinds = docs.select(*keep).schema.simpleString()[len("struct<") : -1]

    def measure(batches):
        for pdf in batches:
            yield pdf[list(keep)].assign(raw=ranker.raw(T.matrix(T.table(pdf["text"]))))

    return bounded_batches(docs).select(*keep, "text").mapInPandas(measure, f"{kinds}, raw double")


def value_at(values: DataFrame, column: str, rank: int, bins: int = 4096, rounds: int = 3) -> float:
    """The value that ``rank`` rows do not exceed, from histograms that each narrow the last one's bin."""
    low, high = values.agg(F.min(column), F.max(column)).first()
    under = 0
    for _ in range(rounds):
        width = (high - low) / bins
        if width <= 0 or low + width == low:
            break
        place = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)).cast("int")
        rows = values.where((F.col(column) >= low) & (F.col(column) <= high)).groupBy(place.alias("bin")).count().collect()
        counts = np.zeros(bins, dtype=np.int64)
        for r in rows:
            counts[r["bin"]] += r["count"]
        at = int(np.searchsorted(np.cumsum(counts), rank - under))
        at = min(at, bins - 1)
        under += int(counts[:at].sum())
        low, high = low + at * width, low + (at + 1) * width
    return float(high)


def threshold(raw: DataFrame, labels: DataFrame, ranker: Ranker) -> float:
    """The cut over all labelled rows of ``raw`` (doc_id, raw): as many fall below as are labelled bad."""
    if not ranker.weights.any():
        return ranker.cut
    known = raw.join(labels_of(labels), F.col("doc_id") == F.col("of")).select("raw", "good")
    bad = known.where(~F.col("good")).count()
    return value_at(known, "raw", bad) if bad else ranker.cut


def called(raw: Column, cut: float) -> Column:
    """0 to 1; ``CALL`` at the threshold."""
    shifted = raw - F.lit(cut) + F.lit(float(np.log(CALL / (1 - CALL))))
    return 1 / (1 + F.exp(-F.greatest(F.least(shifted, F.lit(30.0)), F.lit(-30.0))))


def score_quality(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id and score of every document, learned from ``labels`` (doc_id, quality).

    Repeated rows score alike; unlabelled documents are only scored; labels are
    read as :func:`labels_of` says. No labels, or labels of one kind, give one
    score to all. No rows give no rows; other columns are ignored.
    """
    ranker = train(docs, labels, rows)
    raw = written(raw_scores(docs, ranker, "doc_id"), "scores")
    return raw.select("doc_id", called(F.col("raw"), threshold(raw, labels, ranker)).alias("score"))


def op10_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from the labels of ids whose crc32 modulo 5 is not 0."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(crc_mod(F.col("doc_id"), 5) != 0)
    return score_quality(docs, labels).select(
        "doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= CALL).cast("int").alias("predicted")
    )
