"""Quality rules: an isolation forest on rule statistics, its threshold set from labelled rows.

The statistics of all documents are computed once, in parallel. The forest is
grown on the driver from a bounded sample of them (``SAMPLE`` rows; a tree
needs ``TREE_ROWS``), sent to the tasks with the scoring function, and scores
every document by the mean path length over the trees: few splits isolate an
odd document. The scores of all labelled rows, as a histogram, then give the
threshold.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadra.llm import textstats as T
from quadra.llm.common import bounded_batches, documents, labels_of, sampled, text_key, written

SAMPLE, TREES, TREE_ROWS, SEED = 20_000, 200, 256, 5
# Statistics of a text's make-up. Repetition is left to the base rules: clean
# texts repeat a line now and then, and the forest would call that odd.
FEATURES = ("mean_word", "symbols_per_word", "marks_per_word", "upper_share", "top_word_share")
BINS = 2000
# Share of the good labelled rows that the threshold may reject at most.
MAX_LOSS = 0.002
# Threshold where there are no labelled rows of both kinds.
DEFAULT_THRESHOLD = 0.65


def expected_depth(n: np.ndarray | float) -> np.ndarray:
    """Mean depth at which n rows part on random splits."""
    n = np.asarray(n, dtype=np.float64)
    more = 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, more, np.where(n == 2, 1.0, 0.0))


class Forest:
    """Trees as arrays; node k has children left[k], left[k] + 1 and, at a leaf, left[k] = k."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.tree_rows = min(tree_rows, len(rows))
        self.depth = int(np.ceil(np.log2(max(self.tree_rows, 2))))
        drawn = (rng.choice(len(rows), self.tree_rows, replace=False) for _ in range(trees if len(rows) else 0))
        self.trees = [self._grow(rows[own], rng) for own in drawn]

    def _grow(self, rows: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
        feature, cut, left, length = [0], [0.0], [0], [0.0]
        waiting = [(0, rows, 0)]
        while waiting:
            k, own, depth = waiting.pop()
            low, high = own.min(axis=0), own.max(axis=0)
            varied = np.flatnonzero(high > low)
            left[k] = k
            if depth >= self.depth or not len(varied):
                length[k] = depth + float(expected_depth(len(own)))
                continue
            feature[k] = int(rng.choice(varied))
            cut[k] = float(rng.uniform(low[feature[k]], high[feature[k]]))
            under = own[:, feature[k]] <= cut[k]
            left[k] = len(left)
            for part in (own[under], own[~under]):
                waiting.append((len(left), part, depth + 1))
                for column, value in ((feature, 0), (cut, 0.0), (left, 0), (length, 0.0)):
                    column.append(value)
        return np.array(feature), np.array(cut), np.array(left), np.array(length)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Near 1: isolated by few splits; 0.5 and less: ordinary."""
        if not self.trees or not len(rows):
            return np.zeros(len(rows))
        total, at = np.zeros(len(rows)), np.arange(len(rows))
        for feature, cut, left, length in self.trees:
            node = np.zeros(len(rows), dtype=np.int64)
            for _ in range(self.depth):
                down = left[node]
                node = np.where(down == node, node, down + (rows[at, feature[node]] > cut[node]))
            total += length[node]
        return 2.0 ** (-total / len(self.trees) / max(float(expected_depth(self.tree_rows)), 1e-9))


def rule_table(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` of every document and its statistics (no text)."""
    kinds = docs.select(*keep).schema.simpleString()[len("struct<") : -1]
    schema = f"{kinds}, {', '.join(f'{c} long' for c in T.COUNTS)}, {', '.join(f'{c} double' for c in T.RATIOS)}"

    def measure(batches):
        for pdf in batches:
            yield pd.concat([pdf[list(keep)], T.table(pdf["text"])], axis=1)

    return bounded_batches(docs).select(*keep, "text").mapInPandas(measure, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def fit_forest(stats: DataFrame, sample: int = SAMPLE) -> Forest:
    """A forest from at most ``sample`` distinct rows (by ``doc_id`` and the text's key ``k1``) that pass the base rules."""
    passed = stats.where(~base_failed())
    chosen = sampled(passed.select("doc_id", "k1"), sample, 11)
    same = F.col("doc_id").eqNullSafe(F.col("of_doc_id")) & (F.col("k1") == F.col("of_k1"))
    rows = passed.join(F.broadcast(chosen), same).dropDuplicates(["doc_id", "k1"]).select(*FEATURES).toPandas()
    return Forest(rows.sort_values(list(FEATURES)).to_numpy(dtype=np.float64))


def scored(stats: DataFrame, forest: Forest) -> DataFrame:
    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        return pd.Series(forest.score(np.column_stack([c.to_numpy(dtype=np.float64) for c in columns])))

    return stats.withColumn("anomaly", score(*[F.col(c) for c in FEATURES]))


def threshold(scores: DataFrame, labels: DataFrame, max_loss: float = MAX_LOSS) -> float:
    """Highest score a kept document may have.

    Of the cuts that reject at most ``max_loss`` of the good labelled rows,
    the one that rejects most bad rows less good ones (in shares).
    """
    labelled = scores.where(~base_failed()).join(labels_of(labels), F.col("doc_id") == F.col("of"))
    found = labelled.groupBy(F.floor(F.col("anomaly") * BINS).cast("int").alias("bin"), "good").count().toPandas()
    counts = {q: np.bincount(g["bin"], weights=g["count"], minlength=BINS + 1) for q, g in found.groupby("good")}
    if len(counts) < 2:
        return DEFAULT_THRESHOLD
    over = {q: (c.sum() - np.cumsum(c)) / c.sum() for q, c in counts.items()}
    gain = np.where(over[True] <= max_loss, over[False] - over[True], -1)
    return (int(gain.argmax()) + 1) / BINS


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document its key doc_id, the counts, base_failed, anomaly, threshold and kept.

    A null or empty text has no words and fails the base rules. Repeated rows
    are judged alike; labels are read as :func:`labels_of` says. A very long text
    is measured whole; other columns are ignored. Without labelled rows of both kinds the threshold is
    ``DEFAULT_THRESHOLD``; without documents that pass the base rules there is
    no forest and no anomaly. No rows give no rows.
    """
    keyed = docs.select("doc_id", "text", text_key(F.col("text"))[0])
    stats = written(rule_table(keyed, "doc_id", "k1"), "rules")
    scores = scored(stats, fit_forest(stats))
    cut = threshold(scores, labels)
    verdict = ~F.col("base_failed") & (F.col("anomaly") < cut)
    return scores.withColumn("base_failed", base_failed()).withColumns({"threshold": F.lit(cut), "kept": verdict})


def op2_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and the forest's verdict on all documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge(documents(spark, sf_dir), labels).select("doc_id", *T.COUNTS, "base_failed", "kept", "anomaly")
