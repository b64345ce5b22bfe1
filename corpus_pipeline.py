"""A training corpus from raw documents: five stages, each a Spark job from table to table.

Every stage takes all that the one before it kept and returns documents; only
the last one adds columns. A stage's result is written as Parquet and read
again, so a stage can be repeated by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadra.llm import decontaminate, langid, mixing, ngramjoin, sharding
from quadra.llm.common import documents, packed, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the labelled languages, as surely as nearly all labelled ones.

    Null texts, texts without a letter and those below a cut go: other
    languages, code and garbled texts. A text is judged by itself, so repeated
    rows stay or go together; without labelled languages, or rows, none are kept.
    """
    model = langid.train(docs.select("doc_id", "text", "lang"))
    score, likeness = langid.cuts(docs.select("text", "lang"), model)
    judged = docs.select(packed(docs), langid.judge(F.col("text"), model).alias("found"))
    sure = (F.col("found.score") >= score) & (F.col("found.likeness") >= likeness)
    return judged.where((F.col("found.lang_pred") != langid.UNKNOWN) & sure).select("body.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group that similarities of 0.8 or more connect.

    The one with the least id stays (nulls last); texts without words all stay;
    repeated rows are copies; no rows give no rows.
    """
    return ngramjoin.one_of_each(docs)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    A null or empty text holds none and stays; a text is judged by itself,
    whatever its length; without items all stay. Items of fewer than
    ``LEAST_WORDS`` words are not searched.
    """
    return decontaminate.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    Null ids and null sources count as such; documents equal in id and text are
    taken or left together; documents without words have size 0; no rows give no rows.
    """
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and their place in it.

    Rows with a null or repeated id are dealt by their texts; equal rows are
    interchangeable; no rows give no rows.
    """
    return sharding.bounded_ring(docs, "doc_id", spread=("text",))


STAGES = [
    ("language_id", language),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", contamination),
    ("source_mixing", mixture),
    ("sharding", shards),
]
# The stages learn models, search an index and hash: no SQL gives these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
