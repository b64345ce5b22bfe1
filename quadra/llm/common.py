"""What the training-data operators share: tables, words, frozen intermediate tables."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadra.session import fresh_path, scratch_root

# A word: a run of characters other than blank and the controls TAB to CR.
WORD = r"[^\x20\x09-\x0D]+"
find_words = re.compile(WORD).findall


# Bytes of text that go to a Python worker at once; texts may be long.
BATCH_BYTES = 8 << 20


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, its session told to send Python workers at most ``BATCH_BYTES`` at once."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def frozen(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the cluster's checkpoint folder.

    Later reads see the same rows (row numbers included) even if an executor
    is lost; use it for compact tables only.
    """
    scratch_root(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table under the checkpoint folder (columns can be pruned on reading)."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def checked_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows, else left to a shuffle join."""
    return F.broadcast(df) if len(df.limit(rows + 1).select(F.lit(1)).collect()) <= rows else df


def packed(docs: DataFrame) -> Column:
    """All columns of a row as one struct ``body``, safe from names an operator adds."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("body")


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a whole text in joins (``k1``, ``k2``; null counts as empty)."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2")]


def fraction_of(column: Column, salt: int) -> Column:
    """A repeatable number in [0, 1) from a column's value."""
    return F.pmod(F.xxhash64(F.lit(salt), column), F.lit(1 << 40)) / float(1 << 40)


def labels_of(labels: DataFrame) -> DataFrame:
    """of, good: one row for every labelled id; good where most of its labels are above 0.

    Null ids and null labels are no labels; an id with as many good as bad ones is bad.
    """
    known = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").alias("of"))
    return known.agg((F.avg((F.col("quality") > 0).cast("int")) > 0.5).alias("good"))


def sampled(keys: DataFrame, rows: int, salt: int) -> DataFrame:
    """At most ``rows`` of the distinct ``keys``: those with the least hashes, whatever the partitions.

    One key however often it occurs is one row of the sample.
    """
    hashed = keys.distinct().select(*[F.col(c).alias(f"of_{c}") for c in keys.columns], F.xxhash64(F.lit(salt), *keys.columns).alias("_hash"))
    return hashed.orderBy("_hash", *[f"of_{c}" for c in keys.columns]).limit(rows).drop("_hash")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % n


def groups_of(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Whole groups from the batches of a partition that is sorted by ``key``."""
    rest: list[pd.DataFrame] = []
    for pdf in batches:
        if not len(pdf):
            continue
        values = pdf[key].to_numpy()
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        if rest and rest[-1][key].iloc[-1] != values[0]:
            yield pd.concat(rest) if len(rest) > 1 else rest[0]
            rest = []
        begin = 0
        for cut in cuts:
            part = pdf.iloc[begin:cut]
            yield pd.concat([*rest, part]) if rest else part
            rest, begin = [], cut
        rest.append(pdf.iloc[begin:])
    if rest:
        yield pd.concat(rest) if len(rest) > 1 else rest[0]
