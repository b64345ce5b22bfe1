"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A source that is to give more than its own tokens first gives complete
epochs; the rest of its target is a weighted sample without replacement: each
document gets the exponential key -ln(u) / w (u uniform, from a hash of its
id and text; w its quality weight), the documents of a source are taken in ascending
order of the key, and a prefix sum of their sizes stops at the budget.

The prefix sum first runs over a histogram of the keys on a logarithmic scale
(no class holds more than about a thousandth of a source, whatever its
weights), so a hot source is never sorted in one task: only the class in
which its budget ends is ordered row by row. That gives one cut a source, and
every document is then decided by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quadra.llm.common import WORD, checked_broadcast, documents, frozen, packed

# Relative weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
# Characters that count against a text's quality weight.
NOISE = "0123456789#*$%&|<>!@^~_=+{}[]"
# Classes of the key histogram per factor of two.
CLASSES = 512
# Sources up to which the table of cuts is broadcast.
BROADCAST_SOURCES = 100_000


def quality_weight(text: Column) -> Column:
    """1 for plain prose, less the more digits and symbols it has, 0.05 at least."""
    length = F.length(text)
    noise = length - F.length(F.translate(text, NOISE, ""))
    return F.when(length > 0, F.greatest(F.lit(0.05), 1 - 4 * noise / length)).otherwise(0.05)


def uniform(doc_id: Column, text: Column, seed: str = "mix") -> Column:
    """A number in (0, 1) from the id and the text: 48 bits of an md5, the same in every run."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(text)))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def keyed(docs: DataFrame, *keep: Column) -> DataFrame:
    """``keep`` plus source, size, key, its class and what orders equal keys."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        *keep,
        F.col("source").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        (-F.log(uniform(F.col("doc_id"), text)) / quality_weight(text)).alias("key"),
        F.struct(F.col("doc_id").cast("string").alias("id"), F.xxhash64(text).alias("digest")).alias("tie"),
    )
    return rows.withColumn("class", F.floor(F.log2("key") * CLASSES).cast("int"))


def source_targets(sized: DataFrame, share: float, most: float, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size, target: ``share`` of all sizes by weight, ``most`` x its size at most.

    What a source cannot take is shared again by weight: target =
    min(cap, level * weight), where the level follows from the sources in
    order of cap / weight (if the first k are at their caps, the k-th level
    holds; the highest level that its source can take is the right one). The
    windows run over one row a source.
    """
    everything = W.partitionBy()
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    pick = F.array(*[F.lit(float(w)) for w in weights])
    sums = (
        sums.withColumn("weight", F.get(pick, (F.row_number().over(by_name) - 1) % len(weights)))
        .withColumn("cap", most * F.col("source_size"))
        .withColumn("budget", share * F.sum("source_size").over(everything))
    )
    filling = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    filled = F.coalesce(F.sum("cap").over(filling.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(filling.rowsBetween(0, W.unboundedFollowing))
    sums = sums.withColumn("level", (F.col("budget") - filled) / open_weight)
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    return sums.withColumn("level", F.max(fits).over(everything)).select(
        "source", "source_size", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target")
    )


def source_cuts(sized: DataFrame, share: float, most: float, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row a source: its epochs, and the class and the last order in it that the fraction takes."""
    targets = source_targets(sized, share, most, weights)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("epochs", epochs.cast("long"))
    targets = targets.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    targets = targets.withColumnRenamed("source", "of")
    classes = sized.groupBy("source", "class").agg(F.sum("size").alias("class_size"))
    running = W.partitionBy("source").orderBy("class")
    classes = classes.withColumn("through", F.sum("class_size").over(running))
    ends = (
        classes.join(targets, F.col("source").eqNullSafe(F.col("of")))
        .where("through >= rest")
        .groupBy("of", "source_size", "target", "epochs", "rest")
        .agg(F.min(F.struct("class", (F.col("through") - F.col("class_size")).alias("before"))).alias("end"))
        .select("of", "source_size", "target", "epochs", "rest", F.col("end.class").alias("last_class"), "end.before")
    )
    ends = frozen(ends)
    small = checked_broadcast(ends, BROADCAST_SOURCES)
    inside = sized.join(small, F.col("source").eqNullSafe(F.col("of")) & (F.col("class") == F.col("last_class")))
    order = F.struct("key", "tie", "size")
    inside = inside.groupBy("of", order.alias("order")).agg(
        F.sum("size").alias("own"), F.first("before").alias("before"), F.first("rest").alias("rest")
    )
    through = F.col("before") + F.sum("own").over(W.partitionBy("of").orderBy("order"))
    inside = inside.withColumn("through", through)
    nearer = (F.col("through") <= F.col("rest")) | (F.col("through") - F.col("rest") <= F.col("rest") - F.col("through") + F.col("own"))
    taken = inside.where(nearer & (F.col("rest") > 0)).groupBy(F.col("of").alias("taken_of")).agg(F.max("order").alias("last_order"))
    cuts = ends.join(taken, F.col("of").eqNullSafe(F.col("taken_of")), "left")
    return frozen(cuts.select("of", "source_size", "target", "epochs", "last_class", "last_order"))


def with_copies(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """``rows`` (of :func:`keyed`) with source_size, target and ``copies``: how often the mix takes each."""
    rows = rows.join(checked_broadcast(cuts, BROADCAST_SOURCES), F.col("source").eqNullSafe(F.col("of")))
    inside = (F.col("class") == F.col("last_class")) & (F.struct("key", "tie", "size") <= F.col("last_order"))
    extra = (F.col("class") < F.col("last_class")) | F.coalesce(inside, F.lit(False))
    return rows.withColumn("copies", F.col("epochs") + extra.cast("long"))


def mix(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``docs`` as the mix takes them: a document taken twice is there twice, one not taken is not there.

    The document in which a source's budget ends is taken if that brings the
    source nearer to its target. A null or empty text has size 0. A null
    source is a source, the last one. Rows of one id, or of none, are told
    apart by their texts; rows equal in both are taken or left together. No rows give no rows. Other
    columns, whatever their names, stay as they are.
    """
    cuts = source_cuts(frozen(keyed(docs)), share, most, weights)
    rows = with_copies(keyed(docs, packed(docs)), cuts)
    return rows.where("copies > 0").withColumn("copy", F.explode(F.expr("sequence(1, copies)"))).select("body.*")


def op7_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document (repeats counted)."""
    rows = frozen(keyed(documents(spark, sf_dir), F.col("doc_id")))
    return with_copies(rows, source_cuts(rows, 1.5, 2.0)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


_W = WORD.replace("'", "''")
OP7_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_W}')) AS size,
         -ln((CAST('0x' || md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, '')))[1:12] AS BIGINT) + 0.5) / 281474976710656.0)
           / CASE WHEN length(coalesce(text, '')) > 0
             THEN greatest(0.05, 1 - 4.0 * (length(text) - length(translate(text, '{NOISE}', ''))) / length(text))
             ELSE 0.05 END AS k
  FROM documents),
sums AS (
  SELECT source, sum(size) AS source_size,
         ([3.0, 1.0, 2.0])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sized GROUP BY source),
steps AS (
  SELECT *, (1.5 * sum(source_size) OVER ()
    - coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl
  FROM sums),
targets AS (
  SELECT source, source_size,
    least(2.0 * source_size, coalesce((SELECT max(lvl) FROM steps WHERE lvl * weight <= 2 * source_size) * weight,
      2.0 * source_size)) AS target
  FROM steps),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM targets),
run AS (
  SELECT s.doc_id, s.size, CAST(p.source_size AS BIGINT) AS source_size, CAST(p.target AS DOUBLE) AS target, p.epochs,
    p.target - p.epochs * p.source_size AS rest,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, CAST(s.doc_id AS VARCHAR), s.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS through
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(size * (epochs + CASE WHEN through <= rest OR through - rest <= rest - (through - size) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM run
"""
