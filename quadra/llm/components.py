"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadra.llm.common import frozen


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _star(links: DataFrame, low: DataFrame) -> DataFrame:
    return links.join(low.withColumnRenamed("u", "of"), F.col("u") == F.col("of"))


def components(links: DataFrame) -> DataFrame:
    """u, v: every node but a component's least with that least node.

    ``links`` has long columns u and v. Each round points the neighbours of
    every node to its least neighbour; links never grow in number, so a hot
    node costs as many rows as it has links. Rounds go on until one changes nothing.
    """
    links = frozen(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = _mark(links)
    while True:
        both = links.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("l")).select("l.*")
        low = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("low"))
        large = _star(both.where("v > u"), low).select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = _star(large, low).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("low").alias("v")), F.struct("u", F.col("low").alias("v")))).alias("l"))
        links = frozen(small.select("l.*").where("u != v").distinct())
        before, mark = mark, _mark(links)
        if mark == before:
            return links
