"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points of a 64-bit ring. A row's key hashes to an
arc, and the shards met clockwise from there are its choices. Round by round
each shard takes rows that still want it until it is full; the others go on
to the next shard clockwise. A row that found room in its first choice never
moves, so a shard that joins or leaves displaces little more than its share.

Rows of one arc have the same choices, so the rounds run on counts: rows are
counted per cell (arc x priority bucket), a table whose size depends on the
ring alone, and each cell is cut into pieces of consecutive ranks.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quadra.llm.common import documents, frozen


@dataclass(frozen=True)
class Ring:
    """``vnodes`` points for each of ``shards``; ``buckets`` priority classes an arc."""

    shards: int = 8
    vnodes: int = 32
    buckets: int = 64
    seed: int = 17

    def points(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted ring positions, and for the arc ending at each the shards met clockwise."""
        at = sorted(
            (int.from_bytes(hashlib.blake2b(f"{self.seed}:{s}:{v}".encode(), digest_size=8).digest(), "big", signed=True), s)
            for s in range(self.shards)
            for v in range(self.vnodes)
        )
        owners = [s for _, s in at]
        choices = [list(dict.fromkeys(owners[k:] + owners[:k])) for k in range(len(owners))]
        return np.array([p for p, _ in at], dtype=np.int64), np.array(choices, dtype=np.int64)


def capacities(rows: int, shards: int, load: float) -> np.ndarray:
    """Rows a shard may hold: at ``load`` 1 the counts differ by one at most."""
    if load <= 1:
        return rows // shards + (np.arange(shards) < rows % shards)
    return np.full(shards, int(np.ceil(load * rows / shards)))


def allocate(cells: np.ndarray, counts: np.ndarray, ring: Ring, load: float) -> pd.DataFrame:
    """Pieces (cell, lo, hi, shard, slot): ranks lo..hi-1 of a cell go to a shard from slot on."""
    _, choices = ring.points()
    arc, bucket = cells // ring.buckets, cells % ring.buckets
    order = np.lexsort((arc, bucket))
    cells, left, arc = cells[order], counts[order].astype(np.int64), arc[order]
    begin, room = np.zeros_like(left), capacities(int(left.sum()), ring.shards, load).astype(np.int64)
    used, pieces = np.zeros_like(room), []
    for turn in range(ring.shards):
        for shard in range(ring.shards):
            want = np.flatnonzero((choices[arc, turn] == shard) & (left > 0))
            before = np.cumsum(left[want]) - left[want]
            take = np.clip(room[shard] - before, 0, left[want])
            want, take, before = want[take > 0], take[take > 0], before[take > 0]
            pieces.append(np.stack([cells[want], begin[want], begin[want] + take, np.full(len(want), shard), used[shard] + before]))
            begin[want] += take
            left[want] -= take
            room[shard] -= take.sum()
            used[shard] += take.sum()
    return pd.DataFrame(np.concatenate(pieces, axis=1).T, columns=["cell", "lo", "hi", "shard", "slot"])


def on_ring(keyed: DataFrame, ring: Ring, spread: list[Column]) -> DataFrame:
    """``keyed`` with the cell of column ``key``; ``spread`` sets the priority among rows of an arc."""
    points = ring.points()[0].tolist()

    def arc(lo: int, hi: int) -> Column:
        """The first of the points lo..hi-1 at or after the hash, else hi (past the last point: the first arc)."""
        if lo == hi:
            return F.lit(lo % len(points))
        mid = (lo + hi) // 2
        return F.when(F.col("hash") <= points[mid], arc(lo, mid)).otherwise(arc(mid + 1, hi))

    priority = F.xxhash64(F.lit(ring.seed), F.col("key"), *spread)
    hashed = keyed.withColumns({"hash": F.xxhash64(F.col("key")), "priority": priority})
    cell = arc(0, len(points)).cast("long") * ring.buckets + F.pmod(F.col("priority"), F.lit(ring.buckets))
    return hashed.withColumn("cell", cell).drop("hash")


def piece_table(spark: SparkSession, pieces: pd.DataFrame) -> DataFrame:
    """``pieces`` as a table, by way of Arrow: rows given as a list would be read by Python workers on the executors."""
    return spark.createDataFrame(pa.table({c: pa.array(pieces[c].to_numpy(), pa.int64()) for c in pieces.columns}))


def bounded_ring(rows: DataFrame, key: str, ring: Ring = Ring(), load: float = 1.0, spread: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard).

    ``load`` 1 makes counts differ by one at most; above 1 a shard holds at
    most ``load`` times the mean and fewer rows leave their first choice.
    A null key is a key like any other. Equal rows are interchangeable; rows
    that repeat a key spread over priorities by the columns in ``spread``. No
    rows give no rows. Columns of ``rows`` called shard or slot are replaced.
    Only the counts per cell (at most points x buckets) reach the driver.
    ``rows`` is evaluated twice and must give the same rows both times.
    """
    spark = rows.sparkSession
    rows = rows.drop("shard", "slot")
    body = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("body")
    placed = rows.select(body, F.col(f"`{key}`").alias("key"))
    placed = on_ring(placed, ring, [F.col(f"body.`{c}`") for c in spread])
    found = placed.groupBy("cell").count().collect()
    cells = np.array([r["cell"] for r in found], dtype=np.int64)
    pieces = allocate(cells, np.array([r["count"] for r in found], dtype=np.int64), ring, load)
    table = piece_table(spark, pieces)
    ranked = placed.withColumn(
        "rank", F.row_number().over(W.partitionBy("cell").orderBy("priority", *[F.col(f"body.`{c}`") for c in spread])) - 1
    )
    joined = ranked.join(F.broadcast(table), "cell").where("rank >= lo and rank < hi")
    return joined.select("body.*", F.col("shard").cast("int").alias("shard"), (F.col("slot") + F.col("rank") - F.col("lo")).alias("slot"))


def op1_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7, counts at most one apart (law ``rows``).

    A null text has no bytes (size 1) and crc32 0, as an empty one.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    return bounded_ring(frozen(rows), "doc_id", spread=("size", "text_crc32")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
