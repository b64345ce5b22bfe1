"""Incremental landing ingest: the scheduled batch run as a file stream.

With Structured Streaming the scheduled run becomes an ``availableNow`` query
over the landing folder: each micro-batch holds only files not seen before
(tracked in the checkpoint). A batch's raw rows go to a folder of their own,
``<raw>/batch_id=N/ano=.../trimestre=...``, which is *overwritten*: a batch
that is run again after a failure, however far it had come, replaces its own
rows and no others. The transformed layer is then rebuilt (dynamic overwrite)
for exactly the (year, quarter) partitions the batch touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quadra import model as M
from quadra.plans import etl, jobs
from quadra.sources import lake, landing


def read_raw(spark: SparkSession, raw_root: str) -> DataFrame:
    """All batches of the stream's raw layer."""
    return lake.read_layer(spark, raw_root).drop("batch_id")


def _in(keys: list[tuple]) -> Column:
    """Rows of the given (year, quarter) partitions (null-safe)."""
    cond = F.lit(False)
    for year, quarter in keys:
        cond = cond | (F.col(M.ANO).eqNullSafe(year) & F.col(M.TRIMESTRE).eqNullSafe(quarter))
    return cond


def write_batch(batch: DataFrame, batch_id: int, raw_root: str, transformed_root: str,
                aliases: DataFrame | None = None, side_base: str | None = None) -> None:
    """One micro-batch; running it again gives the same layers."""
    spark = batch.sparkSession
    if batch.isEmpty():
        return
    keys = lake.write_layer(etl.raw_layer(batch), f"{raw_root.rstrip('/')}/batch_id={batch_id}", cluster=False, observe=True)
    lake.write_layer(etl.transformed_layer(read_raw(spark, raw_root).where(_in(keys)), aliases), transformed_root)
    if side_base is not None:
        jobs.write_side_tables(lake.read_layer(spark, transformed_root, keys=keys), side_base)


def start_ingest(
    spark: SparkSession,
    landing_dir: str,
    schema: T.StructType,
    raw_root: str,
    transformed_root: str,
    checkpoint: str,
    fmt: str = "csv",
    aliases: DataFrame | None = None,
    side_base: str | None = None,
) -> StreamingQuery:
    """Ingest every landing file not seen before, then stop (``availableNow``).

    ``schema`` is the landing files' schema (streams need it declared; of CSV its
    names, which are read as text).
    Partition keys of the batch are collected (bounded by the number of
    partitions) to restrict the transformed rebuild — and, given the lake's
    ``side_base``, the refresh of the side tables — to those partitions.
    """
    reader = spark.readStream.schema(schema)
    if fmt == "csv":
        # Read as the batch job reads them: text, records over lines, malformed ones kept.
        reader = spark.readStream.schema(landing.csv_schema(schema.names)).options(**landing.CSV_OPTIONS, multiLine="true")
    stream = reader.format(fmt).load(landing_dir)

    return (
        stream.writeStream.foreachBatch(
            lambda batch, batch_id: write_batch(batch, batch_id, raw_root, transformed_root, aliases, side_base)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
