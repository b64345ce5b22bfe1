"""Batch job entry point for ``spark-submit``.

    spark-submit -m quadra.plans.jobs --landing s3a://b/landing/2024.csv \
        --landing s3a://b/landing/2025.csv --lake s3a://b --layer all

Runs the raw and/or transformed job, writes the run manifest, the
per-partition keys, option values (filter widgets), counts and quality metrics,
and district spellings next to the transformed layer, and fails the run when the
transformed layer is empty. Everything is staged before anything is published.
Layer roots: ``<lake>/raw/parquet`` and ``<lake>/transformed/parquet``;
manifest: ``<lake>/transformed/_meta/manifest.json``.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadra import model as M
from quadra.operators import quality as Q
from quadra.operators import reports as R
from quadra.plans import etl
from quadra.session import fresh_path
from quadra.sources import lake


def layer_roots(base: str) -> tuple[str, str, str]:
    base = base.rstrip("/")
    return f"{base}/raw/parquet", f"{base}/transformed/parquet", f"{base}/transformed/_meta/manifest.json"


def options_root(base: str) -> str:
    """Per-partition option values kept for the dashboard's filter widgets."""
    return f"{base.rstrip('/')}/transformed/_options"


def stats_root(base: str) -> str:
    """Per-partition, per-city counts and quality metrics."""
    return f"{base.rstrip('/')}/transformed/_stats"


def pairs_root(base: str) -> str:
    """Per-partition district spellings with their row counts."""
    return f"{base.rstrip('/')}/transformed/_spellings"


def keys_root(base: str) -> str:
    """The key table: counts per partition and city."""
    return f"{base.rstrip('/')}/transformed/_keys"


def side_tables(rows: DataFrame, base: str) -> dict[str, DataFrame]:
    """The side tables of transformed rows by their folder; one whose columns no file has is left out."""
    if M.CIDADE not in rows.columns:
        return {}
    found = {
        keys_root(base): R.partition_keys(rows), options_root(base): R.option_values(rows),
        stats_root(base): Q.partition_stats(rows), pairs_root(base): Q.spelling_pairs(rows),
    }
    return {root: table for root, table in found.items() if table is not None}


def write_side_tables(rows: DataFrame, base: str) -> None:
    """Refresh the side tables for the partitions present in ``rows``
    (dynamic overwrite: other partitions keep their rows)."""
    for root, table in side_tables(rows, base).items():
        lake.write_layer(table, root)


def run(spark: SparkSession, landing: list[str], base: str, layer: str = "all", fmt: str = "csv",
        aliases_csv: str | None = None, tag: str | None = None) -> dict | None:
    """Raw and/or transformed job. The landing files are read once; after that
    only the partitions this run wrote are opened, with the schema they were
    written with (no footers are merged).

    Every layer is first written to a staging folder and checked; only when all
    that the run makes is there are the partitions it touched put in place. A run
    that fails before leaves the published layers as they were; one that fails
    while publishing is mended by running it again.
    """
    raw_root, out_root, manifest_path = layer_roots(base)
    stage = fresh_path(spark, "stage")
    publish = []
    raw_from, keys, schema = raw_root, None, None
    if layer in ("raw", "all"):
        raw = lake.read_landing(spark, landing, fmt)
        if raw.isEmpty():
            raise RuntimeError("health check failed: the landing files hold no records")
        raw_from, schema = f"{stage}/raw", lake.stored_schema(raw)
        keys = lake.write_layer(raw, raw_from, cluster=False, observe=True)
        publish.append((raw_from, raw_root, schema, keys))
    rows = None
    if layer in ("transformed", "all"):
        aliases = lake.read_aliases(spark, aliases_csv) if aliases_csv else None
        rows = etl.transformed_layer(lake.read_layer(spark, raw_from, schema=schema, keys=keys), aliases)
        if keys is None:
            etl.assert_healthy(rows)
        # Derived row by row from the raw layer's files; an alias join may shuffle.
        keys = lake.write_layer(rows, f"{stage}/transformed", observe=True, split=aliases is None)
        schema = lake.stored_schema(rows)
        publish.append((f"{stage}/transformed", out_root, schema, keys))
        rows = lake.read_layer(spark, f"{stage}/transformed", schema=schema, keys=keys)
        for root, table in side_tables(rows, base).items():
            staged = f"{stage}/{root.rsplit('/', 1)[-1]}"
            lake.write_layer(table, staged)
            publish.append((staged, root, lake.stored_schema(table), keys))
        document = lake.manifest_document(manifest_table(spark, rows, f"{stage}/{keys_root(base).rsplit('/', 1)[-1]}", keys), tag or lake.run_tag())
    for staged, root, stored, touched in publish:
        lake.publish_layer(spark, staged, root, stored, touched)
    if rows is None:
        return None
    lake.write_manifest(document, manifest_path)
    return json.loads(document)


def manifest_table(spark: SparkSession, rows: DataFrame, counted: str, keys: list[tuple]) -> DataFrame:
    """Rows per partition: from the key table at ``counted`` (a row per
    partition and city), or counted where the layer has no such table."""
    if M.CIDADE not in rows.columns:
        return lake.manifest_partitions(rows)
    return lake.read_layer(spark, counted, keys=keys).groupBy(M.ANO, M.TRIMESTRE).agg(F.sum("linhas").alias("rows"))


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="landing files -> raw -> transformed lake")
    ap.add_argument("--landing", action="append", default=[], help="landing file group (repeat)")
    ap.add_argument("--lake", required=True, help="base URI of the lake")
    ap.add_argument("--layer", choices=["raw", "transformed", "all"], default="all")
    ap.add_argument("--format", default="csv")
    ap.add_argument("--aliases", default=None, help="alias CSV (bairro_variante,bairro_canonico)")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("quadra-etl").getOrCreate()
    run(spark, args.landing, args.lake, args.layer, args.format, args.aliases)


if __name__ == "__main__":
    main()
