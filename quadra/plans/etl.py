"""Batch jobs: landing -> raw layer -> transformed layer, plus run statistics.

All steps are lazy DataFrame transformations until a layer is written; the
only shuffle of the ETL itself is the rebalance before each partitioned
write (and the alias join when the planner does not broadcast the table).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadra import model as M
from quadra.functions import columns as C
from quadra.sources import adapter, lake

def raw_layer(landing: DataFrame) -> DataFrame:
    """Raw layer of one landing frame (P1-P4 and declared types)."""
    return lake.harmonise(landing)


# Keys over which rows without a district are spread in the alias join.
_NO_DISTRICT_KEYS = 1024


def apply_aliases(df: DataFrame, aliases: DataFrame | None) -> DataFrame:
    """Whole-name replacement of the normalised district, one pass, lazy.

    A left join whose strategy the planner and AQE choose from sizes. Rows
    without a district (often the largest group) match nothing, so they get
    keys that no name can equal and are spread over tasks if the join
    shuffles. A variant whose target is null becomes null.
    """
    if aliases is None:
        return df
    table = aliases.select(F.col("bairro_variante").alias("_alias_key"), F.col("bairro_canonico").alias("_alias_value"))
    spread = F.pmod(F.xxhash64(*[c for c in (M.NUM_BO, M.LOGRADOURO) if c in df.columns], F.lit(0)), F.lit(_NO_DISTRICT_KEYS))
    named = F.col(M.BAIRRO).isNotNull() & (F.col(M.BAIRRO) != "")
    key = F.when(named, F.col(M.BAIRRO)).otherwise(F.concat(F.lit("\x00"), spread.cast("string")))
    joined = df.withColumn("_district_key", key).join(table, F.col("_district_key") == F.col("_alias_key"), "left")
    district = F.when(F.col("_alias_key").isNotNull(), F.col("_alias_value")).otherwise(F.col(M.BAIRRO))
    return joined.withColumn(M.BAIRRO, district).drop("_alias_key", "_alias_value", "_district_key")


def transformed_layer(raw: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Transformed layer: P5 flag, P6 category, P7 original copy, P8/P9 district."""
    cols = set(raw.columns)
    lat = F.col(M.LATITUDE) if M.LATITUDE in cols else None
    lon = F.col(M.LONGITUDE) if M.LONGITUDE in cols else None
    derived = {M.HAS_COORDINATES: C.has_coordinates(lat, lon)}
    if M.RUBRICA in cols:
        derived[M.RUBRICA_MOD] = C.category(F.col(M.RUBRICA))
    if M.BAIRRO in cols:
        derived[M.BAIRRO_ORIGINAL] = F.col(M.BAIRRO)
        derived[M.BAIRRO] = C.normalise_district(F.col(M.BAIRRO))
    out = raw.withColumns(derived)
    if M.BAIRRO in cols:
        out = apply_aliases(out, aliases)
    return out


# Landing columns that a derived column is made from.
_MADE_FROM = {
    M.TRIMESTRE: (M.MES,),
    M.HAS_COORDINATES: (M.LATITUDE, M.LONGITUDE),
    M.RUBRICA_MOD: (M.RUBRICA,),
    M.BAIRRO_ORIGINAL: (M.BAIRRO,),
    M.UNREAD: (M.MES, M.LATITUDE, M.LONGITUDE, M.DATA_OCORRENCIA_BO),
}


def incidents(
    spark: SparkSession, sf_dir: str, aliases: DataFrame | None = None, columns: tuple[str, ...] | None = None
) -> DataFrame:
    """Transformed incident rows derived lazily from the driver's tables.

    With ``columns`` only what these are made from is derived, so only the
    tables that hold it are joined.
    """
    needed = None if columns is None else {n for c in columns for n in _MADE_FROM.get(c, (c,))}
    return transformed_layer(raw_layer(adapter.landing_incidents(spark, sf_dir, needed)), aliases)


def run_raw(landing: DataFrame, raw_root: str) -> list[tuple]:
    """Raw job: write the raw layer (only the partitions present are replaced); gives their keys."""
    return lake.write_layer(raw_layer(landing), raw_root, cluster=False, observe=True)


def run_transformed(
    spark: SparkSession, raw_root: str, out_root: str, aliases: DataFrame | None = None
) -> None:
    """Transformed job: read all raw partitions (merged schema), derive, write."""
    lake.write_layer(transformed_layer(lake.read_layer(spark, raw_root), aliases), out_root)


# --- A16: transform run statistics ----------------------------------------------
def transform_stats(df: DataFrame) -> DataFrame:
    """Rows, rows with coordinates, their percent, distinct districts.

    Distinct counts treat null as one more value (``+ max(isnull)``), the way
    the run log counts them; the percent is null on an empty input.
    """
    def distinct_with_null(c: str):
        return F.count_distinct(F.col(c)) + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))

    out = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(M.HAS_COORDINATES)).alias("rows_with_coordinates"),
        distinct_with_null(M.BAIRRO_ORIGINAL).cast("bigint").alias("districts_before"),
        distinct_with_null(M.BAIRRO).cast("bigint").alias("districts_after"),
    )
    return out.withColumn(
        "pct_with_coordinates",
        C.guarded_percent(F.col("rows_with_coordinates"), F.col("rows")),
    )


def category_counts(df: DataFrame) -> DataFrame:
    """Rows per category, largest first (ties by name)."""
    return (
        df.groupBy(M.RUBRICA_MOD)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), F.col(M.RUBRICA_MOD).asc_nulls_last())
    )


# --- A18: health check -----------------------------------------------------------
def health_check(df: DataFrame) -> DataFrame:
    """One row with the record count and whether it is positive."""
    return df.agg(F.count(F.lit(1)).alias("n")).withColumn("healthy", F.col("n") > 0)


def assert_healthy(df: DataFrame) -> int:
    """A18 as a job step: fail the run when the layer has no record."""
    n = health_check(df).first()["n"]
    if n <= 0:
        raise RuntimeError("health check failed: no records in the transformed layer")
    return n
