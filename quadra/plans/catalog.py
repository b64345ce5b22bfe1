"""Named queries over the driver's tables: one per operator of the inventory.

Every query starts from :func:`quadra.plans.etl.incidents` (the transformed
rows Spark derives from the star-schema tables) or from the landing rows, so
its work grows with the tables. Parameters a dashboard user would pick are
fixed here; the year-over-year pair and its quarters are derived from the
data, as the comparison page does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadra import model as M
from quadra.functions import columns as C
from quadra.operators import extracts as X
from quadra.operators import quality as Q
from quadra.operators import reports as R
from quadra.plans import etl, jobs
from quadra.session import fresh_path
from quadra.sources import adapter, lake

# --- parameters of the registered dashboard queries ---------------------------------
STATS_SCOPE = M.Scope(year=2000, quarters=(1, 2, 3, 4))
FILTERED_SCOPE = M.Scope(
    year=2000,
    quarters=(2, 3),
    districts=("JARDIM SAO NATION 3", "VILA NATION 7", "SANTA NATION 12", "D'AVILA"),
    categories=("Roubo", "Furto", "Outros"),
    periods=("A noite", "De madrugada", ""),
)
# Base year picked by the user in ``comparison_base_year``: the first one, so
# the year before it is not there.
GIVEN_BASE_YEAR = 1995


def _incidents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return etl.incidents(spark, sf_dir, columns=columns or None)


# --- landing / lake ----------------------------------------------------------------
def _landed(spark: SparkSession, sf_dir: str) -> list[str]:
    """The landing rows written as drifting CSV files."""
    return adapter.write_landing_files(spark, sf_dir, fresh_path(spark, "landing"))


def landing_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + U1 (+P1-P4 per group): the landing files read and united, every row."""
    return lake.read_landing(spark, _landed(spark, sf_dir))


def landing_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder that holds the files of both formats side by side, every row."""
    return lake.read_landing(spark, adapter.write_landing_files(spark, sf_dir, fresh_path(spark, "landing"), together=True))


def landing_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records over several lines, with fields to spare and with missing ones, every record."""
    return lake.read_landing(spark, [adapter.write_malformed_files(spark, sf_dir, fresh_path(spark, "malformed"))])


def malformed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed records counted by year with the other unread texts."""
    return Q.unread_values(landing_malformed(spark, sf_dir))


def harmonise_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 + P4 (+P3): both file groups' year, month and quarter after renaming and casting."""
    raw = lake.read_landing(spark, _landed(spark, sf_dir))
    return raw.select(M.NUM_BO, M.VERSAO, M.ANO, M.MES, M.TRIMESTRE)


def unread_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1/P13 on the landing files: texts that no typed column holds, by year and column."""
    return Q.unread_values(lake.read_landing(spark, _landed(spark, sf_dir)))


def lake_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + S3: write the transformed layer partitioned, read every partition back."""
    root = fresh_path(spark, "transformed")
    lake.write_layer(_incidents(spark, sf_dir), root)
    return lake.read_layer(spark, root)


def schema_merge_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 (+S2 dynamic overwrite): one run per landing file; older partitions
    lack two columns, which the merged scan returns as null, and the second
    run leaves the first one's partitions."""
    root = fresh_path(spark, "raw")
    for path in _landed(spark, sf_dir):
        lake.write_layer(lake.read_landing(spark, [path]), root)
    return lake.read_layer(spark, root).select(
        M.NUM_BO, M.VERSAO, M.ANO_BO, M.ANO, M.TRIMESTRE, M.MES, M.BAIRRO, adapter.REMARK
    )


def manifest_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 (+S7): the manifest written as one JSON object and read back, a row per partition."""
    path = f"{fresh_path(spark, 'manifest')}/manifest.json"
    parts = lake.manifest_partitions(_incidents(spark, sf_dir, M.ANO, M.TRIMESTRE))
    lake.write_manifest(lake.manifest_document(parts, "check"), path)
    stored = lake.manifest_rows(spark, path)
    return stored.select(
        "schema_version", "source", F.to_json("anos_processados").alias("anos_processados"), "total_rows", F.inline("partitions")
    )


def alias_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An alias table of all normalised districts, every variant twice, written by many tasks and read: the later line wins."""
    path = fresh_path(spark, "aliases")
    names = _incidents(spark, sf_dir, M.BAIRRO).where(X.non_blank(M.BAIRRO)).select(F.col(M.BAIRRO).alias("bairro_variante")).distinct()
    line = lambda n, target: F.struct(F.lit(n).alias(M.ALIAS_LINE), target.alias("bairro_canonico"))
    variant = F.col("bairro_variante")
    target = F.when(~variant.startswith("VILA"), F.concat(variant, F.lit(" UNIFICADO")))
    table = names.select("bairro_variante", F.inline(F.array(line(2, target), line(1, F.lit("ANTIGO")))))
    table.write.option("header", "true").csv(path)
    return lake.read_aliases(spark, path)


# --- the batch job -------------------------------------------------------------------
# The first run lands every row; the second lands some again and so replaces the partitions they are in.
SECOND_RUN_FROM = 1997


def _two_runs(spark: SparkSession, sf_dir: str) -> str:
    """A lake that the batch job published in two runs which share partitions."""
    base, key = fresh_path(spark, "lake"), F.col(M.NUM_BO).cast("bigint")
    rows = adapter.landing_incidents(spark, sf_dir)
    again = (F.col(M.ANO) >= SECOND_RUN_FROM) & (key % 3 == 0)
    for name in ("first", "second"):
        landing = f"{base}/landing/{name}"
        rows.write.parquet(landing)
        jobs.run(spark, [landing], base, fmt="parquet", tag=name)
        # The second run's rows are among the first's: no need to join the tables again.
        rows = spark.read.parquet(landing).where(again)
    return base


def publish_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 + S2: the transformed layer after both runs of the batch job, every row."""
    return lake.read_layer(spark, jobs.layer_roots(_two_runs(spark, sf_dir))[1])


def kept_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 + A6 + A9 kept incrementally: the statistics table after both runs."""
    return lake.read_layer(spark, jobs.stats_root(_two_runs(spark, sf_dir)))


def kept_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A17 kept incrementally: the widget options after both runs."""
    return R.filter_options_from_values(lake.read_layer(spark, jobs.options_root(_two_runs(spark, sf_dir))))


def kept_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 kept incrementally: spelling variants after both runs."""
    return Q.district_variants_from_pairs(lake.read_layer(spark, jobs.pairs_root(_two_runs(spark, sf_dir))))


def kept_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 + S8: the manifest that the second run of the batch job left, a row per partition it wrote."""
    stored = lake.manifest_rows(spark, jobs.layer_roots(_two_runs(spark, sf_dir))[2])
    return stored.select("schema_version", "source", "total_rows", F.inline("partitions"))


# --- derivations -----------------------------------------------------------------------
def coord_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 on every landing row: text in, double out."""
    landing = adapter.landing_incidents(spark, sf_dir, {M.NUM_BO, M.LATITUDE, M.LONGITUDE})
    return landing.select(
        M.NUM_BO,
        F.col(M.LATITUDE).alias("LATITUDE_TEXTO"),
        C.parse_decimal_text(F.col(M.LATITUDE)).alias(M.LATITUDE),
        F.col(M.LONGITUDE).alias("LONGITUDE_TEXTO"),
        C.parse_decimal_text(F.col(M.LONGITUDE)).alias(M.LONGITUDE),
    )


def quarter_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month -> quarter, with row counts (null month kept)."""
    raw = etl.raw_layer(adapter.landing_incidents(spark, sf_dir, {M.MES}))
    return raw.groupBy(M.MES, M.TRIMESTRE).agg(F.count(F.lit(1)).alias("rows"))


def has_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 on every row."""
    columns = (M.NUM_BO, M.VERSAO, M.LATITUDE, M.LONGITUDE, M.HAS_COORDINATES)
    return _incidents(spark, sf_dir, *columns).select(*columns)


def category_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heading -> category, with row counts."""
    return (
        _incidents(spark, sf_dir, M.RUBRICA_MOD)
        .groupBy(M.RUBRICA, M.RUBRICA_MOD)
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def district_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7 + P8: original spelling -> normalised name, with row counts."""
    return (
        _incidents(spark, sf_dir, M.BAIRRO)
        .groupBy(M.BAIRRO_ORIGINAL, M.BAIRRO)
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def nation_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An alias table derived from the nation table: for even nation keys,
    ``SANTA <nation>`` is merged into ``JARDIM SAO <nation>``; every tenth
    has no target."""
    nation = adapter.read_table(spark, sf_dir, "nation")
    name = F.regexp_replace(F.col("n_name"), "_", " ")
    return nation.where(F.col("n_nationkey") % 2 == 0).select(
        F.concat(F.lit("SANTA "), name).alias("bairro_variante"),
        F.when(F.col("n_nationkey") % 10 != 0, F.concat(F.lit("JARDIM SAO "), name)).alias("bairro_canonico"),
    )


def district_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised names after the alias table, with row counts."""
    inc = etl.incidents(spark, sf_dir, nation_aliases(spark, sf_dir), (M.BAIRRO, M.NUM_BO))
    return inc.groupBy(M.BAIRRO_ORIGINAL, M.BAIRRO).agg(F.count(F.lit(1)).alias("rows"))


# --- dashboard reports: functions of the transformed rows ----------------------------------
def _stats_of(inc: DataFrame, scope: M.Scope = STATS_SCOPE) -> DataFrame:
    return X.stats_extract(inc, scope)


def _base_year_given(parts: DataFrame) -> DataFrame:
    """U2 + U3 with a base year that the user picked; the compared year is defaulted."""
    return R.comparison(parts, year_a=GIVEN_BASE_YEAR).withColumn("trimestres", F.to_json("trimestres"))


# Each report takes the transformed incident rows — derived lazily from the
# tables in ``QUERIES``, or read from the partitioned lake in the bench.
REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    # extracts
    "map_points": lambda inc: X.map_points(inc, STATS_SCOPE),
    "stats_extract": lambda inc: _stats_of(inc),
    "stats_extract_filtered": lambda inc: _stats_of(inc, FILTERED_SCOPE),
    "detail_table": lambda inc: X.detail_table(inc, STATS_SCOPE),
    "detail_table_page": lambda inc: X.detail_table_page(inc, STATS_SCOPE),
    "map_tiles": lambda inc: X.map_tiles(inc, STATS_SCOPE),
    # aggregates and rankings
    "coverage": lambda inc: R.coverage(inc, STATS_SCOPE.year, STATS_SCOPE.quarters),
    "partition_counts": R.partition_counts,
    "partition_coverage": R.partition_coverage,
    "period_distribution": lambda inc: R.period_distribution(_stats_of(inc)),
    "category_distribution": lambda inc: R.category_distribution(_stats_of(inc)),
    "monthly_series": lambda inc: R.monthly_series(_stats_of(inc)),
    "top_districts": lambda inc: R.top_districts(_stats_of(inc)),
    "top_brands": lambda inc: R.top_brands(_stats_of(inc)),
    "top_one": lambda inc: R.top_one(_stats_of(inc)),
    "filter_options": R.filter_options,
    # quality and run statistics
    "quality_metrics": Q.quality_metrics,
    "quality_report": Q.quality_report,
    "district_variants": Q.district_variants,
    "latest_record": Q.latest_record,
    "transform_stats": etl.transform_stats,
    "category_counts": etl.category_counts,
    "health_check": etl.health_check,
    "manifest_partitions": lake.manifest_partitions,
    "manifest_summary": lake.manifest_summary,
}


# Reports on the key table's partition counts alone: the lake is not read.
KEY_REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "default_years": R.default_years,
    "comparable_quarters": R.comparable_quarters,
    "comparison_base_year": _base_year_given,
}
# Reports of two years: the transformed rows and the comparison read from the key table.
COMPARED_REPORTS: dict[str, Callable[[DataFrame, R.Comparison | None], DataFrame]] = {
    "monthly_comparison": R.monthly_comparison,
    "district_year_counts": R.district_year_counts,
    "monthly_overlay": lambda inc, cmp: R.monthly_overlay(R.monthly_comparison(inc, cmp)),
    "category_by_year": lambda inc, cmp: R.category_by_year(R.monthly_comparison(inc, cmp)),
    "year_kpis": R.year_kpis,
    "district_variation": lambda inc, cmp: R.district_variation(R.district_year_counts(inc, cmp)),
    "district_comparison": lambda inc, cmp: R.district_comparison(R.district_year_counts(inc, cmp)),
}


# Columns of the transformed rows that each report reads; those derived from
# the tables join only what holds them.
_PLACE = (M.CIDADE, M.ANO, M.TRIMESTRE)
_PARTS = (*_PLACE, M.HAS_COORDINATES)
_COMPARED = (*_PARTS, M.MES, M.RUBRICA_MOD)
_DISTRICTS = (*_PLACE, M.HAS_COORDINATES, M.BAIRRO)
_STATS = (*X.STATS_COLUMNS, M.CIDADE)
_QUALITY = (*_PARTS, M.ANO_BO, M.NUM_BO, M.VERSAO, M.BAIRRO, M.DESCR_PERIODO, M.MARCA_OBJETO)
REPORT_COLUMNS: dict[str, tuple[str, ...]] = {
    "map_points": (*X.MAP_COLUMNS, *_PARTS),
    "map_tiles": (*X.MAP_COLUMNS, *_PARTS),
    "coverage": _PARTS,
    "partition_counts": _PARTS,
    "partition_coverage": _PARTS,
    "default_years": _PARTS,
    "comparable_quarters": _PARTS,
    "comparison_base_year": _PARTS,
    "monthly_comparison": _COMPARED,
    "monthly_overlay": _COMPARED,
    "category_by_year": _COMPARED,
    "year_kpis": _COMPARED,
    "district_year_counts": _DISTRICTS,
    "district_variation": _DISTRICTS,
    "district_comparison": _DISTRICTS,
    "filter_options": (*_PLACE, M.BAIRRO, M.RUBRICA_MOD, M.DESCR_PERIODO),
    "quality_metrics": _QUALITY,
    "quality_report": _QUALITY,
    "district_variants": (*_PLACE, M.BAIRRO, M.BAIRRO_ORIGINAL),
    "latest_record": (*_PLACE, M.DATAHORA_REGISTRO_BO),
    "transform_stats": (M.HAS_COORDINATES, M.BAIRRO),
    "category_counts": (M.RUBRICA_MOD,),
    "health_check": (M.NUM_BO,),
    "manifest_partitions": (M.ANO, M.TRIMESTRE),
    "manifest_summary": (M.ANO, M.TRIMESTRE),
}


def _from_tables(name: str, report: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report(_incidents(spark, sf_dir, *REPORT_COLUMNS.get(name, _STATS)))

    run.__doc__ = report.__doc__
    return run


def _kept_lake(spark: SparkSession, sf_dir: str, columns: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """The transformed rows as a partitioned lake, and the key table kept beside it."""
    rows = _incidents(spark, sf_dir, *columns)
    root, keys = fresh_path(spark, "transformed"), fresh_path(spark, "keys")
    lake.write_layer(rows, root)
    stored = lake.read_layer(spark, root, schema=lake.stored_schema(rows))
    lake.write_layer(R.partition_keys(stored), keys)
    return stored, R.partition_counts_from_stats(lake.read_layer(spark, keys))


def _from_keys(name: str, report: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report(_kept_lake(spark, sf_dir, REPORT_COLUMNS[name])[1])

    run.__doc__ = report.__doc__
    return run


def _from_lake(name: str, report: Callable[[DataFrame, R.Comparison | None], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows, parts = _kept_lake(spark, sf_dir, REPORT_COLUMNS[name])
        return report(rows, R.resolve_comparison(parts))

    run.__doc__ = report.__doc__
    return run


# Queries that exercise the landing scan, the lake and the derivations.
SOURCE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "landing_union": landing_union,
    "landing_directory": landing_directory,
    "landing_malformed": landing_malformed,
    "malformed_records": malformed_records,
    "harmonise_columns": harmonise_columns,
    "lake_roundtrip": lake_roundtrip,
    "schema_merge_scan": schema_merge_scan,
    "unread_values": unread_values,
    "manifest_read": manifest_read,
    "alias_source": alias_source,
    "publish_two_runs": publish_two_runs,
    "kept_statistics": kept_statistics,
    "kept_options": kept_options,
    "kept_variants": kept_variants,
    "kept_manifest": kept_manifest,
    "coord_parse": coord_parse,
    "quarter_derive": quarter_derive,
    "has_coordinates": has_coordinates,
    "category_map": category_map,
    "district_normalise": district_normalise,
    "district_alias": district_alias,
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **SOURCE_QUERIES,
    **{name: _from_tables(name, report) for name, report in REPORTS.items()},
    **{name: _from_keys(name, report) for name, report in KEY_REPORTS.items()},
    **{name: _from_lake(name, report) for name, report in COMPARED_REPORTS.items()},
}
