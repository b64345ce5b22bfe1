"""The dashboard's pages as bundles of lazy reports.

Each function returns the DataFrames one page of the dashboard shows, all
over the transformed lake; nothing runs until the caller collects a result
(every result is an aggregate or a capped table, except the map's points,
which a caller should turn into tiles or write out). Pass the batch job's
partition-statistics table as ``stats`` to read the per-partition counts
from it instead of the lake.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadra import model as M
from quadra.functions import columns as C
from quadra.operators import extracts as X
from quadra.operators import quality as Q
from quadra.operators import reports as R


def _coverage(inc: DataFrame, scope: M.Scope, stats: DataFrame | None) -> DataFrame:
    if stats is not None:
        return R.coverage_from_stats(stats, scope.year, scope.quarters, scope.city)
    return R.coverage(inc, scope.year, scope.quarters, scope.city)


def map_page(inc: DataFrame, scope: M.Scope, stats: DataFrame | None = None) -> dict[str, DataFrame]:
    """Map: geolocated points (X1), their tiles (X5) and the coverage note (A1)."""
    return {
        "points": X.map_points(inc, scope),
        "tiles": X.map_tiles(inc, scope),
        "coverage": _coverage(inc, scope, stats),
    }


def statistics_page(inc: DataFrame, scope: M.Scope, stats: DataFrame | None = None) -> dict[str, DataFrame]:
    """Statistics: KPIs, the five charts and the detail table."""
    extract = X.stats_extract(inc, scope)
    return {
        "total": extract.agg(F.count(F.lit(1)).alias("total_bos")),
        "top_one": R.top_one(extract),
        "coverage": _coverage(inc, scope, stats),
        "top_districts": R.top_districts(extract),
        "period_distribution": R.period_distribution(extract),
        "category_distribution": R.category_distribution(extract),
        "top_brands": R.top_brands(extract),
        "monthly_series": R.monthly_series(extract),
        "detail_table": X.detail_table_page(inc, scope),
    }


def comparison_page(inc: DataFrame, year_a: int | None = None, year_b: int | None = None,
                    stats: DataFrame | None = None, city: str = M.CITY) -> dict[str, DataFrame] | None:
    """Year over year: picks the years and common quarters (U2/U3), then the
    KPIs, monthly overlay, district variation, categories and full table
    (A4/A5, A13-A15, K4/K5). A base year that is given stays; only what is
    missing is defaulted.

    With the partition-statistics table the choice is read from it, and the
    page is None when no two years share a quarter. Without it nothing runs
    here: the choice is part of the reports' plans, which are then empty.
    """
    if stats is not None:
        cmp = R.resolve_comparison(R.partition_counts_from_stats(stats, city), year_a, year_b)
        if cmp is None:
            return None
    else:
        cmp = R.comparison(R.partition_counts(inc, city), year_a, year_b)
    monthly = R.monthly_comparison(inc, cmp, city)
    districts = R.district_year_counts(inc, cmp, city)
    return {
        "kpis": R.year_kpis(inc, cmp, city),
        "monthly_overlay": R.monthly_overlay(monthly),
        "district_variation": R.district_variation(districts),
        "category_by_year": R.category_by_year(monthly),
        "district_table": R.district_comparison(districts),
    }


def quality_page(inc: DataFrame, stats: DataFrame | None = None, spellings: DataFrame | None = None,
                 city: str = M.CITY) -> dict[str, DataFrame | None]:
    """Data quality: partitions with coverage (A2/A3), completeness (A6/A7),
    spelling variants (A8), the newest registration (A9) and the landing texts
    that could not be read; a report whose columns the lake lacks is None
    ("not available"). With the batch job's partition-statistics table (and
    the spelling-pairs table for the variants), those tables are read instead
    of the lake."""
    if stats is not None:
        counts = R.partition_counts_from_stats(stats, city)
        partitions = counts.withColumn("pct_geo", C.percent(F.col("com_coordenadas"), F.col("total")))
        completeness = Q.quality_report_from_stats(stats, city)
        latest = Q.latest_record_from_stats(stats, city)
    else:
        partitions, completeness = R.partition_coverage(inc, city), Q.quality_report(inc, city)
        latest = Q.latest_record(inc, city)
    return {
        "partitions": partitions,
        "completeness": completeness,
        "variants": (
            Q.district_variants_from_pairs(spellings, city) if spellings is not None
            else Q.district_variants(inc, city=city)
        ),
        "latest_record": latest,
        "unread_values": Q.unread_values(inc),
    }
