"""Dashboard aggregates, rankings and the year-over-year comparison.

Each report is one aggregate over the scoped rows (partial aggregation on
the map side, so a hot district or month is combined before the shuffle);
only the small results ever reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadra import model as M
from quadra.functions import columns as C
from quadra.operators import extracts as X


def _count() -> Column:
    return F.count(F.lit(1))


def _with_share(counts: DataFrame, count_col: str = "count") -> DataFrame:
    """Add each group's share of the total, in percent (one decimal).

    The total is a scalar subquery over the (already aggregated) counts, so
    no all-rows window and no cross join are needed.
    """
    total = counts.agg(F.sum(count_col)).scalar()
    return counts.withColumn("share_pct", C.percent(F.col(count_col), total))


# --- A1-A3: coverage and partitions ---------------------------------------------------
def coverage(df: DataFrame, year: int, quarters, city: str = M.CITY) -> DataFrame:
    """A1: total and geolocated rows of a year/quarters (no dimension filter)."""
    s = M.Scope(year=year, quarters=tuple(quarters), city=city)
    out = X.scope(df, s).agg(
        _count().alias("total"),
        F.count_if(F.col(M.HAS_COORDINATES)).alias("com_coordenadas"),
    )
    return out.withColumn(
        "pct_geo",
        F.coalesce(C.guarded_percent(F.col("com_coordenadas"), F.col("total")), F.lit(0.0)),
    )


def partition_counts(df: DataFrame, city: str = M.CITY) -> DataFrame:
    """A2: rows and geolocated rows per (year, quarter) of the city."""
    return (
        X.city(df, city)
        .groupBy(M.ANO, M.TRIMESTRE)
        .agg(
            _count().alias("total"),
            F.count_if(F.col(M.HAS_COORDINATES)).alias("com_coordenadas"),
        )
        .orderBy(M.ANO, M.TRIMESTRE)
    )


def partition_keys(df: DataFrame) -> DataFrame:
    """The key table: rows and geolocated rows per (year, quarter, city).

    Kept by the batch job for the partitions it rewrote, a few rows each; the
    choice of years and quarters (U2, U3) and A2 are read from it.
    """
    return df.groupBy(M.ANO, M.TRIMESTRE, M.CIDADE).agg(
        _count().alias("linhas"), F.count_if(F.col(M.HAS_COORDINATES)).alias("com_coordenadas")
    )


def partition_counts_from_stats(stats: DataFrame, city: str = M.CITY) -> DataFrame:
    """A2 from the key table, or from the statistics table (see ``quality.partition_stats``)."""
    return (
        stats.where(F.col(M.CIDADE) == city)
        .select(M.ANO, M.TRIMESTRE, F.col("linhas").alias("total"), "com_coordenadas")
        .orderBy(M.ANO, M.TRIMESTRE)
    )


def coverage_from_stats(stats: DataFrame, year: int, quarters, city: str = M.CITY) -> DataFrame:
    """A1 from the partition-statistics table; same result as :func:`coverage`."""
    if not quarters:
        raise ValueError("at least one quarter must be selected")
    out = stats.where(
        (F.col(M.CIDADE) == city) & (F.col(M.ANO) == year) & F.col(M.TRIMESTRE).isin(list(quarters))
    ).agg(
        F.coalesce(F.sum("linhas"), F.lit(0)).cast("bigint").alias("total"),
        F.coalesce(F.sum("com_coordenadas"), F.lit(0)).cast("bigint").alias("com_coordenadas"),
    )
    return out.withColumn(
        "pct_geo",
        F.coalesce(C.guarded_percent(F.col("com_coordenadas"), F.col("total")), F.lit(0.0)),
    )


def partition_coverage(df: DataFrame, city: str = M.CITY) -> DataFrame:
    """A3: A2 plus the geolocated percent."""
    return partition_counts(df, city).withColumn(
        "pct_geo", C.percent(F.col("com_coordenadas"), F.col("total"))
    )


# --- U2 / U3: which years and quarters to compare --------------------------------------
def comparison(parts: DataFrame, year_a: int | None = None, year_b: int | None = None) -> DataFrame:
    """One row: ano_base, ano_anterior and the quarters both have (lazy).

    ``parts`` has a row per (year, quarter): the partition counts of a city,
    from the lake or from the statistics table. U3: the base year is the one
    given or the newest; the compared year the one given, else base - 1 if
    present, else the newest other year (null when there is none). U2: the
    quarters are an intersection. The keys are folded into one row (a few per
    year at any data size), so the choice takes one pass over ``parts``.
    """
    one = parts.where(F.col(M.ANO).isNotNull()).agg(F.collect_set(F.struct(M.ANO, M.TRIMESTRE)).alias("keys"))
    one = one.withColumn("years", F.array_distinct(F.transform("keys", lambda k: k[M.ANO])))
    base = F.array_max("years") if year_a is None else F.lit(year_a)
    one = one.withColumn("ano_base", base.cast("int"))
    before = F.when(F.array_contains("years", F.col("ano_base") - 1), F.col("ano_base") - 1)
    other = F.array_max(F.array_remove("years", F.col("ano_base")))
    compared = F.coalesce(before, other) if year_b is None else F.lit(year_b)
    one = one.withColumn("ano_anterior", compared.cast("int"))

    def quarters(year: str) -> Column:
        own = F.transform(F.filter("keys", lambda k: k[M.ANO] == F.col(year)), lambda k: k[M.TRIMESTRE])
        return F.array_compact(own)

    common = F.array_sort(F.array_intersect(quarters("ano_base"), quarters("ano_anterior")))
    return one.select("ano_base", "ano_anterior", common.alias("trimestres"))


def default_years(parts: DataFrame) -> DataFrame:
    """The years compared when the user picks none."""
    return comparison(parts).select("ano_base", "ano_anterior")


def comparable_quarters(parts: DataFrame, year_a: int | None = None, year_b: int | None = None) -> DataFrame:
    """Quarters present in both years."""
    return comparison(parts, year_a, year_b).select(F.explode("trimestres").alias(M.TRIMESTRE))


@dataclass(frozen=True)
class Comparison:
    year_a: int
    year_b: int
    quarters: tuple[int, ...]


def resolve_comparison(parts: DataFrame, year_a: int | None = None, year_b: int | None = None) -> Comparison | None:
    """The row of :func:`comparison` on the driver; None when no two years share a quarter.

    Give it the statistics table's partition counts: with known years and
    quarters the reports' filters are static and prune partitions.
    """
    row = comparison(parts, year_a, year_b).first()
    if row["ano_anterior"] is None or not row["trimestres"]:
        return None
    return Comparison(row["ano_base"], row["ano_anterior"], tuple(row["trimestres"]))


# Role of a compared row: in the base year, or in the year it is compared with.
ROLE = "papel"


def compared_rows(df: DataFrame, cmp: Comparison | DataFrame | None, city: str = M.CITY) -> DataFrame:
    """F1 + F3: the city's rows of both years and the common quarters, with their ``ROLE``.

    ``cmp`` is what :func:`resolve_comparison` read from the key table: static
    filters on the partition columns (None: no two years share a quarter, no
    rows). Without that table it is the one-row frame of :func:`comparison`: then
    the rows are joined to its (year, quarter) pairs, eight at most, so that
    partitions are pruned at run time and nothing runs before the report does.
    """
    if cmp is None:
        return X.city(df, city).where(F.lit(False)).withColumn(ROLE, F.lit("base"))
    if isinstance(cmp, Comparison):
        rows = X.year_scope(df, (cmp.year_a, cmp.year_b), cmp.quarters, city)
        return rows.withColumn(ROLE, F.when(F.col(M.ANO) == cmp.year_a, "base").otherwise("anterior"))
    roles = F.array(
        F.struct(F.lit("base").alias(ROLE), F.col("ano_base").alias(M.ANO)),
        F.struct(F.lit("anterior").alias(ROLE), F.col("ano_anterior").alias(M.ANO)),
    )
    pairs = cmp.select(F.inline(roles), "trimestres").select(ROLE, M.ANO, F.explode("trimestres").alias(M.TRIMESTRE))
    return X.city(df, city).join(F.broadcast(pairs), [M.ANO, M.TRIMESTRE])


# --- A4 / A5 and what is derived from them -------------------------------------------
def _monthly(df: DataFrame, cmp: Comparison | DataFrame | None, city: str) -> DataFrame:
    return (
        compared_rows(df, cmp, city)
        .groupBy(ROLE, M.ANO, M.MES, M.RUBRICA_MOD)
        .agg(
            _count().alias("total"),
            F.count_if(F.col(M.HAS_COORDINATES)).alias("com_coordenadas"),
        )
    )


def monthly_comparison(df: DataFrame, cmp: Comparison | DataFrame | None, city: str = M.CITY) -> DataFrame:
    """A4: rows and geolocated rows per (year, month, category) of both years."""
    return _monthly(df, cmp, city).drop(ROLE).orderBy(M.ANO, M.MES)


def district_year_counts(df: DataFrame, cmp: Comparison | DataFrame | None, city: str = M.CITY) -> DataFrame:
    """A5: per district, rows in the base year and in the compared year."""
    return (
        compared_rows(df, cmp, city)
        .where(X.non_blank(M.BAIRRO))
        .groupBy(M.BAIRRO)
        .agg(
            F.count_if(F.col(ROLE) == "base").alias("total_atual"),
            F.count_if(F.col(ROLE) == "anterior").alias("total_anterior"),
        )
        .orderBy(F.col("total_atual").desc())
    )


def monthly_overlay(monthly: DataFrame) -> DataFrame:
    """A4 re-aggregated over category — rows per (year, month)."""
    return (
        monthly.groupBy(M.ANO, M.MES)
        .agg(F.sum("total").cast("bigint").alias("total"))
        .orderBy(M.ANO, M.MES)
    )


def category_by_year(monthly: DataFrame) -> DataFrame:
    """A4 re-aggregated over month — rows per (year, category)."""
    return (
        monthly.groupBy(M.ANO, M.RUBRICA_MOD)
        .agg(F.sum("total").cast("bigint").alias("total"))
        .orderBy(M.ANO, M.RUBRICA_MOD)
    )


def year_kpis(df: DataFrame, cmp: Comparison | DataFrame | None, city: str = M.CITY) -> DataFrame:
    """Totals, robberies, thefts and coverage of both years, with deltas.

    One row. Percent changes are null when the compared year has none; the
    coverage change is in percentage points.
    """
    def total_of(role: str, cat: str | None = None, col: str = "total") -> Column:
        cond = F.col(ROLE) == role
        if cat is not None:
            cond = cond & (F.col(M.RUBRICA_MOD) == cat)
        return F.coalesce(F.sum(F.when(cond, F.col(col))), F.lit(0)).cast("bigint")

    a, b = "base", "anterior"
    k = _monthly(df, cmp, city).agg(
        total_of(a).alias("total_atual"),
        total_of(b).alias("total_anterior"),
        total_of(a, "Roubo").alias("roubos_atual"),
        total_of(b, "Roubo").alias("roubos_anterior"),
        total_of(a, "Furto").alias("furtos_atual"),
        total_of(b, "Furto").alias("furtos_anterior"),
        total_of(a, col="com_coordenadas").alias("coords_atual"),
        total_of(b, col="com_coordenadas").alias("coords_anterior"),
    )

    def geo(coords: str, total: str) -> Column:
        return F.when(
            F.col(total) > 0, F.col(coords).cast("double") / F.col(total) * F.lit(100)
        ).otherwise(F.lit(0.0))

    return k.select(
        "*",
        C.guarded_percent_change(F.col("total_atual"), F.col("total_anterior")).alias("delta_total_pct"),
        C.guarded_percent_change(F.col("roubos_atual"), F.col("roubos_anterior")).alias("delta_roubos_pct"),
        C.guarded_percent_change(F.col("furtos_atual"), F.col("furtos_anterior")).alias("delta_furtos_pct"),
        F.bround(geo("coords_atual", "total_atual"), 1).alias("pct_geo_atual"),
        F.bround(geo("coords_anterior", "total_anterior"), 1).alias("pct_geo_anterior"),
        F.bround(
            geo("coords_atual", "total_atual") - geo("coords_anterior", "total_anterior"), 1
        ).alias("delta_geo_pp"),
    )


def district_variation(counts: DataFrame, n: int = M.TOP_VARIATION,
                       min_previous: int = M.MIN_PREVIOUS_COUNT) -> DataFrame:
    """K4 + F8 + P14: the ``n`` largest absolute changes among districts with
    at least ``min_previous`` rows in the compared year, ordered by change."""
    delta = F.col("total_atual") - F.col("total_anterior")
    top = (
        counts.where(F.col("total_anterior") >= min_previous)
        .withColumn("delta", delta)
        .withColumn("delta_pct", C.percent(F.col("delta"), F.col("total_anterior")))
        .withColumn("direcao", C.direction(F.col("delta")))
        .orderBy(F.abs(F.col("delta")).desc(), F.col(M.BAIRRO).asc())
        .limit(n)
    )
    return top.orderBy("delta", M.BAIRRO)


def district_comparison(counts: DataFrame) -> DataFrame:
    """K5 + P15: every district with change and guarded percent change."""
    return (
        counts.withColumn("delta", F.col("total_atual") - F.col("total_anterior"))
        .withColumn(
            "delta_pct",
            C.guarded_percent_change(F.col("total_atual"), F.col("total_anterior")),
        )
        .orderBy(F.col("total_atual").desc(), F.col(M.BAIRRO).asc())
    )


# --- A10-A12, K1-K3: reports over the statistics extract ---------------------------------
def _ranked(counts: DataFrame, key: str, n: int) -> DataFrame:
    """Top-``n`` by count (ties by name), then re-sorted ascending for the bar chart."""
    top = counts.orderBy(F.col("count").desc(), F.col(key).asc()).limit(n)
    return top.orderBy(F.col("count").asc(), F.col(key).desc())


def top_districts(stats: DataFrame, n: int = M.TOP_DISTRICTS) -> DataFrame:
    """K1 + F6: the ``n`` districts with most rows."""
    counts = stats.where(X.non_blank(M.BAIRRO)).groupBy(M.BAIRRO).agg(_count().alias("count"))
    return _ranked(counts, M.BAIRRO, n)


def top_brands(stats: DataFrame, n: int = M.TOP_BRANDS) -> DataFrame:
    """K2: the ``n`` brands with most rows; the ``'NULL'`` text is ranked too."""
    counts = (
        stats.where(X.non_blank(M.MARCA_OBJETO))
        .groupBy(M.MARCA_OBJETO)
        .agg(_count().alias("count"))
    )
    return _ranked(counts, M.MARCA_OBJETO, n)


def top_one(stats: DataFrame) -> DataFrame:
    """K3: the top district (non-blank) and top period (``'NULL'`` out, ``''``
    kept), one row per dimension; ties go to the smaller name.

    One scan: each row is unpivoted into its (dimension, value) pairs — a
    value that does not qualify becomes null and is dropped — then counted
    per pair and reduced to the best pair per dimension.
    """
    district = F.when(X.non_blank(M.BAIRRO), F.col(M.BAIRRO))
    period = F.when(X.known_period(), F.col(M.DESCR_PERIODO))
    pairs = stats.select(
        F.inline(
            F.array(
                F.struct(F.lit(M.BAIRRO).alias("dimension"), district.alias("value")),
                F.struct(F.lit(M.DESCR_PERIODO).alias("dimension"), period.alias("value")),
            )
        )
    ).where(F.col("value").isNotNull())
    counts = pairs.groupBy("dimension", "value").agg(_count().alias("count"))
    pick = F.struct((-F.col("count")).alias("n"), F.col("value").alias("k"))
    return counts.groupBy("dimension").agg(
        F.min_by(F.col("value"), pick).alias("value"),
        F.max("count").alias("count"),
    )


def period_distribution(stats: DataFrame) -> DataFrame:
    """A10 + F7: rows per known, non-blank period with its share."""
    counts = (
        stats.where(X.known_period() & (F.col(M.DESCR_PERIODO) != ""))
        .groupBy(M.DESCR_PERIODO)
        .agg(_count().alias("count"))
    )
    return _with_share(counts).orderBy(F.col("count").desc(), M.DESCR_PERIODO)


def category_distribution(stats: DataFrame) -> DataFrame:
    """Rows per category (null kept) with its share."""
    counts = stats.groupBy(M.RUBRICA_MOD).agg(_count().alias("count"))
    return _with_share(counts).orderBy(F.col("count").desc(), M.RUBRICA_MOD)


def monthly_series(stats: DataFrame) -> DataFrame:
    """A12 + P10: rows per (year, month) with a ``YYYY-MM`` label."""
    return (
        stats.groupBy(M.ANO, M.MES)
        .agg(_count().alias("count"))
        .withColumn("MES_ANO", C.month_label(F.col(M.ANO), F.col(M.MES)))
        .orderBy(M.ANO, M.MES)
    )


# --- A17 / U4: filter options ------------------------------------------------------------
OPTION_NAMES = ("anos", "trimestres", "bairros", "tipos_crime", "periodos")


def filter_options(df: DataFrame, city: str = M.CITY) -> DataFrame:
    """A17 + U4: the widget options in long form ``(option, value)``.

    One pass: each row is unpivoted into its five (option, value) pairs and
    de-duplicated with a partial aggregate, so the distinct values never
    gather in one task. Nulls are dropped, and ``'NULL'`` for periods.
    """
    def pair(option: str, value: Column) -> Column:
        return F.struct(F.lit(option).alias("option"), value.cast("string").alias("value"))

    pairs = X.city(df, city).select(
        F.inline(
            F.array(
                pair("anos", F.col(M.ANO)),
                pair("trimestres", F.col(M.TRIMESTRE)),
                pair("bairros", F.col(M.BAIRRO)),
                pair("tipos_crime", F.col(M.RUBRICA_MOD)),
                pair("periodos", F.col(M.DESCR_PERIODO)),
            )
        )
    )
    kept = pairs.where(
        F.col("value").isNotNull()
        & ~((F.col("option") == "periodos") & (F.col("value") == M.NULL_TEXT))
    )
    return kept.distinct()


# Marker option of a (year, quarter, city) that has rows at all.
_PRESENT = "_partition"


def option_values(df: DataFrame) -> DataFrame:
    """A17 kept incrementally: distinct option values per (year, quarter, city).

    Written next to the transformed layer by the batch job for the partitions
    it rewrote, this table is a few rows per partition, so the widget options
    come from it instead of a scan of the whole lake on every page load.
    """
    def pair(option: str, value: Column) -> Column:
        return F.struct(F.lit(option).alias("option"), value.cast("string").alias("value"))

    sources = {"bairros": M.BAIRRO, "tipos_crime": M.RUBRICA_MOD, "periodos": M.DESCR_PERIODO}
    present = [pair(opt, F.col(c)) for opt, c in sources.items() if c in df.columns]
    pairs = df.select(
        M.ANO,
        M.TRIMESTRE,
        M.CIDADE,
        F.inline(F.array(pair(_PRESENT, F.lit(None)), *present)),
    )
    return pairs.where(F.col("value").isNotNull() | (F.col("option") == _PRESENT)).distinct()


def filter_options_from_values(values: DataFrame, city: str = M.CITY) -> DataFrame:
    """A17 from the option-values table; same result as :func:`filter_options`."""
    scoped = values.where(F.col(M.CIDADE) == city)
    keys = scoped.where(F.col("option") == _PRESENT)
    years = keys.select(F.lit("anos").alias("option"), F.col(M.ANO).cast("string").alias("value"))
    quarters = keys.select(F.lit("trimestres").alias("option"), F.col(M.TRIMESTRE).cast("string").alias("value"))
    others = scoped.where(
        (F.col("option") != _PRESENT)
        & ~((F.col("option") == "periodos") & (F.col("value") == M.NULL_TEXT))
    ).select("option", "value")
    return years.unionByName(quarters).unionByName(others).where(F.col("value").isNotNull()).distinct()


def filter_options_dict(df: DataFrame) -> dict[str, list]:
    """A17 as the widgets want it: sorted lists (years newest first)."""
    out: dict[str, list] = {k: [] for k in OPTION_NAMES}
    for r in filter_options(df).collect():
        out[r["option"]].append(r["value"])
    out["anos"] = sorted((int(v) for v in out["anos"]), reverse=True)
    out["trimestres"] = sorted(int(v) for v in out["trimestres"])
    for k in ("bairros", "tipos_crime", "periodos"):
        out[k] = sorted(out[k])
    return out
