"""Data-quality reports (A6-A9): problems are counted, never filtered out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadra import model as M
from quadra.functions import columns as C
from quadra.operators import extracts as X


def _has(df: DataFrame, *cols: str) -> bool:
    """Trap 20: a column absent from every file means "not available"."""
    return all(c in df.columns for c in cols)


def report_key() -> F.Column:
    """Null-safe ``year/number`` key of a report."""
    return F.concat_ws(
        "/",
        F.coalesce(F.col(M.ANO_BO).cast("string"), F.lit("")),
        F.coalesce(F.col(M.NUM_BO), F.lit("")),
    )


_METRIC_COLUMNS = (M.ANO_BO, M.NUM_BO, M.VERSAO, M.BAIRRO, M.DESCR_PERIODO, M.MARCA_OBJETO)
METRICS = ("linhas", "bos_unicos", "linhas_versao_maior_1", "com_coordenadas",
           "bairro_vazio", "periodo_nulo", "marca_vazia")


def _metrics() -> list[F.Column]:
    blank = lambda c, *more: F.col(c).isNull() | F.col(c).isin("", *more)
    return [
        F.count(F.lit(1)).alias("linhas"),
        F.count_distinct(report_key()).alias("bos_unicos"),
        F.count_if(C.safe_int(F.col(M.VERSAO)) > 1).alias("linhas_versao_maior_1"),
        F.count_if(F.col(M.HAS_COORDINATES)).alias("com_coordenadas"),
        F.count_if(blank(M.BAIRRO)).alias("bairro_vazio"),
        F.count_if(
            F.col(M.DESCR_PERIODO).isNull() | (F.col(M.DESCR_PERIODO) == M.NULL_TEXT)
        ).alias("periodo_nulo"),
        F.count_if(blank(M.MARCA_OBJETO, M.NULL_TEXT)).alias("marca_vazia"),
    ]


def quality_metrics(df: DataFrame, city: str = M.CITY) -> DataFrame | None:
    """Completeness metrics per (year, quarter) of the city, one pass.

    The distinct report count is planned by Spark as a two-level aggregate
    keyed by (year, quarter, report key), so one huge partition spreads over
    many tasks instead of collecting its keys in one.
    """
    if not _has(df, *_METRIC_COLUMNS):
        return None
    return X.city(df, city).groupBy(M.ANO, M.TRIMESTRE).agg(*_metrics()).orderBy(M.ANO, M.TRIMESTRE)


def partition_stats(df: DataFrame) -> DataFrame | None:
    """A2 + A6 kept incrementally: the metrics per (year, quarter, city).

    Every metric is exact per group (a report key never spans two lake
    partitions' groups), so the batch job can store this table for the
    partitions it rewrote, and the quality and comparison pages read a few
    rows per partition instead of the lake. The newest registration date of
    the group (A9) is kept too.
    """
    if not _has(df, *_METRIC_COLUMNS):
        return None
    extra = []
    if _has(df, M.DATAHORA_REGISTRO_BO):
        extra.append(F.max(C.safe_date(F.col(M.DATAHORA_REGISTRO_BO))).alias("ultima"))
    return df.groupBy(M.ANO, M.TRIMESTRE, M.CIDADE).agg(*_metrics(), *extra)


def quality_metrics_from_stats(stats: DataFrame, city: str = M.CITY) -> DataFrame:
    """A6 from the partition-statistics table; same result as :func:`quality_metrics`."""
    return (
        stats.where(F.col(M.CIDADE) == city)
        .select(M.ANO, M.TRIMESTRE, *METRICS)
        .orderBy(M.ANO, M.TRIMESTRE)
    )


def latest_record_from_stats(stats: DataFrame, city: str = M.CITY) -> DataFrame | None:
    """A9 from the partition-statistics table; None when it lacks the date."""
    if "ultima" not in stats.columns:
        return None
    return stats.where(F.col(M.CIDADE) == city).agg(F.max("ultima").alias("ultima"))


def _report(m: DataFrame) -> DataFrame:
    lines = F.col("linhas")
    return m.select(
        M.ANO,
        M.TRIMESTRE,
        "linhas",
        "bos_unicos",
        (lines - F.col("bos_unicos")).alias("linhas_excedentes"),
        C.percent(F.col("bairro_vazio"), lines).alias("pct_bairro_vazio"),
        C.percent(F.col("periodo_nulo"), lines).alias("pct_periodo_nulo"),
        C.percent(F.col("marca_vazia"), lines).alias("pct_marca_vazia"),
    )


def quality_report(df: DataFrame, city: str = M.CITY) -> DataFrame | None:
    """A6 with excess rows (versions) and three percents."""
    m = quality_metrics(df, city)
    return None if m is None else _report(m)


def quality_report_from_stats(stats: DataFrame, city: str = M.CITY) -> DataFrame:
    """A7 from the partition-statistics table."""
    return _report(quality_metrics_from_stats(stats, city))


def district_variants(df: DataFrame, n: int = M.TOP_VARIANTS, city: str = M.CITY) -> DataFrame | None:
    """A8 + F9: canonical districts that unify more than one spelling.

    Rows are first reduced to distinct (canonical, original) pairs with their
    counts — a map-side combined aggregate — so the second aggregate only sees
    one row per spelling, however many reports a hot district has.
    """
    if not _has(df, M.BAIRRO, M.BAIRRO_ORIGINAL):
        return None
    pairs = (
        X.city(df, city)
        .where(X.non_blank(M.BAIRRO))
        .groupBy(M.BAIRRO, M.BAIRRO_ORIGINAL)
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    return _variants(pairs, n)


def spelling_pairs(df: DataFrame) -> DataFrame | None:
    """A8 kept incrementally: rows per (year, quarter, city, name, spelling).

    One row per distinct spelling of a name in a partition — small next to
    the lake — stored by the batch job for the partitions it rewrote. Rows without
    a name are counted under null, so that every partition has a row that
    replaces what it held.
    """
    if not _has(df, M.BAIRRO, M.BAIRRO_ORIGINAL):
        return None
    named = {c: F.when(X.non_blank(M.BAIRRO), F.col(c)) for c in (M.BAIRRO, M.BAIRRO_ORIGINAL)}
    return (
        df.select(M.ANO, M.TRIMESTRE, M.CIDADE, *[c.alias(name) for name, c in named.items()])
        .groupBy(M.ANO, M.TRIMESTRE, M.CIDADE, M.BAIRRO, M.BAIRRO_ORIGINAL)
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def district_variants_from_pairs(pairs: DataFrame, city: str = M.CITY,
                                 n: int = M.TOP_VARIANTS) -> DataFrame:
    """A8 from the spelling-pairs table; same result as :func:`district_variants`."""
    merged = (
        pairs.where((F.col(M.CIDADE) == city) & F.col(M.BAIRRO).isNotNull())
        .groupBy(M.BAIRRO, M.BAIRRO_ORIGINAL)
        .agg(F.sum("rows").alias("_rows"))
    )
    return _variants(merged, n)


def _variants(pairs: DataFrame, n: int) -> DataFrame:
    """The ``n`` names with most spellings are picked first, from counts alone;
    only their spellings (a broadcast of ``n`` names) are then listed. Both
    steps need the same columns of ``pairs``, so its exchange is made once: an
    inner join, for a semi join would be moved below the aggregate of the pairs
    and that made twice; null-safe, so that no filter is added to one side."""
    counts = (F.count(M.BAIRRO_ORIGINAL).alias("variantes"), F.sum("_rows").cast("bigint").alias("total_bos"))
    order = (F.col("variantes").desc(), F.col("total_bos").desc(), F.col(M.BAIRRO).asc())
    top = pairs.groupBy(M.BAIRRO).agg(*counts).where(F.col("variantes") > 1).orderBy(*order).limit(n)
    spellings = F.array_join(F.sort_array(F.collect_list(M.BAIRRO_ORIGINAL)), " | ").alias("exemplos")
    names = F.broadcast(top.select(F.col(M.BAIRRO).alias("_top")))
    listed = pairs.join(names, F.col(M.BAIRRO).eqNullSafe(F.col("_top"))).groupBy(M.BAIRRO).agg(*counts, spellings)
    return listed.select(M.BAIRRO, "variantes", "exemplos", "total_bos").orderBy(*order)


def unread_values(df: DataFrame) -> DataFrame | None:
    """Landing texts that a typed column could not hold: rows per (year, column).

    The texts themselves stay in the layer (``UNREAD``)."""
    if not _has(df, M.UNREAD):
        return None
    lost = F.from_json(M.UNREAD, "map<string,string>")
    return (
        df.where(F.col(M.UNREAD).isNotNull())
        .select(M.ANO, F.explode(F.map_keys(lost)).alias("coluna"))
        .groupBy(M.ANO, "coluna")
        .agg(F.count(F.lit(1)).alias("linhas"))
    )


def latest_record(df: DataFrame, city: str = M.CITY) -> DataFrame | None:
    """Date of the newest registration in the city (null when none)."""
    if not _has(df, M.DATAHORA_REGISTRO_BO):
        return None
    return X.city(df, city).agg(F.max(C.safe_date(F.col(M.DATAHORA_REGISTRO_BO))).alias("ultima"))
