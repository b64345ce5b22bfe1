"""Row-level extracts and their filters.

Filters are built as Columns, never as SQL text, so a list of user values
needs no quoting and year/quarter predicates reach the lake scan as
partition filters.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quadra import model as M

MAP_COLUMNS = (
    M.LATITUDE,
    M.LONGITUDE,
    M.RUBRICA_MOD,
    M.BAIRRO,
    M.DESCR_PERIODO,
    M.LOGRADOURO,
    M.NUM_BO,
    M.DATA_OCORRENCIA_BO,
    M.MARCA_OBJETO,
)
STATS_COLUMNS = (
    M.NUM_BO,
    M.DATA_OCORRENCIA_BO,
    M.DESCR_PERIODO,
    M.RUBRICA,
    M.RUBRICA_MOD,
    M.BAIRRO,
    M.LOGRADOURO,
    M.MARCA_OBJETO,
    M.HAS_COORDINATES,
    M.MES,
    M.ANO,
    M.TRIMESTRE,
)
DETAIL_COLUMNS = (
    M.NUM_BO,
    M.DATA_OCORRENCIA_BO,
    M.DESCR_PERIODO,
    M.RUBRICA_MOD,
    M.BAIRRO,
    M.LOGRADOURO,
    M.MARCA_OBJETO,
)
# --- fixed values (must equal the reference's) ------------------------------
# Headings of the detail table as the page shows it.
DETAIL_HEADINGS = ("BO", "Data", "Período", "Tipo", "Bairro", "Logradouro", "Marca")
# Zoom level the map opens at.
MAP_ZOOM = 11


# --- filters -----------------------------------------------------------------------
def city(df: DataFrame, name: str = M.CITY) -> DataFrame:
    """the city every dashboard query is limited to."""
    return df.where(F.col(M.CIDADE) == name)


def non_blank(c: str) -> Column:
    """present and not the empty string."""
    return F.col(c).isNotNull() & (F.col(c) != "")


def known_period() -> Column:
    """period present and not the source's ``'NULL'`` placeholder."""
    return F.col(M.DESCR_PERIODO).isNotNull() & (F.col(M.DESCR_PERIODO) != M.NULL_TEXT)


def _isin(c: str, values) -> Column | None:
    return F.col(c).isin(list(values)) if values else None


def scope(df: DataFrame, s: M.Scope) -> DataFrame:
    """F1 + F2 + F4: city, year, quarters, then optional dimension lists.

    An empty or missing dimension list adds no predicate at all.
    """
    cond = (
        (F.col(M.CIDADE) == s.city)
        & (F.col(M.ANO) == s.year)
        & F.col(M.TRIMESTRE).isin(list(s.quarters))
    )
    for extra in (
        _isin(M.BAIRRO, s.districts),
        _isin(M.RUBRICA_MOD, s.categories),
        _isin(M.DESCR_PERIODO, s.periods),
    ):
        if extra is not None:
            cond = cond & extra
    return df.where(cond)


def year_scope(df: DataFrame, years, quarters, name: str = M.CITY) -> DataFrame:
    """F1 + F3: city, a set of years and the quarters to compare.

    ``quarters`` is a list (a static partition filter).
    """
    if not quarters:
        raise ValueError("at least one quarter must be selected")
    return df.where(
        (F.col(M.CIDADE) == name)
        & F.col(M.ANO).isin(list(years))
        & F.col(M.TRIMESTRE).isin(list(quarters))
    )


# --- extracts ------------------------------------------------------------------------
def map_points(df: DataFrame, s: M.Scope) -> DataFrame:
    """The map's rows — scope plus only rows with coordinates."""
    return scope(df, s).where(F.col(M.HAS_COORDINATES)).select(*MAP_COLUMNS)


def stats_extract(df: DataFrame, s: M.Scope) -> DataFrame:
    """Every row in scope (no coordinate filter), 12 columns."""
    return scope(df, s).select(*STATS_COLUMNS)


def _newest_first(nulls_first: bool) -> list[Column]:
    date = F.col(M.DATA_OCORRENCIA_BO)
    first = date.desc_nulls_first() if nulls_first else date.desc_nulls_last()
    rest = [F.col(c).asc_nulls_last() for c in DETAIL_COLUMNS if c != M.DATA_OCORRENCIA_BO]
    return [first, *rest]


# Groups of tasks whose newest rows are merged before the last merge.
_MERGE_GROUPS = 256


def _newest(df: DataFrame, s: M.Scope, n: int, nulls_first: bool) -> DataFrame:
    """The ``n`` newest rows, lazily and in one scan.

    A staged top-k: every task keeps its ``n`` best rows (Spark limits a
    ranked group before the shuffle), groups of tasks merge to ``n`` each,
    and the last merge sees ``n`` rows of each group, however many tasks read
    the scope.
    """
    rows, order = stats_extract(df, s).select(*DETAIL_COLUMNS), _newest_first(nulls_first)
    group = W.partitionBy(F.pmod(F.spark_partition_id(), F.lit(_MERGE_GROUPS))).orderBy(*order)
    best = rows.withColumn("_place", F.row_number().over(group)).where(F.col("_place") <= n)
    return best.drop("_place").orderBy(*order).limit(n)


def detail_table(df: DataFrame, s: M.Scope, n: int = M.DETAIL_ROWS) -> DataFrame:
    """Newest ``n`` rows (undated rows last), ties broken by every column."""
    return _newest(df, s, n, nulls_first=False)


def detail_table_page(df: DataFrame, s: M.Scope, n: int = M.DETAIL_ROWS) -> DataFrame:
    """The page's table — undated rows first, display headings."""
    return _newest(df, s, n, nulls_first=True).toDF(*DETAIL_HEADINGS)


# Latitude at which the square web-mercator map ends.
MAX_LATITUDE = 85.0511


def on_map(lat: Column, lon: Column) -> Column:
    """Whether a point lies on the map."""
    return (F.abs(lat) <= MAX_LATITUDE) & (F.abs(lon) <= 180)


def tile_xy(lat: Column, lon: Column, zoom: int) -> tuple[Column, Column]:
    """Web-mercator tile of a point at ``zoom``."""
    scale = float(2**zoom)
    x = F.floor((lon + F.lit(180.0)) / F.lit(360.0) * F.lit(scale))
    y = F.floor(
        (F.lit(1.0) - F.asinh(F.tan(F.radians(lat))) / F.lit(math.pi)) / F.lit(2.0) * F.lit(scale)
    )
    return x.cast("bigint"), y.cast("bigint")


def map_tiles(df: DataFrame, s: M.Scope, zoom: int = MAP_ZOOM) -> DataFrame:
    """X5 (re-aimed map clusters): points per map tile, with the tile's centroid.

    Instead of handing every point to the browser, points are grouped per
    tile on the cluster; the output grows with the map area, not the rows.
    Points off the map (garbage coordinates) are counted in one row without a
    tile.
    """
    lat, lon = F.col(M.LATITUDE), F.col(M.LONGITUDE)
    pts = map_points(df, s)
    x, y = tile_xy(lat, lon, zoom)
    n = F.count(F.lit(1))
    inside = on_map(lat, lon)
    return (
        pts.select(
            F.when(inside, x).alias("tile_x"),
            F.when(inside, y).alias("tile_y"),
            *[F.when(inside, F.col(c)).alias(c) for c in (M.LATITUDE, M.LONGITUDE)],
        )
        .groupBy("tile_x", "tile_y")
        .agg(
            n.alias("points"),
            _centroid(M.LATITUDE, n).alias("mean_lat"),
            _centroid(M.LONGITUDE, n).alias("mean_lon"),
        )
        .withColumn("zoom", F.lit(zoom))
    )


def _centroid(c: str, n: Column) -> Column:
    """Mean of a coordinate at micro-degree precision.

    Coordinates are summed as whole micro-degrees in decimals (exact, and no
    number of points overflows), so the result does not depend on the order
    partial sums are combined in.
    """
    micro = F.sum(F.round(F.col(c) * F.lit(1_000_000.0)).cast("decimal(12,0)"))
    return F.bround(micro.cast("double") / n, 0) / F.lit(1_000_000.0)
