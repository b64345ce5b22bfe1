"""Reports on small hand-made incident frames (edge cases the tables lack)."""

from __future__ import annotations

import pytest

from quadra import model as M
from quadra.operators import extracts as X
from quadra.operators import quality as Q
from quadra.operators import reports as R

COLS = ("NUM_BO string, ANO int, TRIMESTRE int, MES int, CIDADE string, BAIRRO string, "
        "RUBRICA_MOD string, DESCR_PERIODO string, MARCA_OBJETO string, HAS_COORDINATES boolean")


def _rows(spark, rows):
    return spark.createDataFrame(rows, COLS)


def _inc(n, ano, tri, mes, bairro, cat="Roubo", period="A noite", brand="X", geo=True, city="S.PAULO"):
    return [(f"{ano}-{bairro}-{i}", ano, tri, mes, city, bairro, cat, period, brand, geo) for i in range(n)]


def test_scope_refuses_empty_quarters():
    with pytest.raises(ValueError):
        M.Scope(year=2024, quarters=())


def test_scope_optional_lists(spark):
    df = _rows(spark, _inc(2, 2024, 1, 1, "A") + _inc(3, 2024, 1, 2, "B", cat="Furto")
               + _inc(1, 2024, 1, 2, "B", city="OUTRA"))
    s = M.Scope(year=2024, quarters=(1,), districts=(), categories=None)
    assert X.scope(df, s).count() == 5
    s = M.Scope(year=2024, quarters=(1,), districts=("B", "O'BRIEN"), categories=("Furto",))
    assert X.scope(df, s).count() == 3


def test_top_k_ties_broken_by_name(spark):
    df = _rows(spark, _inc(2, 2024, 1, 1, "B") + _inc(2, 2024, 1, 1, "A") + _inc(1, 2024, 1, 1, "C")
               + _inc(5, 2024, 1, 1, "") + _inc(5, 2024, 1, 1, None))
    out = [(r[M.BAIRRO], r["count"]) for r in R.top_districts(df, n=2).collect()]
    assert out == [("B", 2), ("A", 2)]  # top two by count then name, shown ascending


def test_top_one_period_keeps_blank(spark):
    df = _rows(spark, _inc(3, 2024, 1, 1, "A", period="") + _inc(2, 2024, 1, 1, "B", period="NULL")
               + _inc(2, 2024, 1, 1, "B", period="A tarde"))
    got = {r["dimension"]: (r["value"], r["count"]) for r in R.top_one(df).collect()}
    assert got == {"BAIRRO": ("B", 4), "DESCR_PERIODO": ("", 3)}


def test_period_distribution_excludes_placeholders(spark):
    df = _rows(spark, _inc(3, 2024, 1, 1, "A", period="") + _inc(1, 2024, 1, 1, "B", period="NULL")
               + _inc(1, 2024, 1, 1, "B", period="A tarde") + _inc(3, 2024, 1, 1, "C", period="A noite"))
    got = {r[M.DESCR_PERIODO]: (r["count"], r["share_pct"]) for r in R.period_distribution(df).collect()}
    assert got == {"A noite": (3, 75.0), "A tarde": (1, 25.0)}


def test_default_years_fallback(spark):
    parts = spark.createDataFrame([(2020, 1), (2023, 1), (2023, 2)], "ANO int, TRIMESTRE int")
    row = R.default_years(parts).first()
    assert (row["ano_base"], row["ano_anterior"]) == (2023, 2020)
    one = spark.createDataFrame([(2023, 1)], "ANO int, TRIMESTRE int")
    assert R.default_years(one).first()["ano_anterior"] is None


def test_a_given_year_stays_and_the_other_is_defaulted(spark):
    parts = spark.createDataFrame(
        [(2022, 1), (2022, 2), (2023, 2), (2023, None), (2025, 1), (2025, 2), (None, 1)], "ANO int, TRIMESTRE int"
    )
    pick = lambda **years: tuple(R.comparison(parts, **years).first())
    assert pick() == (2025, 2023, [2])  # a gap: the newest other year
    assert pick(year_a=2023) == (2023, 2022, [2])
    assert pick(year_a=2022) == (2022, 2025, [1, 2])
    assert pick(year_b=2022) == (2025, 2022, [1, 2])
    assert pick(year_a=2023, year_b=2025) == (2023, 2025, [2])
    assert R.resolve_comparison(parts, year_a=2023) == R.Comparison(2023, 2022, (2,))
    assert R.resolve_comparison(parts.where("ANO = 2023")) is None
    assert R.resolve_comparison(parts.where("ANO = 1900")) is None
    assert [r[0] for r in R.comparable_quarters(parts, 2025, 2022).collect()] == [1, 2]


def test_comparison_and_variation(spark):
    rows = (_inc(40, 2023, 1, 1, "A") + _inc(50, 2024, 1, 2, "A")
            + _inc(30, 2023, 2, 4, "B") + _inc(10, 2024, 1, 3, "B")
            + _inc(29, 2023, 1, 1, "C") + _inc(90, 2024, 1, 1, "C")
            + _inc(5, 2024, 3, 7, "D"))
    df = _rows(spark, rows)
    cmp = R.resolve_comparison(R.partition_counts(df))
    assert cmp == R.Comparison(2024, 2023, (1,))
    lazy = R.comparison(R.partition_counts(df))
    assert R.district_year_counts(df, lazy).collect() == R.district_year_counts(df, cmp).collect()
    assert R.year_kpis(df, lazy).first() == R.year_kpis(df, cmp).first()
    counts = {r[M.BAIRRO]: (r["total_atual"], r["total_anterior"])
              for r in R.district_year_counts(df, cmp).collect()}
    assert counts == {"A": (50, 40), "B": (10, 0), "C": (90, 29)}
    var = R.district_variation(R.district_year_counts(df, cmp)).collect()
    assert [(r[M.BAIRRO], r["delta"], r["delta_pct"], r["direcao"]) for r in var] == [("A", 10, 25.0, "Alta")]
    table = {r[M.BAIRRO]: r["delta_pct"] for r in R.district_comparison(R.district_year_counts(df, cmp)).collect()}
    assert table == {"A": 25.0, "B": None, "C": 210.3}


def test_year_kpis_without_previous_year(spark):
    df = _rows(spark, _inc(4, 2024, 1, 1, "A", geo=False) + _inc(4, 2024, 1, 1, "A", cat="Furto"))
    cmp = R.Comparison(2024, 2023, (1,))
    k = R.year_kpis(df, cmp).first()
    assert (k["total_atual"], k["total_anterior"], k["roubos_atual"], k["furtos_atual"]) == (8, 0, 4, 4)
    assert k["delta_total_pct"] is None
    assert (k["pct_geo_atual"], k["pct_geo_anterior"], k["delta_geo_pp"]) == (50.0, 0.0, 50.0)


def test_quality_not_available_without_columns(spark):
    df = _rows(spark, _inc(1, 2024, 1, 1, "A"))
    assert Q.quality_metrics(df) is None
    assert Q.latest_record(df) is None
    assert Q.district_variants(df) is None


def test_filter_options(spark):
    df = _rows(spark, _inc(1, 2024, 1, 1, "A", period="NULL") + _inc(1, 2023, 2, 4, "B", period="A noite")
               + _inc(1, 2022, 2, 4, None, period=None, city="OUTRA"))
    opts = R.filter_options_dict(df)
    assert opts == {"anos": [2024, 2023], "trimestres": [1, 2], "bairros": ["A", "B"],
                    "tipos_crime": ["Roubo"], "periodos": ["A noite"]}


def test_map_tiles_counts_points(spark):
    df = spark.createDataFrame(
        [("S.PAULO", 2024, 1, True, -23.55, -46.63), ("S.PAULO", 2024, 1, True, -23.551, -46.631),
         ("S.PAULO", 2024, 1, False, None, None), ("S.PAULO", 2024, 1, True, -23.5, -1e12),
         ("S.PAULO", 2024, 1, True, -1e300, 2.0), ("S.PAULO", 2024, 1, True, -89.0, 2.0)],
        "CIDADE string, ANO int, TRIMESTRE int, HAS_COORDINATES boolean, LATITUDE double, LONGITUDE double",
    )
    for c in ("RUBRICA_MOD", "BAIRRO", "DESCR_PERIODO", "LOGRADOURO", "NUM_BO", "DATA_OCORRENCIA_BO",
              "MARCA_OBJETO"):
        from pyspark.sql import functions as F
        df = df.withColumn(c, F.lit(None).cast("string"))
    rows = X.map_tiles(df, M.Scope(year=2024, quarters=(1,)), zoom=11).collect()
    off = [r for r in rows if r["tile_x"] is None]
    assert [(r["points"], r["tile_y"], r["mean_lat"]) for r in off] == [(3, None, None)]
    rows = [r for r in rows if r["tile_x"] is not None]
    assert len(rows) == 1 and rows[0]["points"] == 2
    assert (rows[0]["tile_x"], rows[0]["tile_y"]) == (758, 1161)
    assert rows[0]["mean_lat"] == -23.5505
