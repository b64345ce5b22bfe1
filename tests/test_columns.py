"""Column expressions: district normalisation, aliases, casts, labels."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadra import model as M
from quadra.functions import columns as C
from quadra.plans import etl
from quadra.sources import lake


def _one(spark, value, expr, dtype=T.StringType()):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("x", dtype)]))
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


# Golden pairs of the reference's normalisation tests.
@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("  jd  paulista ", "JARDIM PAULISTA"),
        ("VL. MARIANA", "VILA MARIANA"),
        ("SÃO JOÃO CLÍMACO", "SAO JOAO CLIMACO"),
        ("PQ. DO CARMO", "PARQUE DO CARMO"),
        ("STA CECILIA", "SANTA CECILIA"),
        ("STO AMARO", "SANTO AMARO"),
        ("JDM ANGELA", "JARDIM ANGELA"),
        ("CJ HAB TAIPAS", "CONJUNTO HAB TAIPAS"),
        ("CENTRO", "CENTRO"),
        (None, None),
        ("", ""),
    ],
)
def test_normalise_district(spark, raw, expected):
    assert _one(spark, raw, C.normalise_district) == expected


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        # upper-casing runs first: ª/º decompose to lower-case and are blanked
        ("Nª SRA. DO Ó", "N SENHORA DO O"),
        ("NSA SRA", "NOSSA SENHORA"),
        ("Vila-Açaí\tnorte", "VILA ACAI NORTE"),
        ("½ JD", "1 2 JARDIM"),
        ("ĲSSEL  PCA", "IJSSEL PRACA"),
        (" CID ADEMAR", "CIDADE ADEMAR"),
        ("Ç Ñ Ü", "C N U"),
        ("ÁGUA", "AGUA"),
    ],
)
def test_normalise_district_unicode(spark, raw, expected):
    assert _one(spark, raw, C.normalise_district) == expected


@pytest.mark.parametrize(
    ("raw", "expected"),
    # Spark-only cases (trap 3): Spark upper-cases ß to SS and the fi ligature to FI
    [("Straße", "STRASSE"), ("ﬁgueira", "FIGUEIRA")],
)
def test_normalise_district_full_case_mapping(spark, raw, expected):
    assert _one(spark, raw, C.normalise_district) == expected


def test_accent_table_is_generated_by_rule():
    src, dst, expansions = C.accent_table()
    assert len(src) >= len(dst) > 200
    assert dict(zip(src, dst, strict=False))["Ã"] == "A"
    assert "ª" not in src and "º" not in src
    assert expansions["Ĳ"] == "IJ" and expansions["Ⅷ"] == "VIII"


def test_aliases_in_one_pass(spark):
    """A chain is not followed; a null target gives null; null and blank names match nothing."""
    table = [("VILA A", "VILA B"), ("VILA B", "VILA C"), ("VILA D", None), ("", "NADA")]
    names = ["vl. a", "VILA-B", "Vila D", "vila e", None, "", " ."]
    rows = [(k, name) for k, name in enumerate(names)]
    frame = spark.createDataFrame(rows, "NUM_BO int, BAIRRO string")
    out = etl.transformed_layer(frame, spark.createDataFrame(table, M.ALIAS_SCHEMA)).orderBy("NUM_BO").collect()
    assert [r[M.BAIRRO] for r in out] == ["VILA B", "VILA C", None, "VILA E", None, "", ""]
    assert [r[M.BAIRRO_ORIGINAL] for r in out] == names


def test_alias_join_runs_nothing_and_spreads_rows_without_district(spark):
    frame = spark.range(4000).selectExpr("cast(id as string) NUM_BO", "if(id % 3 = 0, null, if(id % 3 = 1, '', 'VL X')) BAIRRO")
    table = spark.createDataFrame([("VILA X", "VILA Y")], M.ALIAS_SCHEMA)
    spark.sparkContext.setJobGroup("alias-join", "")
    joined = etl.transformed_layer(frame, table)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("alias-join") == []
    spark.sparkContext.setJobGroup("tests", "")
    counts = {r[M.BAIRRO]: r["count"] for r in joined.groupBy(M.BAIRRO).count().collect()}
    assert counts == {None: 1334, "": 1333, "VILA Y": 1333}


def _csv(path, *lines):
    with open(path, "w", encoding="utf-8") as out:
        out.write("\n".join(["bairro_variante,bairro_canonico", *lines, ""]))
    return path


@pytest.mark.parametrize(
    ("lines", "table"),
    [
        ([], {}),
        (["ALTO DO MORRO,MORRO", "BAIXO,", "ALTO DO MORRO,ALTO"], {"ALTO DO MORRO": "ALTO", "BAIXO": None}),
    ],
)
def test_alias_file(spark, scratch, lines, table):
    assert dict(map(tuple, lake.read_aliases(spark, _csv(f"{scratch}/a.csv", *lines)).collect())) == table
    assert lake.read_aliases(spark, f"{scratch}/not-there.csv").isEmpty() and lake.read_aliases(spark, None).isEmpty()


@pytest.mark.parametrize(
    ("text", "date"),
    [("05/01/2024", "2024-01-05 00:00:00"), ("2024-01-05", "2024-01-05 00:00:00"), ("31/12/2023 23:59:01", "2023-12-31 23:59:01"),
     ("2024-01-05T10:20:30", "2024-01-05 10:20:30"), ("31/02/2024", None), ("ontem", None), ("", None), (None, None)],
)
def test_landing_timestamp(spark, text, date):
    got = _one(spark, text, C.landing_timestamp)
    assert (None if got is None else str(got)) == date


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("-23,55", -23.55),
        ("-23.60", -23.6),
        ("10.0", 10.0),
        (" -23,5 ", -23.5),
        ("-23,5,1", None),  # only the first comma becomes a dot
        ("-23.5d", None),  # Java-style suffixes are not numbers here
        ("1f", None),
        ("n/d", None),
        ("", None),
        (None, None),
        ("1e3", 1000.0),
    ],
)
def test_coordinate_parse(spark, text, expected):
    assert _one(spark, text, C.parse_decimal_text) == expected


@pytest.mark.parametrize(
    ("month", "quarter"), [(1, 1), (2, 1), (3, 1), (4, 2), (7, 3), (11, 4), (12, 4), (0, 0), (None, None)]
)
def test_quarter_of_month_floors(spark, month, quarter):
    assert _one(spark, month, C.quarter_of_month, T.IntegerType()) == quarter


@pytest.mark.parametrize(
    ("heading", "category"),
    [
        ("Roubo (art. 157)", "Roubo"),
        ("FURTO (art. 155)", "Furto"),
        ("Perda de objeto", "Perda"),
        ("Extravio de documento", "Perda"),
        ("Apropriacao indebita", "Outros"),
        ("Roubo seguido de furto", "Roubo"),
        (None, "Outros"),
    ],
)
def test_category(spark, heading, category):
    assert _one(spark, heading, C.category) == category


@pytest.mark.parametrize(
    ("text", "value"),
    [("1", 1), ("2", 2), ("1.5", 2), ("-2.5", -3), ("1e0", 1), (" 3 ", 3), ("v2", None), ("", None),
     ("99999999999", None)],
)
def test_safe_int(spark, text, value):
    assert _one(spark, text, C.safe_int) == value


@pytest.mark.parametrize(
    ("text", "ok"),
    [("2024-03-05", True), ("2024-3-5", True), ("2024", False), ("2024-01", False),
     ("sem data", False), (None, False), ("2024-01-05 10:32:00", True), ("2024-01-05T10:32", True),
     (" 2024-01-05 ", True), ("2024-01-05 xx", False), ("2024-02-30", False), ("05/01/2024", False)]
)
def test_safe_date(spark, text, ok):
    assert (_one(spark, text, C.safe_date) is not None) == ok


def test_month_label(spark):
    df = spark.createDataFrame([(2024, 3), (2024, 11), (2024, None)], "a int, m int")
    out = [r[0] for r in df.select(C.month_label(F.col("a"), F.col("m"))).collect()]
    assert out == ["2024-03", "2024-11", None]


def test_percent_rounds_half_to_even(spark):
    df = spark.createDataFrame([(1, 8), (3, 8), (0, 0)], "a long, b long")
    out = [r[0] for r in df.select(C.guarded_percent(F.col("a"), F.col("b"))).collect()]
    assert out == [12.5, 37.5, None]
    df = spark.createDataFrame([(1, 16)], "a long, b long")  # 6.25 -> 6.2
    assert df.select(C.percent(F.col("a"), F.col("b"))).first()[0] == 6.2
