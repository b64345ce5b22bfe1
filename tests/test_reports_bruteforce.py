"""Reports against brute-force Python on random incidents with many ties,
nulls, blanks and placeholders."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from quadra import model as M
from quadra.operators import quality as Q
from quadra.operators import reports as R

SCHEMA = ("NUM_BO string, ANO_BO string, VERSAO string, ANO int, TRIMESTRE int, MES int, CIDADE string, "
          "BAIRRO string, BAIRRO_ORIGINAL string, RUBRICA_MOD string, DESCR_PERIODO string, "
          "MARCA_OBJETO string, HAS_COORDINATES boolean, DATAHORA_REGISTRO_BO string")


def _row(rng: random.Random) -> tuple:
    month = rng.choice([1, 2, 4, 5, 7, 11, None])
    quarter = None if month is None else (month - 1) // 3 + 1
    district = rng.choice(["A", "B", "C", "D", "", None])
    return (
        str(rng.randint(1, 40)),
        rng.choice(["2023", "2024", None]),
        rng.choice(["1", "2", "1.5", "x", None]),
        rng.choice([2023, 2024]),
        quarter,
        month,
        rng.choice(["S.PAULO", "S.PAULO", "S.PAULO", "OUTRA"]),
        district,
        None if district is None else district + rng.choice(["", ".", " "]),
        rng.choice(["Roubo", "Furto", "Perda", "Outros"]),
        rng.choice(["A noite", "A tarde", "NULL", "", None]),
        rng.choice(["X", "Y", "NULL", "", None]),
        rng.random() < 0.5,
        rng.choice(["2024-01-05", "2023-12-31", "2024", None]),
    )


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(42)
    rows = [_row(rng) for _ in range(600)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def _city(rows):
    return [r for r in rows if r[6] == M.CITY]


def test_top_districts(data):
    rows, df = data
    counts = Counter(r[7] for r in rows if r[7])
    expected = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
    got = [(r[M.BAIRRO], r["count"]) for r in R.top_districts(df, n=3).collect()]
    assert sorted(got, key=lambda kv: (-kv[1], kv[0])) == expected


def test_period_distribution(data):
    rows, df = data
    counts = Counter(r[10] for r in rows if r[10] not in (None, "NULL", ""))
    total = sum(counts.values())
    got = {r[M.DESCR_PERIODO]: (r["count"], r["share_pct"]) for r in R.period_distribution(df).collect()}
    assert {k: v[0] for k, v in got.items()} == dict(counts)
    for k, (n, share) in got.items():
        assert abs(share - n / total * 100) <= 0.05 + 1e-9


def test_district_year_counts_and_variation(data):
    rows, df = data
    cmp = R.Comparison(2024, 2023, (1, 2))
    scoped = [r for r in _city(rows) if r[4] in (1, 2) and r[7]]
    now = Counter(r[7] for r in scoped if r[3] == 2024)
    before = Counter(r[7] for r in scoped if r[3] == 2023)
    got = {r[M.BAIRRO]: (r["total_atual"], r["total_anterior"])
           for r in R.district_year_counts(df, cmp).collect()}
    assert got == {d: (now[d], before[d]) for d in set(now) | set(before)}
    var = R.district_variation(R.district_year_counts(df, cmp), n=2, min_previous=5).collect()
    eligible = sorted(((d, now[d] - before[d]) for d in got if before[d] >= 5),
                      key=lambda kv: (-abs(kv[1]), kv[0]))[:2]
    assert sorted((r[M.BAIRRO], r["delta"]) for r in var) == sorted(eligible)


def test_quality_metrics(data):
    rows, df = data
    got = {(r[M.ANO], r[M.TRIMESTRE]): r.asDict() for r in Q.quality_metrics(df).collect()}
    groups: dict = {}
    for r in _city(rows):
        groups.setdefault((r[3], r[4]), []).append(r)
    assert set(got) == set(groups)
    for key, rs in groups.items():
        g = got[key]
        assert g["linhas"] == len(rs)
        assert g["bos_unicos"] == len({f"{r[1] or ''}/{r[0] or ''}" for r in rs})
        assert g["linhas_versao_maior_1"] == sum(r[2] in ("2", "1.5") for r in rs)
        assert g["com_coordenadas"] == sum(r[12] for r in rs)
        assert g["bairro_vazio"] == sum(r[7] in (None, "") for r in rs)
        assert g["periodo_nulo"] == sum(r[10] in (None, "NULL") for r in rs)
        assert g["marca_vazia"] == sum(r[11] in (None, "", "NULL") for r in rs)


def test_district_variants(data):
    rows, df = data
    spellings: dict = {}
    for r in _city(rows):
        if r[7]:
            spellings.setdefault(r[7], Counter())[r[8]] += 1
    expected = {d: (len(c), " | ".join(sorted(c)), sum(c.values())) for d, c in spellings.items() if len(c) > 1}
    got = {r[M.BAIRRO]: (r["variantes"], r["exemplos"], r["total_bos"]) for r in Q.district_variants(df).collect()}
    assert got == expected


def test_latest_record(data):
    rows, df = data
    dates = [r[13] for r in _city(rows) if r[13] and len(r[13]) == 10]
    assert str(Q.latest_record(df).first()["ultima"]) == max(dates)


@pytest.mark.parametrize("nulls_first", [False, True])
@pytest.mark.parametrize("n", [1, 7, 40, 500])
def test_detail_tables_match_sorted_python(spark, nulls_first, n):
    import datetime as dt

    from pyspark.sql import functions as F

    from quadra.operators import extracts as X

    rng = random.Random(n * 2 + nulls_first)
    base = dt.datetime(2024, 3, 1)
    rows = []
    for i in range(400):
        hot = rng.random() < 0.33  # one day holds about a third of the rows
        when = None if rng.random() < 0.1 else base + dt.timedelta(days=0 if hot else rng.randint(0, 60),
                                                                   hours=rng.randint(0, 3))
        rows.append((str(rng.randint(1, 30)), when, rng.choice(["A noite", None]), "Roubo",
                     rng.choice(["A", "B"]), "RUA", rng.choice(["X", None]), "S.PAULO", 2024, 1))
    df = spark.createDataFrame(
        rows, "NUM_BO string, DATA_OCORRENCIA_BO timestamp_ntz, DESCR_PERIODO string, RUBRICA_MOD string, "
              "BAIRRO string, LOGRADOURO string, MARCA_OBJETO string, CIDADE string, ANO int, TRIMESTRE int",
    ).withColumn("RUBRICA", F.lit("x")).withColumn("HAS_COORDINATES", F.lit(True)).withColumn("MES", F.lit(1))
    scope = M.Scope(year=2024, quarters=(1,))

    def key(r):
        d = r[1]
        rest = tuple((v is None, v or "") for v in (r[0], r[2], r[3], r[4], r[5], r[6]))
        if nulls_first:
            return ((0, 0) if d is None else (1, -d.timestamp()),) + rest
        return ((1, 0) if d is None else (0, -d.timestamp()),) + rest

    expected = [r[:7] for r in sorted(rows, key=key)[:n]]
    table = X.detail_table_page(df, scope, n) if nulls_first else X.detail_table(df, scope, n)
    assert [tuple(r) for r in table.collect()] == expected
