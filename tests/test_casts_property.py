"""Safe casts against DuckDB's TRY_CAST on random texts (traps 6-8)."""

from __future__ import annotations

import random

import duckdb
from pyspark.sql import functions as F

from quadra.functions import columns as C

NUM_CHARS = "0123456789" * 4 + ",.,.-+eE  df"
DATE_CHARS = "0123456789" * 3 + "--- :T/"


def _texts(rng: random.Random, chars: str, n: int, max_len: int) -> list[str]:
    return ["".join(rng.choice(chars) for _ in range(rng.randint(0, max_len))) for _ in range(n)]


def _duck(sql: str, values: list[str]) -> list:
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, v VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    return [r[0] for r in con.execute(f"SELECT {sql} FROM t ORDER BY i").fetchall()]


def _spark(spark, expr, values: list[str]) -> list:
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def _mismatches(values, a, b):
    return [(v, x, y) for v, x, y in zip(values, a, b) if x != y]


def _double_sign(v: str) -> bool:
    # DuckDB reads "+-50" as -50; the coordinate rule of the reference (a
    # strict float parse) does not, and neither do we.
    return any(p in v for p in ("+-", "-+", "--", "++"))


def _long_or_negative_year(v: str) -> bool:
    # DuckDB accepts years of 5-7 digits and BC years; Spark dates stop at 9999.
    head = v.strip()
    digits = len(head) - len(head.lstrip("0123456789"))
    return head.startswith("-") or digits > 4 or (0 < digits and int(head[:digits]) == 0)


def _huge_exponent(v: str) -> bool:
    # DuckDB rejects exponents of five digits even on a zero mantissa.
    low = v.lower()
    return "e" in low and sum(ch.isdigit() for ch in low.split("e", 1)[1]) >= 5


def test_coordinate_parse_matches_duckdb(spark):
    rng = random.Random(7)
    values = _texts(rng, NUM_CHARS, 20000, 9) + ["-23,55", " -23.5 ", "1e3", "-23.5d", "1f", ".5", "5."]
    ours = _spark(spark, C.parse_decimal_text, values)
    duck = _duck("TRY_CAST(regexp_replace(v, ',', '.') AS DOUBLE)", values)
    bad = [m for m in _mismatches(values, ours, duck) if not _double_sign(m[0])]
    assert not bad[:5]


def test_safe_int_matches_duckdb(spark):
    rng = random.Random(8)
    values = _texts(rng, NUM_CHARS.replace(",", ""), 20000, 8) + ["1.5", "-2.5", "2.5", "1e0", "99999999999"]
    ours = _spark(spark, C.safe_int, values)
    duck = _duck("TRY_CAST(v AS INTEGER)", values)
    bad = [m for m in _mismatches(values, ours, duck) if not _huge_exponent(m[0])]
    assert not bad[:5]


def test_safe_date_matches_duckdb(spark):
    rng = random.Random(9)
    values = _texts(rng, DATE_CHARS, 20000, 19) + ["2024-01-05", "2024-1-5 10:32", "2024", "2024-02-30",
                                                        "2024/01/05", "2024 1 5", "2024-01/05", "2024.01.05"]
    ours = _spark(spark, C.safe_date, values)
    duck = _duck("TRY_CAST(v AS DATE)", values)
    bad = [m for m in _mismatches(values, ours, duck) if not _long_or_negative_year(m[0])]
    assert not bad[:5]
