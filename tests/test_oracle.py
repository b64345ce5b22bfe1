"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import datetime as dt
import decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as E
from quadra.plans.catalog import QUERIES
from quadra.plans.oracle import ORACLE_SQL

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("nation", "customer", "orders", "lineitem", "part", "supplier")


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def con():
    if not Path(SF_DIR).exists():
        pytest.skip("driver tables not present")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL) and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_DIR)
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert _bag(df.columns, s_rows) == _bag(d_cols, d_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "bos_unicos" in df.columns
