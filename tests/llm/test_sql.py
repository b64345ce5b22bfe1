"""The operators that SQL can express, against DuckDB on the smallest tables."""

import duckdb
import pytest

from quadra.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    want = con.execute(registry.ORACLE_SQL[name])
    columns = sorted(c[0] for c in want.description)
    rows = want.fetchall()
    order = [[c[0] for c in want.description].index(c) for c in columns]
    got = registry.QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(repr(tuple(r[k] for k in order)) for r in rows)
