"""Incremental landing ingest (availableNow file stream)."""

from __future__ import annotations

import os

from pyspark.sql import types as T

from quadra import model as M
from quadra.sources import lake
from quadra.streaming.ingest import read_raw, start_ingest, write_batch

SCHEMA = T.StructType(
    [
        T.StructField("NUM_BO", T.StringType()),
        T.StructField("ANO", T.IntegerType()),
        T.StructField("MES", T.IntegerType()),
        T.StructField("CIDADE", T.StringType()),
        T.StructField("RUBRICA", T.StringType()),
        T.StructField("BAIRRO", T.StringType()),
        T.StructField("LATITUDE", T.StringType()),
        T.StructField("LONGITUDE", T.StringType()),
    ]
)


def _land(folder, name, lines):
    with open(os.path.join(folder, name), "w", encoding="utf-8") as fh:
        fh.write("NUM_BO,ANO,MES,CIDADE,RUBRICA,BAIRRO,LATITUDE,LONGITUDE\n")
        fh.write("\n".join(lines) + "\n")


def test_incremental_ingest_appends_and_rebuilds(spark, scratch):
    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    raw, out, ckpt = (os.path.join(scratch, d) for d in ("raw", "transformed", "ckpt"))
    _land(landing, "a.csv", ['A1,2026,1,S.PAULO,Roubo,VL. MARIANA,"-23,5","-46,6"',
                             "A2,2026,5,S.PAULO,Furto,CENTRO,,"])
    side = os.path.join(scratch, "lake")
    start_ingest(spark, landing, SCHEMA, raw, out, ckpt, side_base=side).awaitTermination()
    _land(landing, "b.csv", ['B1,2026,2,S.PAULO,Perda,JD ANGELA,"-23,6","-46,7"'])
    start_ingest(spark, landing, SCHEMA, raw, out, ckpt, side_base=side).awaitTermination()

    rows = {r[M.NUM_BO]: r for r in lake.read_layer(spark, out).collect()}
    assert set(rows) == {"A1", "A2", "B1"}  # the second run kept A1 in Q1
    assert rows["B1"][M.BAIRRO] == "JARDIM ANGELA" and rows["B1"][M.TRIMESTRE] == 1
    assert rows["A1"][M.HAS_COORDINATES] and not rows["A2"][M.HAS_COORDINATES]
    assert read_raw(spark, raw).count() == 3
    from quadra.operators import reports as R
    from quadra.plans import jobs

    values = lake.read_layer(spark, jobs.options_root(side))
    opts = {(r["option"], r["value"]) for r in R.filter_options_from_values(values).collect()}
    assert ("bairros", "JARDIM ANGELA") in opts and ("bairros", "VILA MARIANA") in opts


def test_a_batch_that_runs_again_changes_nothing(spark, scratch):
    """Replay after a failure at any point: the batch replaces its own rows."""
    raw, out = f"{scratch}/raw", f"{scratch}/transformed"
    one = spark.createDataFrame([("A", 2026, 1), ("B", 2026, 5)], "NUM_BO string, ANO int, MES int")
    two = spark.createDataFrame([("C", 2026, 2)], "NUM_BO string, ANO int, MES int")
    write_batch(one, 0, raw, out)
    write_batch(two, 1, raw, out)
    before = sorted(tuple(r) for r in lake.read_layer(spark, out).select("NUM_BO", "ANO", "TRIMESTRE").collect())
    write_batch(two, 1, raw, out)
    write_batch(one, 0, raw, out)
    after = sorted(tuple(r) for r in lake.read_layer(spark, out).select("NUM_BO", "ANO", "TRIMESTRE").collect())
    assert after == before == [("A", 2026, 1), ("B", 2026, 2), ("C", 2026, 1)]
    assert read_raw(spark, raw).count() == 3
