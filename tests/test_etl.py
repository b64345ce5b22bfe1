"""Raw and transformed layers on the reference's incident sample, plus lake I/O."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from quadra import model as M
from quadra.plans import etl
from quadra.sources import lake

# --- fixed values: the reference's sample of incidents ---------------------
SAMPLE = [
    ("A1", 2026, 1, "S.PAULO", "Roubo (art. 157)", "  jd  paulista ", "-23,55", "-46,63"),
    ("A2", 2026, 2, "S.PAULO", "Furto (art. 155)", "VL. MARIANA", None, "-46.60"),
    ("A3", 2026, 4, "S.PAULO", "Perda de objeto", "SÃO JOÃO CLÍMACO", "-23.60", None),
    ("A4", 2026, 7, "S.PAULO", "Extravio de documento", None, "10.0", "-46.00"),
    ("A5", 2026, 11, "S.PAULO", "Apropriacao indebita", "", "-23,70", "-46,70"),
    ("A6", 2026, 12, "S.PAULO", "Estelionato", "CENTRO", None, None),
]
SCHEMA = ("NUM_BO string, ANO bigint, MES bigint, CIDADE string, RUBRICA string, "
          "BAIRRO string, LATITUDE string, LONGITUDE string")
# What each row becomes: quarter, latitude, longitude | coordinates, category, district.
LAYERS = {
    "A1": ((1, -23.55, -46.63), (True, "Roubo", "JARDIM PAULISTA")),
    "A2": ((1, None, -46.6), (False, "Furto", "VILA MARIANA")),
    "A3": ((2, -23.6, None), (False, "Perda", "SAO JOAO CLIMACO")),
    "A4": ((3, 10.0, -46.0), (False, "Perda", None)),
    "A5": ((4, -23.7, -46.7), (True, "Outros", "")),
    "A6": ((4, None, None), (False, "Outros", "CENTRO")),
}


@pytest.fixture()
def sample(spark):
    return spark.createDataFrame(SAMPLE, SCHEMA)


def test_sample_through_both_layers(spark, sample, scratch):
    """Each layer as one table: every input row and all that is derived from it."""
    roots = [f"{scratch}/lake/{name}" for name in ("raw", "transformed")]
    assert etl.run_raw(sample, roots[0]) == [(2026, q) for q in (1, 2, 3, 4)]
    etl.run_transformed(spark, *roots)
    raw, out = (lake.read_layer(spark, root) for root in roots)
    given = {r[0]: r for r in SAMPLE}
    derived = (M.TRIMESTRE, M.LATITUDE, M.LONGITUDE)
    kept = raw.select(M.NUM_BO, M.ANO, M.MES, M.CIDADE, M.RUBRICA, M.BAIRRO, *derived).collect()
    assert {r[0]: tuple(r) for r in kept} == {k: (*given[k][:6], *LAYERS[k][0]) for k in given} and len(kept) == 6
    made = out.select(M.NUM_BO, M.BAIRRO_ORIGINAL, M.HAS_COORDINATES, M.RUBRICA_MOD, M.BAIRRO).collect()
    assert {r[0]: tuple(r) for r in made} == {k: (k, given[k][5], *LAYERS[k][1]) for k in given} and len(made) == 6


def test_newer_names_land_in_the_same_columns(spark):
    newer = spark.createDataFrame([("Z", "2023", "10", "x")], "NUM_BO string, ANO_REGISTRO_BO string, MES_REGISTRO_BO string, EXTRA string")
    both = spark.createDataFrame([("Z", 2023, 10, 1999)], "NUM_BO string, ANO int, MES int, ANO_REGISTRO_BO int")
    row = lake.harmonise(newer).first()
    assert (row[M.ANO], row[M.MES], row[M.TRIMESTRE], row["EXTRA"], row[M.UNREAD]) == (2023, 10, 4, "x", None)
    assert lake.harmonise(both).first()[M.ANO] == 2023 and lake.harmonise(both).first()["ANO_REGISTRO_BO"] == "1999"


def _file(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as out:
        out.write("\n".join(lines) + "\n")
    return path


def test_landing_text_is_kept(spark, scratch):
    """Leading zeros, day-first dates, a month in words, an undeclared column, an empty text."""
    path = _file(
        f"{scratch}/l/2024.csv",
        "NUM_BO,ANO,MES,DATA_OCORRENCIA_BO,LATITUDE,BAIRRO,SALA",
        '000123,2024,jan,05/01/2024,"-23,5",,7',
        '000124,,3,2024-03-09 10:11:12,n/d,"",007',
        "000125,2024, 4 ,ontem,,Centro,",
    )
    rows = {r[M.NUM_BO]: r for r in lake.read_landing(spark, [path]).collect()}
    assert set(rows) == {"000123", "000124", "000125"}
    assert [rows[k]["SALA"] for k in sorted(rows)] == ["7", "007", None]
    assert [rows[k][M.BAIRRO] for k in sorted(rows)] == [None, "", "Centro"]
    assert [rows[k][M.MES] for k in sorted(rows)] == [None, 3, 4]
    assert [rows[k][M.ANO] for k in sorted(rows)] == [2024, None, 2024]
    assert [str(rows[k][M.DATA_OCORRENCIA_BO]) for k in sorted(rows)] == ["2024-01-05 00:00:00", "2024-03-09 10:11:12", "None"]
    assert [rows[k][M.UNREAD] for k in sorted(rows)] == ['{"MES":"jan"}', '{"LATITUDE":"n/d"}', '{"DATA_OCORRENCIA_BO":"ontem"}']


def test_bad_year_fails_the_job(spark, scratch):
    path = _file(f"{scratch}/l/x.csv", "NUM_BO,ANO,MES", "1,20x4,1")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        lake.read_landing(spark, [path]).collect()


def test_undeclared_column_may_change_its_kind_between_runs(spark, scratch):
    from quadra.plans import jobs

    head = "NUM_BO,ANO,MES,CIDADE,RUBRICA,BAIRRO,LATITUDE,LONGITUDE,SALA"
    first = _file(f"{scratch}/l/2023.csv", head, "01,2023,1,S.PAULO,Roubo,A,,,12")
    second = _file(f"{scratch}/l/2024.csv", head, "02,2024,1,S.PAULO,Roubo,A,,,S/N")
    jobs.run(spark, [first], f"{scratch}/lake")
    jobs.run(spark, [second], f"{scratch}/lake")
    for root in jobs.layer_roots(f"{scratch}/lake")[:2]:
        rows = {r[M.NUM_BO]: r["SALA"] for r in lake.read_layer(spark, root).collect()}
        assert rows == {"01": "12", "02": "S/N"}
    jobs.run(spark, [first, second], f"{scratch}/both")
    assert lake.read_layer(spark, jobs.layer_roots(f"{scratch}/both")[1]).count() == 2


def test_job_opens_only_what_it_wrote(spark, scratch):
    """A broken file in another partition is never opened, and the run takes few Spark jobs."""
    from quadra.plans import jobs

    base = f"{scratch}/lake"
    head = "NUM_BO,ANO,MES,CIDADE,RUBRICA,BAIRRO,LATITUDE,LONGITUDE,ANO_BO,VERSAO,DESCR_PERIODO,MARCA_OBJETO"
    path = _file(f"{scratch}/l/a.csv", head, 'A,2024,2,S.PAULO,Roubo,VL X,"-23,5","-46,6",2024,1,A noite,M', "B,2024,,CAMPINAS,,,,,2024,1,,")
    for root in jobs.layer_roots(base)[:2]:
        _file(f"{root}/ano=2020/trimestre=1/part-0.parquet", "this is no parquet file")
    spark.sparkContext.setJobGroup("one-run", "")
    manifest = jobs.run(spark, [path], base, tag="t")
    count = len(spark.sparkContext.statusTracker().getJobIdsForGroup("one-run"))
    spark.sparkContext.setJobGroup("tests", "")
    assert manifest["partitions"] == [{"ano": 2024, "trimestre": 1, "rows": 1}, {"ano": 2024, "trimestre": None, "rows": 1}]
    assert (manifest["source"], manifest["total_rows"]) == ("t", 2)
    assert count <= 30, count  # six tables are staged and published; every shuffle of a small write counts as a job


def test_landing_without_rows_fails_the_health_check(spark, scratch):
    from quadra.plans import jobs

    path = _file(f"{scratch}/l/empty.csv", "NUM_BO,ANO,MES")
    with pytest.raises(RuntimeError, match="health check"):
        jobs.run(spark, [path], f"{scratch}/lake")


def test_transformed_without_coordinate_columns(spark):
    df = spark.createDataFrame([("X", "Furto")], "NUM_BO string, RUBRICA string")
    row = etl.transformed_layer(df).first()
    assert row[M.HAS_COORDINATES] is False and row[M.RUBRICA_MOD] == "Furto"


def test_dynamic_overwrite_replaces_only_present_partitions(spark, sample, scratch):
    root = f"{scratch}/raw"
    etl.run_raw(sample, root)
    # a second run with only Q1 rows replaces Q1 and keeps the other quarters
    etl.run_raw(sample.where(F.col("MES") <= 3).where(F.col("NUM_BO") == "A1"), root)
    got = {(r[M.TRIMESTRE], r[M.NUM_BO]) for r in lake.read_layer(spark, root).collect()}
    assert got == {(1, "A1"), (2, "A3"), (3, "A4"), (4, "A5"), (4, "A6")}


def test_null_month_kept_in_default_partition(spark, scratch):
    df = spark.createDataFrame([("N1", 2026, None), ("N2", 2026, 5)], "NUM_BO string, ANO int, MES int")
    root = f"{scratch}/raw"
    etl.run_raw(df, root)
    rows = {r[M.NUM_BO]: r[M.TRIMESTRE] for r in lake.read_layer(spark, root).collect()}
    assert rows == {"N1": None, "N2": 2}


def test_landing_files_union_by_name(spark, scratch):
    old = f"{scratch}/landing/2024.csv"
    new = f"{scratch}/landing/2025.csv"
    os.makedirs(f"{scratch}/landing")
    with open(old, "w", encoding="utf-8") as fh:
        fh.write("NUM_BO,ANO,MES,LATITUDE\nO1,2024,3,\"-23,5\"\nO2,2024,12,\n")
    with open(new, "w", encoding="utf-8") as fh:
        fh.write("NUM_BO,ANO_REGISTRO_BO,MES_REGISTRO_BO,VERSAO,LATITUDE\nN1,2025,2,2,-23.25\n")
    raw = lake.read_landing(spark, [old, new], "csv")
    rows = {r[M.NUM_BO]: r for r in raw.collect()}
    assert rows["O1"][M.LATITUDE] == -23.5 and rows["O1"][M.VERSAO] is None
    assert rows["O2"][M.TRIMESTRE] == 4 and rows["O2"][M.LATITUDE] is None
    assert (rows["N1"][M.ANO], rows["N1"][M.TRIMESTRE], rows["N1"][M.VERSAO]) == (2025, 1, "2")
    assert dict(raw.dtypes)[M.ANO] == "int"


def test_merged_scan_fills_missing_columns(spark, scratch):
    root = f"{scratch}/lake"
    a = spark.createDataFrame([("A", 2024, 1)], "NUM_BO string, ANO int, MES int")
    b = spark.createDataFrame([("B", 2025, 1, "3")], "NUM_BO string, ANO int, MES int, VERSAO string")
    etl.run_raw(a, root)
    etl.run_raw(b, root)
    rows = {r[M.NUM_BO]: r[M.VERSAO] for r in lake.read_layer(spark, root).collect()}
    assert rows == {"A": None, "B": "3"}


def test_transform_stats_and_health(spark, sample):
    df = etl.transformed_layer(etl.raw_layer(sample))
    s = etl.transform_stats(df).first()
    assert (s["rows"], s["rows_with_coordinates"]) == (6, 2)
    assert s["pct_with_coordinates"] == 33.3
    # null counts as one value, before and after
    assert (s["districts_before"], s["districts_after"]) == (6, 6)
    counts = {r[M.RUBRICA_MOD]: r["count"] for r in etl.category_counts(df).collect()}
    assert counts == {"Roubo": 1, "Furto": 1, "Perda": 2, "Outros": 2}
    assert etl.assert_healthy(df) == 6
    with pytest.raises(RuntimeError):
        etl.assert_healthy(df.limit(0))
    empty = etl.transform_stats(df.limit(0)).first()
    assert empty["rows"] == 0 and empty["pct_with_coordinates"] is None
    assert (empty["districts_before"], empty["districts_after"]) == (0, 0)


def test_cluster_conf_sizes_partitions():
    from quadra.session import cluster_conf

    conf = cluster_conf(100 * 2**40, total_cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert int(cluster_conf(1 << 20, total_cores=8)["spark.sql.shuffle.partitions"]) == 16


def test_batch_job_all_layers(spark, scratch):
    from quadra.plans import jobs

    land = f"{scratch}/2026.csv"
    with open(land, "w", encoding="utf-8") as fh:
        fh.write("NUM_BO,ANO,MES,CIDADE,RUBRICA,BAIRRO,LATITUDE,LONGITUDE\n")
        fh.write('A1,2026,1,S.PAULO,Roubo,VL X,"-23,5","-46,6"\nA2,2026,5,S.PAULO,Furto,,,\n')
    manifest = jobs.run(spark, [land], f"{scratch}/lake")
    assert manifest["total_rows"] == 2 and manifest["anos_processados"] == [2026]
    raw_root, out_root, manifest_path = jobs.layer_roots(f"{scratch}/lake")
    assert lake.read_manifest(spark, manifest_path)["total_rows"] == 2
    row = lake.read_layer(spark, out_root).where(F.col(M.NUM_BO) == "A1").first()
    assert row[M.BAIRRO] == "VILA X" and row[M.HAS_COORDINATES]


def test_hot_partition_is_split_over_writers(spark, scratch):
    """One (year, quarter) holding most rows is written by several tasks."""
    big = spark.range(200_000).select(
        F.col("id").cast("string").alias("NUM_BO"),
        F.when(F.col("id") % 3 == 0, F.lit(2025)).otherwise(F.lit(2026)).cast("int").alias("ANO"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 4 + 1).otherwise(F.lit(1)).cast("int").alias("TRIMESTRE"),
        F.concat(F.lit("payload-"), F.col("id").cast("string")).alias("BAIRRO"),
    )
    root = f"{scratch}/hot"
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        lake.write_layer(big, root)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot_files = [f for f in os.listdir(f"{root}/ano=2026/trimestre=1") if f.endswith(".parquet")]
    assert len(hot_files) > 1
    assert lake.read_layer(spark, root).count() == 200_000


def test_declared_schema_read_equals_merged_read(spark, scratch):
    root = f"{scratch}/lake"
    a = spark.createDataFrame([("A", 2024, 1)], "NUM_BO string, ANO int, MES int")
    b = spark.createDataFrame([("B", 2025, 1, "3")], "NUM_BO string, ANO int, MES int, VERSAO string")
    etl.run_raw(a, root)
    etl.run_raw(b, root)
    merged = lake.read_layer(spark, root)
    declared = lake.read_layer(spark, root, schema=M.layer_schema(transformed=False))
    cols = [M.NUM_BO, M.VERSAO, M.ANO, M.TRIMESTRE, M.MES]
    assert sorted(map(tuple, merged.select(cols).collect())) == sorted(map(tuple, declared.select(cols).collect()))
    assert dict(declared.dtypes)[M.ANO] == "int" and M.TRIMESTRE in declared.columns


def test_landing_parquet_numeric_coordinates_pass_through(spark, scratch):
    path = f"{scratch}/landing.parquet"
    spark.createDataFrame(
        [("P1", 2024, 6, -23.5, -46.6), ("P2", 2024, 7, None, -46.7)],
        "NUM_BO string, ANO long, MES long, LATITUDE double, LONGITUDE double",
    ).write.parquet(path)
    raw = lake.read_landing(spark, [path], "parquet")
    rows = {r[M.NUM_BO]: r for r in raw.collect()}
    assert rows["P1"][M.LATITUDE] == -23.5 and rows["P2"][M.LATITUDE] is None
    assert (rows["P1"][M.TRIMESTRE], rows["P2"][M.TRIMESTRE]) == (2, 3)
    assert dict(raw.dtypes)[M.MES] == "int"


def test_batch_job_command_line(spark, scratch):
    from quadra.plans import jobs

    land = f"{scratch}/2025.csv"
    with open(land, "w", encoding="utf-8") as fh:
        fh.write("NUM_BO,ANO_REGISTRO_BO,MES_REGISTRO_BO,CIDADE,RUBRICA,BAIRRO\nC1,2025,9,S.PAULO,Roubo,STO AMARO\n")
    aliases = f"{scratch}/aliases.csv"
    with open(aliases, "w", encoding="utf-8") as fh:
        fh.write("bairro_variante,bairro_canonico\nSANTO AMARO,SANTO AMARO UNIFICADO\n")
    jobs.main(["--landing", land, "--lake", f"{scratch}/lake", "--aliases", aliases])
    _, out_root, manifest_path = jobs.layer_roots(f"{scratch}/lake")
    row = lake.read_layer(spark, out_root).first()
    assert (row[M.ANO], row[M.TRIMESTRE], row[M.BAIRRO]) == (2025, 3, "SANTO AMARO UNIFICADO")
    assert lake.read_manifest(spark, manifest_path)["partitions"] == [{"ano": 2025, "trimestre": 3, "rows": 1}]


def test_landing_with_declared_schema_skips_inference(spark, scratch):
    from pyspark.sql import types as T

    path = f"{scratch}/2024.csv"
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("NUM_BO,ANO,MES,VERSAO\n007,2024,3,02\n")
    schema = T.StructType([T.StructField("NUM_BO", T.StringType()), T.StructField("ANO", T.IntegerType()),
                           T.StructField("MES", T.IntegerType()), T.StructField("VERSAO", T.StringType())])
    row = lake.read_landing(spark, [path], "csv", schemas={path: schema}).first()
    assert (row[M.NUM_BO], row[M.VERSAO], row[M.TRIMESTRE]) == ("007", "02", 1)
