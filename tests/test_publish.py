"""The batch job publishes all that a run made, or nothing; alias tables with line numbers and wrong headers."""

from __future__ import annotations

from pathlib import Path

import pytest

from quadra import model as M
from quadra.operators import quality as Q
from quadra.operators import reports as R
from quadra.plans import jobs
from quadra.sources import lake

HEAD = "NUM_BO,ANO_BO,VERSAO,ANO,MES,CIDADE,RUBRICA,BAIRRO,DESCR_PERIODO,MARCA_OBJETO\n"


def _land(scratch, name, *rows) -> str:
    path = Path(scratch) / f"{name}.csv"
    path.write_text(HEAD + "".join(f"{r}\n" for r in rows))
    return str(path)


def _state(spark, base):
    roots = [*jobs.layer_roots(base)[:2], jobs.keys_root(base), jobs.stats_root(base), jobs.options_root(base), jobs.pairs_root(base)]
    return {r: sorted(map(repr, lake.read_layer(spark, r).collect())) for r in roots} | {"manifest": lake.read_manifest(spark, jobs.layer_roots(base)[2])}


def test_a_failed_run_leaves_every_layer_and_a_repeat_mends_it(spark, scratch):
    base = f"{scratch}/lake"
    first = _land(scratch, "first", "A1,2024,1,2024,1,S.PAULO,Roubo,VL. SUL,A noite,X", "A2,2024,1,2024,5,S.PAULO,Furto,,NULL,", "A3,2024,2,2024,,S.PAULO,Furto,CENTRO,,Y")
    jobs.run(spark, [first], base, tag="t")
    before = _state(spark, base)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        jobs.run(spark, [first, _land(scratch, "bad", "B1,2024,1,dois mil,1,S.PAULO,Roubo,X,A noite,X")], base, tag="t")
    assert _state(spark, base) == before
    aliases = Path(scratch) / "aliases.csv"
    aliases.write_text("outra,coisa\na,b\n")
    second = _land(scratch, "second", "C1,2024,1,2024,2,S.PAULO,Roubo,,A noite,Z")
    with pytest.raises(ValueError, match="header"):
        # The raw layer is staged by then, and still not published.
        jobs.run(spark, [second], base, aliases_csv=str(aliases), tag="t")
    assert _state(spark, base) == before
    jobs.run(spark, [second], base, tag="t")
    rows = {(r[M.NUM_BO], r[M.ANO], r[M.TRIMESTRE]) for r in lake.read_layer(spark, jobs.layer_roots(base)[1]).collect()}
    assert rows == {("C1", 2024, 1), ("A2", 2024, 2), ("A3", 2024, None)}
    # The partition that was replaced has no named district any more; the tables beside the lake say so.
    inc = lake.read_layer(spark, jobs.layer_roots(base)[1])
    kept = lake.read_layer(spark, jobs.pairs_root(base))
    assert sorted(map(repr, kept.select(sorted(kept.columns)).collect())) == sorted(map(repr, (p := Q.spelling_pairs(inc)).select(sorted(p.columns)).collect()))
    keys = lake.read_layer(spark, jobs.keys_root(base))
    assert sorted(map(repr, keys.select(sorted(keys.columns)).collect())) == sorted(map(repr, (p := R.partition_keys(inc)).select(sorted(p.columns)).collect()))


def test_one_layer_runs(spark, scratch):
    base = f"{scratch}/lake"
    land = _land(scratch, "one", "A1,2024,1,2024,1,S.PAULO,Roubo,VL. SUL,A noite,X")
    assert jobs.run(spark, [land], base, layer="raw") is None
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        lake.read_layer(spark, jobs.layer_roots(base)[1])
    assert jobs.run(spark, [], base, layer="transformed", tag="t")["total_rows"] == 1


def test_alias_lines_have_numbers(spark, scratch):
    folder = Path(scratch) / "aliases"
    folder.mkdir()
    (folder / "a.csv").write_text("linha,bairro_variante,bairro_canonico\n9,A,NEW\n1,B,OLD\n")
    (folder / "b.csv").write_text("linha,bairro_variante,bairro_canonico\n3,A,OLD\n10,B,NEW\nx,C,ONLY\n")
    got = {r[0]: r[1] for r in lake.read_aliases(spark, str(folder)).collect()}
    assert got == {"A": "NEW", "B": "NEW", "C": "ONLY"}
    (Path(scratch) / "wrong.csv").write_text("outra,coisa\na,b\n")
    with pytest.raises(ValueError, match="header"):
        lake.read_aliases(spark, f"{scratch}/wrong.csv")


def test_files_split_by_partition_are_written_without_a_shuffle_and_moved(spark, scratch):
    rows = spark.range(4000).selectExpr(
        "if(id % 50 = 0, null, cast(2020 + id % 3 as int)) AS ANO", "if(id % 40 = 0, null, cast(id % 4 + 1 as int)) AS TRIMESTRE", "cast(id as string) AS NUM_BO"
    )
    keys = lake.write_layer(rows, f"{scratch}/raw", cluster=False, observe=True)
    schema = lake.stored_schema(rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.sparkContext.setJobGroup("split", "")
    assert lake.write_layer(lake.read_layer(spark, f"{scratch}/raw", schema=schema, keys=keys), f"{scratch}/staged", observe=True, split=True) == keys
    tracker = spark.sparkContext.statusTracker()
    assert [len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup("split")] == [1]
    spark.sparkContext.setJobGroup("tests", "")
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    # What is published: the partitions named are replaced, the others stay; the files are the staged ones.
    old = spark.createDataFrame([(2020, 1, "old"), (1999, 1, "stays")], "ANO int, TRIMESTRE int, NUM_BO string")
    lake.write_layer(old, f"{scratch}/out")
    staged = {f.relative_to(f"{scratch}/staged") for f in Path(scratch, "staged").rglob("*.parquet")}
    lake.publish_layer(spark, f"{scratch}/staged", f"{scratch}/out", schema, keys)
    assert staged < {f.relative_to(f"{scratch}/out") for f in Path(scratch, "out").rglob("*.parquet")}
    want = sorted(map(repr, [*rows.select("NUM_BO", "ANO", "TRIMESTRE").collect(), *old.where("ANO = 1999").select("NUM_BO", "ANO", "TRIMESTRE").collect()]))
    assert sorted(map(repr, lake.read_layer(spark, f"{scratch}/out").select("NUM_BO", "ANO", "TRIMESTRE").collect())) == want
