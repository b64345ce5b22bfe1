"""Page bundles over a lake built from the smallest driver tables."""

from __future__ import annotations

from pathlib import Path

import pytest

from quadra import model as M
from quadra.plans import etl, pages
from quadra.sources import lake

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inc(spark, tmp_path_factory):
    if not Path(SF_DIR).exists():
        pytest.skip("driver tables not present")
    root = str(tmp_path_factory.mktemp("pages") / "transformed")
    lake.write_layer(etl.incidents(spark, SF_DIR), root)
    return lake.read_layer(spark, root, schema=M.layer_schema())


def test_statistics_page(inc):
    scope = M.Scope(year=2000, quarters=(1, 2, 3, 4))
    page = pages.statistics_page(inc, scope)
    total = page["total"].first()["total_bos"]
    assert total > 0
    assert sum(r["count"] for r in page["category_distribution"].collect()) == total
    assert page["detail_table"].count() == min(total, M.DETAIL_ROWS)
    assert len(page["top_districts"].collect()) <= M.TOP_DISTRICTS


def test_map_page(inc):
    page = pages.map_page(inc, M.Scope(year=2000, quarters=(1,)))
    points = page["points"].count()
    assert sum(r["points"] for r in page["tiles"].collect()) == points
    assert page["coverage"].first()["com_coordenadas"] == points


def test_comparison_and_quality_pages(inc):
    page = pages.comparison_page(inc)
    kpis = page["kpis"].first()
    monthly_total = sum(r["total"] for r in page["monthly_overlay"].collect())
    assert kpis["total_atual"] + kpis["total_anterior"] == monthly_total
    q = pages.quality_page(inc)
    assert q["partitions"].count() == q["completeness"].count()
    assert q["latest_record"].first()["ultima"] is not None


def test_option_values_table_gives_same_options(spark, inc, tmp_path):
    from quadra.operators import reports as R

    root = str(tmp_path / "options")
    lake.write_layer(R.option_values(inc), root)
    values = lake.read_layer(spark, root)
    direct = sorted(map(tuple, R.filter_options(inc).collect()))
    stored = sorted(map(tuple, R.filter_options_from_values(values).collect()))
    assert direct == stored
    assert values.count() < inc.count()


def test_partition_stats_table_gives_same_reports(spark, inc, tmp_path):
    from quadra.operators import quality as Q
    from quadra.operators import reports as R

    root = str(tmp_path / "stats")
    lake.write_layer(Q.partition_stats(inc), root)
    stats = lake.read_layer(spark, root)
    for direct, stored in [
        (Q.quality_metrics(inc), Q.quality_metrics_from_stats(stats)),
        (Q.quality_report(inc), Q.quality_report_from_stats(stats)),
        (R.partition_counts(inc), R.partition_counts_from_stats(stats)),
    ]:
        assert sorted(map(tuple, direct.collect()), key=repr) == sorted(
            map(tuple, stored.select(direct.columns).collect()), key=repr
        )
    from quadra.plans import pages as P


    page = P.quality_page(inc, stats)
    assert page["latest_record"].first() == Q.latest_record(inc).first()
    direct = R.partition_coverage(inc)
    assert sorted(map(tuple, direct.collect()), key=repr) == sorted(
        map(tuple, page["partitions"].select(direct.columns).collect()), key=repr
    )


def test_comparison_and_coverage_from_stats(spark, inc, tmp_path):
    from quadra.operators import quality as Q
    from quadra.operators import reports as R

    root = str(tmp_path / "stats2")
    lake.write_layer(Q.partition_stats(inc), root)
    stats = lake.read_layer(spark, root)
    chosen = R.resolve_comparison(R.partition_counts_from_stats(stats))
    assert chosen == R.resolve_comparison(R.partition_counts(inc))
    for city in (M.CITY, "CAMPINAS"):
        pages_of = [pages.comparison_page(inc, stats=s, city=city) for s in (None, stats)]
        assert len({str(p["kpis"].first()) for p in pages_of}) == 1
        cov = [pages.map_page(inc, M.Scope(year=2000, quarters=(1,), city=city), s)["coverage"].first() for s in (None, stats)]
        assert cov[0] == cov[1]
    direct = R.coverage(inc, 2000, (1, 3)).first().asDict()
    assert R.coverage_from_stats(stats, 2000, (1, 3)).first().asDict() == direct


def test_pages_with_statistics_table(spark, inc, tmp_path):
    from quadra.operators import quality as Q

    root = str(tmp_path / "stats3")
    lake.write_layer(Q.partition_stats(inc), root)
    stats = lake.read_layer(spark, root)
    scope = M.Scope(year=2000, quarters=(2, 4))
    with_stats = pages.statistics_page(inc, scope, stats)
    plain = pages.statistics_page(inc, scope)
    assert with_stats["coverage"].first() == plain["coverage"].first()
    assert with_stats["total"].first() == plain["total"].first()
    assert pages.map_page(inc, scope, stats)["coverage"].first() == plain["coverage"].first()
    assert pages.comparison_page(inc, stats=stats) is not None


def test_spelling_pairs_table_gives_same_variants(spark, inc, tmp_path):
    from quadra.operators import quality as Q

    root = str(tmp_path / "pairs")
    lake.write_layer(Q.spelling_pairs(inc), root)
    pairs = lake.read_layer(spark, root)
    direct = sorted(map(tuple, Q.district_variants(inc).collect()))
    assert sorted(map(tuple, Q.district_variants_from_pairs(pairs).collect())) == direct
    page = pages.quality_page(inc, spellings=pairs)
    assert sorted(map(tuple, page["variants"].collect())) == direct
