import re

import pytest

from quadra.llm import mixing as M
from quadra.llm.common import WORD


def water(sizes, share=1.5, most=2.0, weights=(3, 1, 2)):
    """Targets by resharing the excess until no source is above its cap."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, rest = {}, set(names), share * sum(sizes.values())
    while free:
        level = rest / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > most * sizes[s]}
        if not full:
            target.update({s: level * weight[s] for s in free})
            break
        target.update({s: most * sizes[s] for s in full})
        rest -= sum(most * sizes[s] for s in full)
        free -= full
    return target


def mixed(docs):
    rows = M.keyed(docs, docs["doc_id"])
    return M.with_copies(rows, M.source_cuts(rows, 1.5, 2.0)).collect()


def test_sources_come_near_their_targets(spark):
    docs = spark.createDataFrame(
        [(i, "w " * (1 + i * 7 % 40), None if i % 11 == 0 else f"s{i % 11 % 6}" if i % 3 else "s1") for i in range(3000)],
        "doc_id long, text string, source string",
    )
    rows = mixed(docs)
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    target = water(sizes)
    for s, t in target.items():
        own = [r for r in rows if r["source"] == s]
        assert own[0]["target"] == pytest.approx(t) and own[0]["source_size"] == sizes[s]
        assert abs(sum(r["size"] * r["copies"] for r in own) - t) <= 20
    assert {r["copies"] for r in rows} <= {0, 1, 2}
    again = mixed(docs.repartition(5))
    assert sorted((r["doc_id"], r["copies"]) for r in rows) == sorted((r["doc_id"], r["copies"]) for r in again)


def test_null_ids_are_told_apart_by_their_texts(spark):
    docs = spark.createDataFrame([(None, f"some words {k} here", "a") for k in range(2000)] + [(None, "copy", "b")] * 500 + [(1, "x " * 90_000, "b")], "doc_id long, text string, source string")
    rows = M.keyed(docs, docs["doc_id"]).collect()
    assert len({r["class"] for r in rows if r["source"] == "a"}) > 500 and len({r["key"] for r in rows if r["source"] == "a"}) == 2000
    found = mixed(docs)
    assert len(found) == docs.count() and len({r["copies"] for r in found if r["tie"]["digest"] == found[-1]["tie"]["digest"]}) == 1


def test_fraction_is_a_prefix_by_key(spark):
    docs = spark.createDataFrame([(i, "a b c", "x" if i % 4 else "y") for i in range(400)], "doc_id long, text string, source string")
    for source in "xy":
        own = sorted((r for r in mixed(docs) if r["source"] == source), key=lambda r: r["key"])
        copies = [r["copies"] for r in own]
        assert copies == sorted(copies, reverse=True)


def test_noisy_documents_are_taken_less(spark):
    texts = ["some plain words of prose", "### 123 || 999 $$$ 5"]
    docs = spark.createDataFrame([(i, texts[i % 2], "abc"[i // 2 % 3]) for i in range(4000)], "doc_id long, text string, source string")
    rows = mixed(docs)
    taken = [sum(r["copies"] for r in rows if r["doc_id"] % 2 == k) for k in (0, 1)]
    assert taken[0] > 1.2 * taken[1]


def test_edges(edge_docs, no_docs):
    rows = mixed(edge_docs)
    assert len(rows) == edge_docs.count()
    words = {d["doc_id"]: len(re.findall(WORD, d["text"] or "")) for d in edge_docs.collect() if d["doc_id"] is not None}
    assert all(r["size"] == words[r["doc_id"]] for r in rows if r["doc_id"] is not None)
    assert all(r["copies"] <= 2 for r in rows)
    out = M.mix(edge_docs)
    assert out.columns == edge_docs.columns
    assert out.count() == sum(r["copies"] for r in rows)
    assert M.mix(no_docs).count() == 0 and mixed(no_docs) == []


def test_one_empty_source(spark):
    docs = spark.createDataFrame([(1, "", None), (2, None, None)], "doc_id long, text string, source string")
    assert [(r["target"], r["size"]) for r in mixed(docs)] == [(0.0, 0), (0.0, 0)]
