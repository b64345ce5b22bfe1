import random
import re

import pytest

from quadra.llm import linededup as D


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[k + 1 :] == b[k + 1 :] or a[k:] == b[k + 1 :] or a[k + 1 :] == b[k:]


def plain(rows):
    """rows sorted by id: what stays of every text."""
    seen, out = {}, []
    for i, text in rows:
        if text is None:
            out.append((i, None, 0, 0, 0))
            continue
        kept, counts = [], [0, 0, 0]
        for raw in text.split("\n"):
            line = re.sub(r"[\x20\x09-\x0D]+", " ", raw).strip(" ").lower()
            if not line:
                kept.append(raw)
                continue
            counts[0] += 1
            if line in seen:
                counts[1] += 1
                continue
            near = len(line) >= 20 and any(len(s) >= 20 and one_edit(s, line) for s in seen)
            seen[line] = True
            counts[2] += near
            if not near:
                kept.append(raw)
        out.append((i, "\n".join(kept), *counts))
    return out


def made(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(15, 45))) for _ in range(25)] + ["a" * 30, "ab" * 15]
    texts = []
    for _ in range(60):
        lines = []
        for _ in range(rng.randrange(6)):
            line = list(rng.choice(base))
            for _ in range(rng.randrange(3)):
                k = rng.randrange(len(line))
                line[k : k + rng.randrange(2)] = rng.choice(["", "x", "a", "b"])
            lines.append("".join(line).replace(" ", rng.choice([" ", "  ", "\t"])))
        texts.append("\n".join(lines + [""] * rng.randrange(2)))
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_equal_comparing_each_with_all_before(spark, seed):
    rows = made(seed)
    got = D.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == plain(rows)


def test_a_hot_line_and_many_lines_that_differ_in_one_place(spark):
    rows = [(k, f"the same line stands everywhere here\nthis line holds the number {k % 10} and no more") for k in range(300)]
    got = D.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == plain(rows)


def test_edges(spark, edge_docs, no_docs):
    got = D.dedup_lines(edge_docs).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert len(got) == edge_docs.count()
    assert by[3][0]["text"] is None and by[4][0]["text"] == "" and by[5][0]["text"] == " \n\t "
    assert (by[9][0]["text"], by[9][0]["n_exact"]) == ("one line here to repeat\nAnother Line", 4)
    assert sorted((r["n_lines"], r["n_exact"], r["text"]) for r in by[2]) == [(1, 1, ""), (1, 1, "")]
    assert by[8][0]["text"] == "x" * 300_000
    assert by[10][0]["text"] == "naïve café \U0001f600 straße\n\nend"
    assert D.dedup_lines(no_docs).count() == 0
