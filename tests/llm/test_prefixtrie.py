"""The prefix trie against a dictionary of prefixes, over blocks small enough to be merged more than once."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from quadra.llm import prefixtrie as P

SCHEMA = "conv_id long, turn long, role string, text string, seq string, words string, kind string, depth string"


def words(text):
    return len(re.findall(P.WORD, text))


def plain(convs):
    """Rows of the trie of ``{conv_id: [(role, text), ...]}``."""
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)

    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[c] for c in below) if below else 1
        own = (len(members[node]) - 1) * words(node[-1][1]) if node else 0
        saved[node] = own + sum(saved[c] for c in below)
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]), leaves[n], saved[n],
         hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest())
        for n, m in members.items()
    )


def plain_rebuilt(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            key = (turn is not None, turn or 0, role, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest())
            own[conv_id].append((key, (role, text)))
    turns = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    head = {c: zlib.crc32(str(c).encode()) % 4 for c in turns}
    return {c: turns.get(c - c % 20, [])[: head[c]] + turns[c][head[c] :] for c in turns}


def rows_of(df):
    return sorted(map(tuple, df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", df.columns[-1]).collect()), key=lambda r: tuple(x if x is not None else -1 for x in r))


def ordered(rows):
    return sorted(rows, key=lambda r: tuple(x if x is not None else -1 for x in r))


def conversations(spark, convs, parts=5):
    rows = [(c, k, r, t, *"wxyz") for c, turns in convs.items() for k, (r, t) in enumerate(turns)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


@pytest.mark.parametrize(("seed", "cells"), [(1, 40), (2, 90), (3, 1 << 20)])
def test_equals_a_dictionary_of_prefixes(spark, monkeypatch, seed, cells):
    random.seed(seed)
    convs = {}
    for c in range(0, 1500, 3):
        size = random.choice([1, 1, 2, 3, 5, 8])
        convs[c] = [(random.choice("ua"), "w " * random.choice([0, 1, 1, 2])) for _ in range(size)]
    hot = [("u", "same first turn")]
    convs |= {c: hot + [("a", "one reply")] * (c % 3) for c in range(2000, 2400)}
    seqs = P.sequences(P.turn_lists(conversations(spark, convs)))
    assert rows_of(P.prefix_trie(seqs, cells)) == ordered(plain(convs))


def test_long_runs_are_hashed_in_pieces(spark, monkeypatch):
    convs = {c: [("u", "hello there")] for c in range(1, 900)} | {c: [("u", "hello there"), ("a", f"{c % 2}")] for c in range(900, 1200)}
    seqs = P.sequences(P.turn_lists(conversations(spark, convs))).collect()
    seqs.sort(key=lambda r: (r.seq, r.conv_id))
    monkeypatch.setattr(P, "PIECE", 50)
    import pandas as pd

    def batches():
        for k in range(0, len(seqs), 70):
            yield pd.DataFrame([r.asDict() for r in seqs[k : k + 70]])

    pieces = []
    runs = list(P._runs(batches(), pieces))
    assert sorted(r.n for r in runs) == [150, 150, 899]
    assert max(len(p["ids"].split(",")) for p in pieces) <= 120
    frame = pd.DataFrame(sorted(pieces, key=lambda p: (p["end_key"], p["first_id"])))
    got = dict(pd.concat(P._joined_ids([frame[:5], frame[5:]])).itertuples(index=False))
    want = {hashlib.sha256(",".join(str(c) for c in ids).encode()).hexdigest() for ids in (range(1, 900), range(900, 1200, 2), range(901, 1200, 2))}
    assert set(got.values()) == want


def test_one_conversation_of_many_turns(spark):
    convs = {7: [("u", f"turn {k}") for k in range(3000)], 9: [("u", f"turn {k}") for k in range(2500)] + [("a", "end")]}
    assert rows_of(P.prefix_trie(P.sequences(P.turn_lists(conversations(spark, convs))), 64)) == ordered(plain(convs))


def test_edge_rows_and_the_rebuilt_heads(spark, tmp_path):
    rows = [
        (0, 0, "user", "a b"), (0, None, "user", "first, its turn is null"), (0, 2, None, None), (0, 2, "", ""),
        (20, 1, "user", "x"), (20, 1, "user", "x"), (None, 0, "user", "no conversation"), (21, 5, "user", "only one"),
        (39, 0, "assistant", " \t "), (39, 1, "assistant", "word " * 70_000), (45, 0, "user", "no base"), (46, 0, "user", "no base"),
        *[(c, k, "user", "the same") for c in range(60, 80) for k in range(4)],
    ]
    folder = tmp_path / "conversations.parquet"
    spark.createDataFrame([(*r, *"wxyz") for r in rows], SCHEMA).write.parquet(str(folder))
    assert rows_of(P.op11_prefix_trie(spark, str(tmp_path))) == ordered(plain(plain_rebuilt(rows)))


def test_no_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert P.prefix_trie(P.sequences(P.turn_lists(empty))).collect() == []
