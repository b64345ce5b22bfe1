"""Conversation prefix trie: union-find over neighbours' common prefixes, deepest first.

A conversation is the sequence of its turns' digests. The sequences are sorted
over the cluster; the common prefix of two neighbours is an edge of that depth.
A block of sorted sequences merges its edges in descending depth: each merge of
two components is a branching node, the turns between two branching nodes are
its unary nodes. Nodes on the path of a block's first or last sequence may have
members outside; every other node is whole and is written down. The block is
then contracted to those two sequences, which carry by depth what was counted
below them, and the contracted sequences of all blocks are sorted and merged in
the same way until one block holds them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadra.llm.common import WORD, bounded_batches, written

# Bytes of a turn's digest.
DIGEST = 16
# A block of sequences ends with this many prefixes, but holds LEAST sequences at least.
CELLS, LEAST = 1 << 20, 16
# Ids of one sequence that are joined to one piece of text.
PIECE = 1 << 16
NONE = hashlib.sha256(b"").hexdigest()
_HIGH = np.iinfo(np.int64).max
_COUNTS = ("n", "low", "children", "leaves", "saved")

_ROWS = (
    "kind string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends string, node_key string, block string, parent_key string, "
    "seq binary, words array<int>, n array<long>, low array<long>, children array<long>, leaves array<long>, saved array<long>, end_of array<string>, "
    "end_key string, first_id long, ids string"
)
NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends")


# --- conversations -> sequences ------------------------------------------------
def turn_lists(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: array of (digest as hex, words) in order of (turn, role, digest), nulls first.

    Null roles and texts are empty; a null conv_id is no conversation; repeated
    rows are turns of their own; other columns are ignored.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turn = F.struct(F.col("turn").alias("turn"), role.alias("role"), digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).alias("words"))
    lists = conversations.where(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return lists.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns"))


def sequences(lists: DataFrame) -> DataFrame:
    """conv_id, seq (digests one after the other), words: what :func:`prefix_trie` takes."""
    digests = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    return lists.select("conv_id", digests.alias("seq"), F.transform("turns", lambda t: t["words"]).alias("words"))


def regrown(lists: DataFrame, head: Column, base: Column, most: int) -> DataFrame:
    """Every conversation with its first ``head`` turns replaced by those of conversation ``base``.

    ``head`` is at most ``most``; a base that is not there gives no turns.
    """
    heads = lists.select(F.col("conv_id").alias("_base"), F.slice("turns", 1, most).alias("_first"))
    own = lists.select("conv_id", "turns", head.alias("_h"), base.alias("_of"))
    both = own.join(heads, F.col("_of") == F.col("_base"), "left")
    first = F.coalesce(F.slice("_first", F.lit(1), F.col("_h")), F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("_h") + 1, F.greatest(F.size("turns") - F.col("_h"), F.lit(0)))
    return both.select("conv_id", F.concat(first, rest).alias("turns"))


# --- one block -------------------------------------------------------------------
def common_prefixes(turns: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Turns that neighbouring sequences share at their start."""
    shorter = np.minimum(lens[:-1], lens[1:])
    at = np.cumsum(lens) - lens
    edge = np.repeat(np.arange(len(shorter)), shorter)
    j = np.arange(len(edge)) - (np.cumsum(shorter) - shorter)[edge]
    differ = (turns[at[edge] + j] != turns[at[edge + 1] + j]).any(axis=1) if len(edge) else np.zeros(0, bool)
    shared = shorter.copy()
    np.minimum.at(shared, edge[differ], j[differ])
    return shared


def merged(lens: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, ...]:
    """Union-find over the edges in descending depth: depth, first row, last row and parent's depth of each branching or end node."""
    rows = len(lens)
    depth, lo, hi, up, same = lens.tolist(), list(range(rows)), list(range(rows)), [-1] * rows, list(range(rows))
    root, top = list(range(rows)), list(range(rows))

    def find(links: list[int], i: int) -> int:
        while links[i] != i:
            links[i] = links[links[i]]
            i = links[i]
        return i

    for i in np.argsort(-shared, kind="stable").tolist():
        a, b, at = find(root, i), find(root, i + 1), int(shared[i])
        x, y = top[a], top[b]
        if depth[x] == at and depth[y] == at:
            same[y] = node = x
        elif depth[x] == at:
            up[y] = node = x
        elif depth[y] == at:
            up[x] = node = y
        else:
            node = len(depth)
            depth.append(at), lo.append(0), hi.append(0), up.append(-1), same.append(node)
            up[x] = up[y] = node
        lo[node], hi[node] = min(lo[x], lo[y]), max(hi[x], hi[y])
        root[b], top[a] = a, node
    nodes = [k for k in range(len(depth)) if same[k] == k]
    above = [depth[find(same, up[k])] if up[k] >= 0 else -1 for k in nodes]
    return (np.array([depth[k] for k in nodes]), np.array([lo[k] for k in nodes]), np.array([hi[k] for k in nodes]), np.array(above))


def _keys(seq: bytes) -> list[str]:
    """A digest of every prefix, the empty one first."""
    whole = hashlib.md5(b"")
    keys = [whole.hexdigest()]
    for k in range(0, len(seq), DIGEST):
        whole.update(seq[k : k + DIGEST])
        keys.append(whole.copy().hexdigest())
    return keys


def forest(seqs: list[bytes], words: list, counts: dict[str, np.ndarray], end_of: np.ndarray, level: int, last: bool) -> list[pd.DataFrame]:
    """Whole nodes of a block of sorted sequences, and the block contracted to its first and last sequence.

    ``counts`` and ``end_of`` hold a value for every prefix of every sequence, in
    order. With ``last`` the block is all there is and every node is whole.
    """
    rows = len(seqs)
    lens = np.array([len(s) // DIGEST for s in seqs])
    turns = np.frombuffer(b"".join(seqs), dtype=np.uint64).reshape(-1, 2)
    size = lens + 1
    row = np.repeat(np.arange(rows), size)
    first = np.cumsum(size) - size
    depth = np.arange(len(row)) - first[row]
    word = np.zeros(len(row), np.int64)
    word[depth > 0] = np.concatenate([np.zeros(0, np.int64), *words])

    # Nodes by (depth, first row); at each depth they part the prefixes.
    d, lo, hi, above = merged(lens, common_prefixes(turns, lens))
    times = d - above
    k = np.repeat(np.arange(len(d)), times)
    d, lo, hi = (above + 1)[k] + np.arange(len(k)) - (np.cumsum(times) - times)[k], lo[k], hi[k]
    order = np.lexsort((lo, d))
    d, lo, hi = d[order], lo[order], hi[order]
    cells = np.lexsort((row, depth))
    place, spot = d * rows + lo, (depth * rows + row)[cells]
    start = np.searchsorted(spot, place)
    total = {c: (np.minimum if c == "low" else np.add).reduceat(counts[c][cells], start) for c in _COUNTS}
    ends = np.full(len(d), None, object)
    named = np.flatnonzero(end_of[cells] != None)  # noqa: E711
    ends[np.searchsorted(start, named, side="right") - 1] = end_of[cells][named]
    word = word[cells][start]
    parent = np.searchsorted(place, (d - 1) * rows + lo, side="right") - 1
    is_open = ((lo == 0) | (hi == rows - 1)) & (not last)

    edges = np.searchsorted(d, np.arange(d[-1] + 2))
    for at in range(int(d[-1]), -1, -1):
        here = np.arange(edges[at], edges[at + 1])
        here = here[~is_open[here]]
        total["leaves"][here] = np.where(total["children"][here] == 0, 1, total["leaves"][here])
        total["saved"][here] += (total["n"][here] - 1) * word[here]
        if at:
            np.add.at(total["children"], parent[here], 1)
            np.add.at(total["leaves"], parent[here], total["leaves"][here])
            np.add.at(total["saved"], parent[here], total["saved"][here])

    keys = {r: _keys(seqs[r]) for r in ({0, rows - 1} if level == 0 else set(lo.tolist()) | {0, rows - 1})}
    done = np.flatnonzero(~is_open)
    waits = (d[done] > 0) & is_open[parent[done]]
    up = parent[done]
    known = (d[done] > 0) & ~waits
    whole = pd.DataFrame({
        "kind": "node", "conv_id": total["low"][done], "depth": d[done],
        "parent_conv_id": pd.Series(np.where(known, total["low"][up], 0), dtype="Int64").mask(~known),
        "n_convs": total["n"][done], "n_children": total["children"][done], "n_leaves": total["leaves"][done], "saved_tokens": total["saved"][done],
        "ends": [e or NONE for e in ends[done]],
        "node_key": None if level == 0 else [keys[r][n] for r, n in zip(lo[done].tolist(), d[done].tolist(), strict=True)],
        "block": f"{level}-{keys[0][-1]}",
        "parent_key": [keys[0 if a == 0 else rows - 1][n - 1] if w else None for a, n, w in zip(lo[up].tolist(), d[done].tolist(), waits.tolist(), strict=True)],
    })
    if last:
        return [whole]
    # The path of the last sequence leaves out what it shares with the first one's.
    spines = []
    for r in sorted({0, rows - 1}):
        on = np.searchsorted(place, np.arange(lens[r] + 1) * rows + r, side="right") - 1
        ours = (lo[on] == 0) == (r == 0)
        spines.append({
            "kind": "spine", "seq": seqs[r], "words": words[r],
            **{c: np.where(ours, total[c][on], _HIGH if c == "low" else 0) for c in _COUNTS}, "end_of": np.where(ours, ends[on], None),
        })
    return [f for f in (whole, pd.DataFrame(spines)) if len(f)]


def _framed(found: pd.DataFrame) -> pd.DataFrame:
    names = [c.split()[0] for c in _ROWS.split(", ")]
    return found.assign(**{c: None for c in names if c not in found.columns})[names]


# --- streams of sorted rows ------------------------------------------------------
class _Run:
    """Conversations of one sequence, in order of their ids."""

    def __init__(self, seq: bytes, words: np.ndarray, first: bool):
        self.seq, self.words, self.first = seq, words, first
        self.n, self.low, self.ids, self.pieced = 0, _HIGH, [], first

    def piece(self) -> dict:
        """The ids so far as a piece of text: those of a run that may go on elsewhere are put together afterwards."""
        found = {"kind": "piece", "end_key": hashlib.md5(self.seq).hexdigest(), "first_id": self.ids[0], "ids": ",".join(map(str, self.ids))}
        self.ids, self.pieced = [], True
        return found

    def end(self) -> str:
        if self.pieced:
            return "key:" + hashlib.md5(self.seq).hexdigest()
        return hashlib.sha256(",".join(map(str, self.ids)).encode()).hexdigest()


def _runs(batches: Iterable[pd.DataFrame], pieces: list[dict]) -> Iterator[_Run]:
    """Runs of a partition sorted by (seq, conv_id); pieces of the first, the last and of long ones go to ``pieces``."""
    run = None
    for pdf in batches:
        seqs, ids, words = pdf["seq"].tolist(), pdf["conv_id"].to_numpy(np.int64), pdf["words"].tolist()
        cuts = [0, *(k for k in range(1, len(seqs)) if seqs[k] != seqs[k - 1]), len(seqs)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if run is None or run.seq != seqs[a]:
                if run is not None:
                    if run.pieced and run.ids:
                        pieces.append(run.piece())
                    yield run
                run = _Run(seqs[a], np.asarray(words[a], np.int64), run is None)
            run.n += b - a
            run.low = min(run.low, int(ids[a]))
            for at in range(a, b, PIECE):
                run.ids += ids[at : min(b, at + PIECE)].tolist()
                if len(run.ids) >= PIECE:
                    pieces.append(run.piece())
    if run is not None:
        if run.ids:
            pieces.append(run.piece())
        yield run


def _sequence_blocks(most: int):
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces: list[dict] = []
        block: list[_Run] = []

        def flush() -> Iterator[pd.DataFrame]:
            if block:
                sizes = np.array([len(r.words) + 1 for r in block])
                n, low = np.array([r.n for r in block]), np.array([r.low for r in block])
                zero = np.zeros(sizes.sum(), np.int64)
                counts = {"n": np.repeat(n, sizes), "low": np.repeat(low, sizes), "children": zero, "leaves": zero, "saved": zero}
                end_of = np.full(len(zero), None, object)
                end_of[np.cumsum(sizes) - 1] = [r.end() for r in block]
                yield from map(_framed, forest([r.seq for r in block], [r.words for r in block], counts, end_of, 0, False))
            if pieces:
                yield _framed(pd.DataFrame(pieces))
            block.clear(), pieces.clear()

        cells = 0
        for run in _runs(batches, pieces):
            block.append(run)
            cells += len(run.words) + 1
            if cells >= most and len(block) >= LEAST:
                yield from flush()
                cells = 0
        yield from flush()

    return build


def _spine_blocks(level: int, most: int, last: bool):
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block: list[tuple] = []

        def flush() -> Iterator[pd.DataFrame]:
            if block:
                seqs, words, *rest = zip(*block, strict=True)
                *counts, end_of = [np.concatenate(x) for x in rest]
                named = {c: x.astype(np.int64) for c, x in zip(_COUNTS, counts, strict=True)}
                yield from map(_framed, forest(list(seqs), list(words), named, end_of.astype(object), level, last))
            block.clear()

        cells = 0
        for pdf in batches:
            for seq, words, *rest in zip(*(pdf[c] for c in ("seq", "words", *_COUNTS, "end_of")), strict=True):
                block.append((seq, np.asarray(words, np.int64), *map(np.asarray, rest)))
                cells += len(words) + 1
                if not last and cells >= most and len(block) >= LEAST:
                    yield from flush()
                    cells = 0
        yield from flush()

    return build


def _joined_ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """end_key, digest of its pieces one after the other: a stream, a piece at a time."""
    key = digest = None
    for pdf in batches:
        out = []
        for end_key, ids in zip(pdf["end_key"], pdf["ids"], strict=True):
            if end_key != key:
                if key is not None:
                    out.append((key, digest.hexdigest()))
                key, digest = end_key, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if out:
            yield pd.DataFrame(out, columns=["end_key", "digest"])
    if key is not None:
        yield pd.DataFrame([(key, digest.hexdigest())], columns=["end_key", "digest"])


# --- the operator ------------------------------------------------------------------
def prefix_trie(seqs: DataFrame, cells: int = CELLS) -> DataFrame:
    """A row per distinct prefix of the sequences ``(conv_id, seq, words)``, the empty one included.

    conv_id (least member), depth, parent_conv_id (null at the root), n_convs,
    n_children, n_leaves, saved_tokens (words of a prefix's last turn for every
    member but one, over the subtree), ends (sha-256 of the ids that end there,
    ascending, joined by commas). Sequences without turns are members of the
    root. No sequences give no rows. One conversation's digests (16 bytes a
    turn) are one row; equal sequences are a run that may spread over many
    tasks. ``cells`` bounds the prefixes of a block.
    """
    seqs = bounded_batches(written(seqs, "sequences"))
    spark = seqs.sparkSession
    size, rows, level, tables = F.octet_length("seq") / DIGEST + 1, seqs, 0, []
    last = False
    while not last:
        if level == 0:
            dealt = rows.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
            found = dealt.mapInPandas(_sequence_blocks(cells), _ROWS)
        else:
            n, total = rows.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
            last = total <= cells or n <= LEAST
            dealt = rows.repartition(1) if last else rows.repartitionByRange(int(total // cells) + 1, "seq")
            found = dealt.sortWithinPartitions("seq").mapInPandas(_spine_blocks(level, cells, last), _ROWS)
        tables.append(written(found, f"trie-{level}"))
        rows = tables[-1].where("kind = 'spine'").select("seq", "words", *_COUNTS, "end_of")
        level += 1
    nodes = tables[0].where("kind = 'node'")
    for table in tables[1:]:
        nodes = nodes.unionByName(table.where("kind = 'node'"))
    return _with_ends(_with_parents(nodes), tables[0].where("kind = 'piece'").select("end_key", "first_id", "ids"))


def _with_parents(nodes: DataFrame) -> DataFrame:
    """A node whose parent was contracted gets the parent's id, block by block (a hot parent is found once a block)."""
    ready, waiting = nodes.where(F.col("parent_key").isNull()), nodes.where(F.col("parent_key").isNotNull())
    keys = nodes.where(F.col("node_key").isNotNull()).select(F.col("node_key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    found = waiting.select("block", "parent_key").distinct().join(keys, "parent_key")
    late = waiting.join(found, ["block", "parent_key"]).withColumn("parent_conv_id", F.col("_parent"))
    return ready.select(*NODE).unionByName(late.select(*NODE))


def _with_ends(nodes: DataFrame, pieces: DataFrame) -> DataFrame:
    """Digests of the ids that were written in pieces."""
    digests = pieces.repartition("end_key").sortWithinPartitions("end_key", "first_id").mapInPandas(_joined_ids, "end_key string, digest string")
    pending = F.col("ends").startswith("key:")
    late = nodes.where(pending).withColumn("end_key", F.substring("ends", 5, 32)).join(digests, "end_key")
    return nodes.where(~pending).unionByName(late.withColumn("ends", F.col("digest")).select(*NODE))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, each with its first crc32(conv_id) mod 4 turns taken from the last conversation whose id 20 divides."""
    lists = written(turn_lists(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "turns")
    conv = F.col("conv_id")
    rebuilt = regrown(lists, (F.crc32(conv.cast("string")) % 4).cast("int"), conv - conv % 20, 3)
    return prefix_trie(sequences(rebuilt)).withColumnRenamed("ends", "ends_sha256")


OP11_SQL = r"""
WITH texts AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT conv_id, turn, role, md5(length(role) || ':' || role || text) AS digest,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM texts),
own AS (
  SELECT conv_id, digest, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, digest) AS pos FROM turns),
crcs AS (
  SELECT conv_id, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), CAST(range(8) AS BIGINT[])),
      lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)) AS crc
  FROM (SELECT DISTINCT conv_id FROM own)),
heads AS (SELECT conv_id, xor(crc, 4294967295) % 4 AS h FROM crcs),
grown AS (
  SELECT h.conv_id, pos, digest, words FROM heads h JOIN own o ON o.conv_id = h.conv_id AND pos > h
  UNION ALL
  SELECT h.conv_id, pos, digest, words FROM heads h JOIN own o ON o.conv_id = h.conv_id - h.conv_id % 20 AND pos <= h),
lists AS (
  SELECT conv_id, list(digest ORDER BY pos) AS digests, list(words ORDER BY pos) AS words FROM grown GROUP BY conv_id),
seqs AS (
  SELECT conv_id, coalesce(digests, []) AS digests, coalesce(words, []) AS words FROM heads LEFT JOIN lists USING (conv_id)),
spread AS (
  SELECT conv_id, digests, words, unnest(range(len(digests) + 1)) AS depth FROM seqs),
prefixes AS (
  SELECT conv_id, depth, md5(array_to_string(digests[1:depth], '')) AS key,
    CASE WHEN depth > 0 THEN md5(array_to_string(digests[1:depth - 1], '')) END AS parent,
    CASE WHEN depth > 0 THEN words[depth] ELSE 0 END AS words, depth = len(digests) AS ends FROM spread),
nodes AS (
  SELECT depth, key, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(words) AS saved,
    sha256(coalesce(string_agg(CASE WHEN ends THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM prefixes GROUP BY depth, key),
children AS (SELECT depth - 1 AS depth, parent AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY depth, parent),
counted AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (depth, key)),
below AS (
  SELECT p.depth, p.key, sum(c.saved) AS saved_tokens, count_if(c.n_children = 0) AS n_leaves
  FROM counted c JOIN prefixes p ON p.conv_id = c.conv_id AND p.depth <= c.depth GROUP BY p.depth, p.key)
SELECT c.conv_id, c.depth, u.conv_id AS parent_conv_id, c.n_convs, c.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN below b ON b.depth = c.depth AND b.key = c.key
LEFT JOIN nodes u ON u.depth = c.depth - 1 AND u.key = c.parent
"""
