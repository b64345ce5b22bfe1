"""N-gram Jaccard join of all documents by chosen paths.

A document is the set of its 5-word shingles. A sampled shared token is the
minimum of the set under a random hash: two sets share it with a probability
equal to their similarity. Every set goes down one path for each of ``runs``
tokens; sets that meet on a path are in one bucket. A small bucket is compared
by brute force. A larger one (a passage many documents share) is split again on
the next ``runs`` tokens, if that at least halves the pairs to compare; else (a
group of near copies, which no token parts) it is compared in blocks,
spread over tasks. A link is lost only if none of the 8 tokens agrees on a
level, 0.2 ** 8 = 0.0003 % at similarity 0.8.

A pair belongs to the first path on which it meets, so it is compared exactly
once and links are counted where they are found: no pair is ever a row.
Equal texts are joined once, as one text with its number of copies.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadra.llm.common import WORD, bounded_batches, documents, find_words, frozen, groups_of, packed, text_key, written
from quadra.llm.components import components


@dataclass(frozen=True)
class Paths:
    words: int = 5
    similarity: float = 0.8
    recall: float = 0.99999
    hashes: int = 64
    # Sets a bucket may hold to be compared in one piece.
    block: int = 1024
    seed: int = 9

    @property
    def runs(self) -> int:
        """Tokens a level, for the wanted recall at the least similarity."""
        return int(np.ceil(np.log(1 - self.recall) / np.log(1 - self.similarity)))

    @property
    def agreeing(self) -> int:
        """Hashes of which a linked pair shares fewer with a chance below 1e-8 (six deviations)."""
        s, n = self.similarity, self.hashes
        return int(s * n - 6 * np.sqrt(n * s * (1 - s)))


class WordCodes(dict):
    """64-bit codes of words, remembered while there is room."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        code = self[word] = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return code


_codes = WordCodes()


def shingles(text: str | None, words: int) -> np.ndarray:
    """Codes of a text's runs of ``words`` words, repeats included; a shorter text is one shingle, one without words none."""
    found = find_words(text or "")
    if not found:
        return np.zeros(0, dtype=np.uint64)
    code = np.fromiter(map(_codes.__getitem__, found), dtype=np.uint64, count=len(found))
    n = min(words, len(code))
    total = np.zeros(len(code) - n + 1, dtype=np.uint64)
    for k in range(n):
        total = total * np.uint64(0x9E3779B97F4A7C15) + code[k : k + len(total)]
    total ^= total >> np.uint64(31)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return total ^ (total >> np.uint64(29))


def signatures(texts: pd.Series, paths: Paths) -> list[np.ndarray | None]:
    """The least code of a text's shingles under each hash (int32); None without words."""
    rng = np.random.default_rng(paths.seed)
    odd = rng.integers(0, 1 << 63, paths.hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    flip = rng.integers(0, 1 << 63, paths.hashes, dtype=np.uint64)
    out: list[np.ndarray | None] = [None] * len(texts)

    def finish(own: list[np.ndarray], rows: list[int]) -> None:
        if not own:
            return
        joined = np.concatenate(own)
        starts = np.cumsum([0, *map(len, own[:-1])])
        least = np.empty((len(own), paths.hashes), dtype=np.int32)
        for k in range(paths.hashes):
            least[:, k] = (np.minimum.reduceat((joined ^ flip[k]) * odd[k], starts) >> np.uint64(32)).astype(np.uint32).view(np.int32)
        for row, values in zip(rows, least, strict=True):
            out[row] = values

    own, rows, size = [], [], 0
    for row, text in enumerate(texts):
        codes = shingles(text, paths.words)
        if len(codes):
            own.append(codes)
            rows.append(row)
            size += len(codes)
        if size > 1 << 17:
            finish(own, rows)
            own, rows, size = [], [], 0
    finish(own, rows)
    return out


def sketched(docs: DataFrame, paths: Paths) -> DataFrame:
    """doc_id, k1, k2 (128 bits of the text) and sig of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sketch(batches):
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "k1": pdf["k1"], "k2": pdf["k2"], "sig": signatures(pdf["text"], paths)})

    rows = bounded_batches(docs).select("doc_id", "text", *text_key(F.col("text")))
    return written(rows.mapInPandas(sketch, f"doc_id {kind}, k1 long, k2 long, sig array<int>"), "sketches")


def _tokens(level: int, paths: Paths):
    return F.posexplode(F.slice("sig", level * paths.runs + 1, paths.runs))


def _met(rows: DataFrame) -> DataFrame:
    """Rows whose bucket holds two sets or more, with their number n."""
    counts = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").withColumnRenamed("bucket", "met")
    return rows.join(counts, F.col("bucket") == F.col("met")).drop("met")


def blocks(texts: DataFrame, paths: Paths) -> DataFrame:
    """block, part, cross, path, text of all places where sets are compared.

    ``texts`` has row and sig. In a crossed block only sets of different parts
    are compared.
    """
    first = texts.select("row", _tokens(0, paths).alias("k", "token"))
    rows = _met(first.select("row", F.xxhash64("k", "token").alias("bucket"), F.array("k").alias("path")))
    rows = frozen(rows)
    out, whole, level = [rows.where(F.col("n") <= paths.block)], [], 1
    large = rows.where(F.col("n") > paths.block)
    while not large.isEmpty():
        if (level + 1) * paths.runs > paths.hashes:
            whole.append(large)
            break
        sets = large.join(texts.select(F.col("row").alias("of"), F.slice("sig", level * paths.runs + 1, paths.runs).alias("next")), F.col("row") == F.col("of"))
        sets = frozen(sets.drop("of"))
        # Pairs that each of the next tokens leaves together, against all pairs of the bucket.
        tokens = [f"token{k}" for k in range(paths.runs)]
        left = sets.select("bucket", "n", *[F.get("next", F.lit(k)).alias(t) for k, t in enumerate(tokens)])
        left = left.groupingSets([["bucket", "n", t] for t in tokens], "bucket", "n", *tokens).agg(F.count("*").alias("same"))
        left = left.groupBy("bucket", "n").agg(F.sum(F.col("same") * F.col("same")).alias("pairs"))
        gain = frozen(left.where(2 * F.col("pairs") < F.col("n") * F.col("n")).select(F.col("bucket").alias("in")))
        whole.append(large.join(gain, F.col("bucket") == F.col("in"), "left_anti"))
        split = sets.join(gain, F.col("bucket") == F.col("in")).select("row", "bucket", "path", F.posexplode("next").alias("k", "token"))
        split = split.select("row", F.xxhash64("bucket", "k", "token").alias("bucket"), F.array_append("path", F.col("k")).alias("path"))
        rows = frozen(_met(split))
        out.append(rows.where(F.col("n") <= paths.block))
        large = rows.where(F.col("n") > paths.block)
        level += 1
    small = [r.select(F.col("bucket").alias("block"), F.lit(0).alias("part"), F.lit(False).alias("cross"), "path", "row") for r in out]
    for r in whole:
        # A row is in one block with each part: with its own, and crossed with every other.
        parts = F.ceil(F.col("n") / paths.block).cast("int")
        r = r.withColumn("part", F.pmod(F.xxhash64("row"), parts).cast("int"))
        r = r.withColumn("with", F.explode(F.sequence(F.lit(0), parts - 1)))
        pair = F.xxhash64("bucket", F.least("part", "with"), F.greatest("part", "with"))
        cross = F.col("part") != F.col("with")
        small.append(r.select(pair.alias("block"), "part", cross.alias("cross"), "path", "row"))
    return reduce(DataFrame.unionByName, small)


def owned(a: np.ndarray, b: np.ndarray, path: np.ndarray, paths: Paths) -> np.ndarray:
    """Which pairs (rows of a with rows of b) do not meet on an earlier path."""
    free = np.ones((len(a), len(b)), dtype=bool)
    for level, k in enumerate(path):
        for j in range(level * paths.runs, level * paths.runs + int(k)):
            free &= a[:, j][:, None] != b[:, j][None, :]
    return free


def candidates(a: np.ndarray, b: np.ndarray, path: np.ndarray, paths: Paths, same: bool) -> np.ndarray:
    """Owned pairs that share enough hashes to be linked."""
    equal = np.zeros((len(a), len(b)), dtype=np.uint8)
    for k in range(paths.hashes):
        equal += a[:, k][:, None] == b[:, k][None, :]
    found = (equal >= paths.agreeing) & owned(a, b, path, paths)
    return np.triu(found, 1) if same else found


def sides(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, bool]:
    """Positions of the sets to compare with each other, and whether they are the same."""
    part = pdf["part"].to_numpy()
    if not pdf["cross"].iloc[0]:
        every = np.arange(len(pdf))
        return every, every, True
    return np.flatnonzero(part == part.min()), np.flatnonzero(part != part.min()), False


def overlap(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections, from a 0/1 matrix of the shared codes, some thousand columns at a time."""
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    codes, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    of, column = of[shared], (np.cumsum(times > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    of, column = of[order], column[order]
    total = np.zeros((len(left), len(right)), dtype=np.float32)
    width = 4096
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [begin, begin + width])
        x = np.zeros((len(sets), width), dtype=np.float32)
        x[of[lo:hi], column[lo:hi] - begin] = 1
        total += x[left] @ x[right].T
    return total


def linked(pdf: pd.DataFrame, paths: Paths) -> pd.DataFrame | None:
    """Per set of a block with a link here: links, documents behind them, and the least row it is connected with."""
    pdf = pdf.drop_duplicates(["row"])
    left, right, same = sides(pdf)
    if not len(left) or not len(right):
        return None
    sig = np.stack(pdf["sig"].to_numpy())
    pairs = candidates(sig[left], sig[right], np.asarray(pdf["path"].iloc[0]), paths, same)
    if not pairs.any():
        return None
    sets = [np.unique(shingles(t, paths.words)) for t in pdf["text"]]
    size = np.array([len(s) for s in sets])
    common = overlap(sets, left, right)
    either = size[left][:, None] + size[right][None, :] - common
    pairs &= common >= paths.similarity * either - 1e-6
    if not pairs.any():
        return None
    near = np.zeros((len(pdf), len(pdf)), dtype=bool)
    near[np.ix_(left, right)] = pairs
    near |= near.T
    rows, copies = pdf["row"].to_numpy(), pdf["copies"].to_numpy()
    label = rows.copy()
    top = np.iinfo(np.int64).max
    while True:
        least = np.minimum(label, np.where(near, label[None, :], top).min(axis=1))
        if (least == label).all():
            break
        label = least
    own = near.any(axis=1)
    return pd.DataFrame({"row": rows, "links": near.sum(axis=1), "documents": near @ copies, "least": label})[own]


def members(texts: DataFrame, sketches: DataFrame, paths: Paths) -> DataFrame:
    """k1, k2, rep, copies, root, links, documents of every distinct text that has words.

    rep is the least doc_id of a text, root the same for all texts that links
    connect, links and documents the texts and documents linked to it.
    """
    reps = written(
        sketches.where("sig is not null")
        .groupBy("k1", "k2")
        .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("sig").alias("sig"))
        .withColumn("row", F.monotonically_increasing_id()),
        "texts",
    )
    places = blocks(reps.select("row", "sig"), paths)
    sets = reps.select(F.col("row").alias("of"), "sig", "copies", "k1", "k2", "rep")
    places = places.join(sets, F.col("row") == F.col("of")).drop("of")

    def likely(batches):
        for pdf in groups_of(batches, "block"):
            left, right, same = sides(pdf)
            if not len(left) or not len(right) or len(pdf) < 2:
                continue
            sig = np.stack(pdf["sig"].to_numpy())
            pairs = candidates(sig[left], sig[right], np.asarray(pdf["path"].iloc[0]), paths, same)
            if pairs.any():
                keep = np.unique(np.concatenate([left[pairs.any(axis=1)], right[pairs.any(axis=0)]]))
                yield pdf.iloc[keep]

    places = places.repartition("block").sortWithinPartitions("block").mapInPandas(likely, places.schema)
    places = places.withColumnsRenamed({"k1": "p1", "k2": "p2"})
    with_text = places.join(
        texts.select(F.col("doc_id").alias("id"), "text", *text_key(F.col("text"))),
        (F.col("p1") == F.col("k1")) & (F.col("p2") == F.col("k2")) & F.col("rep").eqNullSafe(F.col("id")),
    ).select("block", "part", "cross", "path", "row", "sig", "copies", "text")

    def verify(batches):
        for pdf in groups_of(batches, "block"):
            found = linked(pdf, paths)
            if found is not None:
                yield found

    found = with_text.repartition("block").sortWithinPartitions("block")
    found = written(found.mapInPandas(verify, "row long, links long, documents long, least long"), "links")
    counts = found.groupBy(F.col("row").alias("counted")).agg(F.sum("links").alias("links"), F.sum("documents").alias("documents"))
    roots = components(found.select(F.col("row").alias("u"), F.col("least").alias("v")))
    return (
        reps.drop("sig")
        .join(roots, F.col("row") == F.col("u"), "left")
        .join(counts, F.col("row") == F.col("counted"), "left")
        .select(
            "k1", "k2", "rep", "copies", F.coalesce("v", "row").alias("root"),
            F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("documents", F.lit(0)).alias("documents"),
        )
    )


def join(docs: DataFrame, paths: Paths = Paths()) -> DataFrame:
    """One row for each of ``docs``: doc_id, class_id, n_links, n_text_links, n_copies.

    A link joins two documents whose shingle sets have a Jaccard similarity
    of ``similarity`` or more. n_links counts the other documents linked to
    this one, copies included; n_text_links the other texts; n_copies the
    documents with an equal text, this one included. class_id is the least
    doc_id of all that links connect, directly or not.

    A null text is an empty one; texts without words link to nothing, not
    even to each other, and are classes of their own (class_id doc_id,
    n_copies 1). A text of fewer than five words is one shingle. Repeated
    rows are copies. Null ids are ignored when the least is taken; a class of
    null ids has a null class_id. No rows give no rows; other columns are
    ignored.
    """
    texts = docs.select("doc_id", "text")
    sketches = sketched(texts, paths)
    found = members(texts, sketches, paths)
    names = found.groupBy(F.col("root").alias("named")).agg(F.min("rep").alias("class_id"))
    found = found.join(names, F.col("root") == F.col("named")).select(
        F.col("k1").alias("m1"),
        F.col("k2").alias("m2"),
        "class_id",
        (F.col("documents") + F.col("copies") - 1).alias("n_links"),
        F.col("links").alias("n_text_links"),
        F.col("copies").alias("n_copies"),
    )
    with_words = sketches.where("sig is not null").select("doc_id", "k1", "k2")
    joined = with_words.join(found, (F.col("k1") == F.col("m1")) & (F.col("k2") == F.col("m2")))
    alone = sketches.where("sig is null").select(
        "doc_id",
        F.col("doc_id").alias("class_id"),
        *[F.lit(n).cast("long").alias(c) for c, n in (("n_links", 0), ("n_text_links", 0), ("n_copies", 1))],
    )
    return joined.select("doc_id", "class_id", "n_links", "n_text_links", "n_copies").unionByName(alone)


def one_of_each(docs: DataFrame, paths: Paths = Paths()) -> DataFrame:
    """``docs`` with one row of every class of :func:`join`: the one with the least id (nulls last).

    Texts without words all stay. Of rows equal in id and text one stays, the
    one whose columns have the least hash. Columns keep their names, whatever
    they are; ``docs`` is evaluated several times.
    """
    texts = docs.select("doc_id", "text")
    sketches = sketched(texts, paths)
    least = F.min(F.struct(F.col("rep").isNull().alias("last"), "rep", "k1", "k2")).alias("least")
    keep = members(texts, sketches, paths).groupBy("root").agg(least).select("least.*")
    keep = keep.select(F.xxhash64("last", "rep", "k1", "k2").alias("key"), F.col("k1").alias("m1"), F.col("k2").alias("m2"))
    rows = docs.select(packed(docs), F.col("doc_id").alias("id"), F.col("text").rlike(WORD).alias("words"), *text_key(F.col("text")))
    rows = rows.withColumn("key", F.xxhash64(F.col("id").isNull(), "id", "k1", "k2"))
    # The key holds the id, so copies of a hot text do not meet.
    same = (F.col("key") == F.col("own")) & (F.col("k1") == F.col("m1")) & (F.col("k2") == F.col("m2"))
    kept = rows.where("words").join(keep.withColumnRenamed("key", "own"), same)
    kept = kept.groupBy("key", "k1", "k2").agg(F.min_by("body", F.xxhash64("body")).alias("body")).select("body.*")
    return kept.unionByName(rows.where("words is null or not words").select("body.*"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the class and the number of their links (5-word shingles, 0.8 or more)."""
    return join(documents(spark, sf_dir))


OP9_SQL = r"""
WITH RECURSIVE rows AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
texts AS (
  SELECT t, min(doc_id) AS rep, count(*) AS copies, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM rows GROUP BY t),
sized AS (SELECT row_number() OVER () AS id, rep, copies, t, words FROM texts WHERE len(words) > 0),
shingles AS (
  SELECT DISTINCT id, CASE WHEN len(words) < 5 THEN md5(array_to_string(words, chr(1))) ELSE md5(array_to_string(words[k:k + 4], chr(1))) END AS s
  FROM (SELECT id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS k FROM sized)),
sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
common AS (SELECT a.id AS a, b.id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.id <> b.id GROUP BY a.id, b.id),
links AS (SELECT a, b FROM common JOIN sizes x ON x.id = a JOIN sizes y ON y.id = b WHERE 5 * c >= 4 * (x.n + y.n - c)),
reach(a, b) AS (SELECT id, id FROM sized UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
classes AS (SELECT r.a AS id, min(s.rep) AS class_id FROM reach r JOIN sized s ON s.id = r.b GROUP BY r.a),
counts AS (SELECT l.a AS id, count(*) AS texts, sum(s.copies) AS documents FROM links l JOIN sized s ON s.id = l.b GROUP BY l.a)
SELECT r.doc_id, CASE WHEN s.id IS NULL THEN r.doc_id ELSE c.class_id END AS class_id,
  CAST(coalesce(n.documents, 0) + coalesce(s.copies, 1) - 1 AS BIGINT) AS n_links, coalesce(n.texts, 0) AS n_text_links, coalesce(s.copies, 1) AS n_copies
FROM rows r LEFT JOIN sized s ON s.t = r.t LEFT JOIN classes c ON c.id = s.id LEFT JOIN counts n ON n.id = s.id
"""
