"""Benchmark decontamination: BM25 with block-max WAND over every training passage.

The test items are the indexed documents, in entries of at most ``ENTRY``
words. Every passage of the training texts (``2 * ENTRY`` words, starting each
``ENTRY`` words, so an entry that a text holds is inside one passage) is a
query. An entry's impacts are divided by the score it gives itself, so a
score is the share of the entry that a passage holds and one threshold suits
all. Every term's list is cut into blocks of entries with its largest impact
there: the lists up to a passage's pivot are not opened, a block is scored only
if the maxima of the passage's terms reach the threshold in it, and every entry
above the threshold is found. The passages of a batch move through the lists
together, in numpy. An index holds a bounded number of items; a larger
benchmark is searched index by index.

What is found is verified on the words: of the runs of the item's question (all
sentences but the last) and of its answer (the last one), taken together, half
have to stand in the text. A part's runs are so short that one changed word
leaves half of them (five words at most). Where the item asks a question, an
answer of ``RUN`` words or more has to stand there by itself too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadra.llm.common import bounded_batches, documents, frozen, written

ENTRY, BLOCK = 64, 16
K1, B = 1.2, 0.75
THRESHOLD = 0.6
RUN, OVERLAP = 5, 0.5
# Items with fewer words are not searched: everyday phrases would be leaks.
LEAST_WORDS = 8
# Lists whose maxima stay below this share of the threshold together are not opened.
PIVOT = 0.5
# Items and, on average, words of an index.
INDEX_ITEMS, INDEX_WORDS = 10_000, 1 << 19
# Words of a text batch that is searched at once, and (passage, block) pairs scored at once.
BATCH_WORDS, OPEN_SLOTS = 1 << 16, 1 << 12

words_of = re.compile(r"\w+").findall
_sentence = re.compile(r"(?<=[.?!])\s+")
_asks = re.compile(r"\?\s").search


def parts(text: str) -> tuple[list[str], list[str]]:
    """Words of the question and of the answer; halves where there is one sentence."""
    sentences = [words_of(s.lower()) for s in _sentence.split(text.strip())]
    sentences = [s for s in sentences if s]
    if len(sentences) > 1:
        return [w for s in sentences[:-1] for w in s], sentences[-1]
    words = sentences[0] if sentences else []
    return words[: (len(words) + 1) // 2], words[(len(words) + 1) // 2 :]


def runs(words: list[str], n: int) -> list[tuple[str, ...]]:
    return list(zip(*[words[k:] for k in range(n)], strict=False))


def run_length(words: int) -> int:
    """Words of a run: one changed word leaves half of a part's runs; a part of fewer than ``RUN`` words is one run."""
    return words if words < RUN else min(RUN, (words + 1) // 3)


def held(part: list[str], text: list[str], known: dict[int, set]) -> tuple[int, int]:
    """How many of the part's runs stand in the text, and how many it has."""
    n = run_length(len(part))
    if not n:
        return 0, 0
    if n not in known:
        known[n] = set(runs(text, n))
    own = runs(part, n)
    return sum(r in known[n] for r in own), len(own)


def share(count: int, of: int) -> float:
    return count / of if of else 1.0


@dataclass
class Index:
    """Inverted lists: for every term its blocks with the largest impact there, for every such pair the postings."""

    items: list
    questions: list[list[str]]
    answers: list[list[str]]
    asks: list[bool]  # whether the item's question is one
    terms: dict[str, int]
    owner: np.ndarray  # item of each entry
    blocks: int
    top: np.ndarray  # of each term: its largest impact
    lists: np.ndarray  # of each term: where its pairs begin
    pairs: np.ndarray  # term * blocks + block, ascending
    most: np.ndarray  # of each pair: the largest impact
    postings: np.ndarray  # of each pair: where its postings begin
    entry: np.ndarray  # of each posting
    impact: np.ndarray

    @classmethod
    def build(cls, items: list, texts: list[str], frequency: dict[str, int], entries: int, length: float) -> Index:
        """``frequency``, ``entries`` and mean ``length`` are those of the whole benchmark."""
        split = [parts(t) for t in texts]
        chunks, owner = [], []
        for k, (question, answer) in enumerate(split):
            for words in chunked(question + answer):
                chunks.append(words)
                owner.append(k)
        names = sorted({w for c in chunks for w in c})
        terms = {w: i for i, w in enumerate(names)}
        df = np.array([frequency[w] for w in names], dtype=np.float64)
        idf = np.log(1 + (entries - df + 0.5) / (df + 0.5))
        term, entry, impact = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [np.zeros(0)]
        for e, c in enumerate(chunks):
            ids, times = np.unique([terms[w] for w in c], return_counts=True)
            value = idf[ids] * times * (K1 + 1) / (times + K1 * (1 - B + B * len(c) / length))
            term.append(ids)
            entry.append(np.full(len(ids), e))
            impact.append(value / value.sum())
        term, entry, impact = np.concatenate(term), np.concatenate(entry), np.concatenate(impact)
        order = np.lexsort((entry, term))
        term, entry, impact = term[order], entry[order], impact[order]
        blocks = max(-(-len(chunks) // BLOCK), 1)
        pairs, postings = np.unique(term * blocks + entry // BLOCK, return_index=True)
        lists = np.searchsorted(pairs, np.arange(len(names) + 1) * blocks)
        most = np.maximum.reduceat(impact, postings) if len(impact) else impact
        top = np.maximum.reduceat(most, lists[:-1]) if len(most) else most
        questions, answers = [q for q, _ in split], [a for _, a in split]
        asks, owner = [bool(_asks(t)) for t in texts], np.array(owner, dtype=np.int64)
        return cls(items, questions, answers, asks, terms, owner, blocks, top, lists, pairs, most, np.r_[postings, len(entry)], entry, impact)

    def passages(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, term) of the index's terms in every passage, sorted, and the first passage of each text."""
        find = self.terms.get
        passage, term, starts = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [0]
        for words in texts:
            ids = np.fromiter((find(w, -1) for w in words), dtype=np.int64, count=len(words))
            at = np.flatnonzero(ids >= 0)
            last = max(-(-len(words) // ENTRY) - 1, 1)  # a text of n x ENTRY words has n - 1 passages, one at least
            piece = at // ENTRY
            for own, inside in ((piece, piece < last), (piece - 1, (piece > 0) & (piece - 1 < last))):
                passage.append(starts[-1] + own[inside])
                term.append(ids[at[inside]])
            starts.append(starts[-1] + last)
        size = max(len(self.terms), 1)
        both = np.unique(np.concatenate(passage) * size + np.concatenate(term))
        return both // size, both % size, np.array(starts)

    def search(self, texts: list[list[str]], threshold: float = THRESHOLD) -> list[tuple[int, int, int, float]]:
        """(text, item, first word of the passage, score) of every passage and entry at or above the threshold.

        The lists of a passage are put in order of impact for each block they
        name. Those before the pivot could not reach the threshold together, so
        an entry above it stands in one behind the pivot: only these are opened,
        the others are looked up in the blocks that the maxima leave open.
        """
        least = threshold - 1e-6
        passage, term, starts = self.passages(texts)
        if not len(term):
            return []
        mass = np.bincount(passage, self.top[term], starts[-1])
        live = mass[passage] >= least
        passage, term = passage[live], term[live]
        if not len(term):
            return []
        order = np.lexsort((self.top[term] / np.diff(self.lists)[term], passage))
        passage, term = passage[order], term[order]
        begin = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
        size = np.diff(np.r_[begin, len(term)])
        own, row = passage[begin], np.repeat(np.arange(len(begin)), size)
        sums = np.cumsum(self.top[term])
        opened = sums - np.repeat(sums[begin] - self.top[term[begin]], size) >= PIVOT * least
        closed = np.bincount(row, np.where(opened, 0.0, self.top[term]))
        # Maxima of the opened lists, one accumulator for each passage and block they name.
        of, pair = spread(self.lists[term[opened]], self.lists[term[opened] + 1])
        slot = row[opened][of] * self.blocks + self.pairs[pair] % self.blocks
        bound = np.bincount(slot, self.most[pair], len(begin) * self.blocks)
        open_slots = np.flatnonzero(bound + np.repeat(closed, self.blocks) >= least)
        out = []
        for k in range(0, len(open_slots), OPEN_SLOTS):
            slots = open_slots[k : k + OPEN_SLOTS]
            # All lists of the passage, entered at the block.
            of, at = spread(begin[slots // self.blocks], (begin + size)[slots // self.blocks])
            key = term[at] * self.blocks + (slots % self.blocks)[of]
            pair = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            there = self.pairs[pair] == key
            of, pair = of[there], pair[there]
            enough = np.bincount(of, self.most[pair], len(slots)) >= least
            of, pair = of[enough[of]], pair[enough[of]]
            through, posting = spread(self.postings[pair], self.postings[pair + 1])
            score = np.bincount(of[through] * BLOCK + self.entry[posting] % BLOCK, self.impact[posting], len(slots) * BLOCK)
            for hit in np.flatnonzero(score >= least):
                slot, e = slots[hit // BLOCK], hit % BLOCK
                p = int(own[slot // self.blocks])
                text = int(np.searchsorted(starts, p, side="right")) - 1
                item = int(self.owner[slot % self.blocks * BLOCK + e])
                out.append((text, item, int(p - starts[text]) * ENTRY, round(min(float(score[hit]), 1.0), 6)))
        return out

    def verified(self, texts: list[list[str]]) -> Iterator[tuple[int, int, int, float, float, float]]:
        """(text, item, place, score, question overlap, answer overlap): the best passage of each text and item."""
        best: dict[tuple[int, int], tuple[float, int]] = {}
        for text, item, at, score in self.search(texts):
            best[text, item] = max(best.get((text, item), (0.0, 0)), (score, -at))
        known: dict[int, dict[int, set]] = {}
        for (text, item), (score, at) in sorted(best.items()):
            runs_of = known.setdefault(text, {})
            question, answer = held(self.questions[item], texts[text], runs_of), held(self.answers[item], texts[text], runs_of)
            if self.is_held(item, question, answer):
                yield text, item, -at, score, share(*question), share(*answer)

    def is_held(self, item: int, question: tuple[int, int], answer: tuple[int, int]) -> bool:
        """Whether enough of the runs of both parts together are held."""
        both = share(question[0] + answer[0], question[1] + answer[1])
        if self.asks[item] and len(self.answers[item]) >= RUN and share(*answer) < OVERLAP:
            return False
        return both >= OVERLAP


def spread(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges of numbers: the range of every number in them, and the number."""
    size = end - begin
    of = np.repeat(np.arange(len(size)), size)
    return of, np.arange(len(of)) + np.repeat(begin - np.cumsum(size) + size, size)


def chunked(words: list[str]) -> list[list[str]]:
    """Entries of at most ENTRY words, nearly equal in length."""
    n = -(-len(words) // ENTRY)
    return [words[k * len(words) // n : (k + 1) * len(words) // n] for k in range(n)]


def indexes(benchmark: DataFrame) -> Iterator[Index]:
    """The benchmark's indexes, one after the other, each of about ``INDEX_ITEMS`` items and ``INDEX_WORDS`` words at most.

    Statistics of the terms are counted over the whole benchmark by Spark.
    Rows are dealt to the indexes by number, so that a repeated item does not
    fill one of them; items of fewer than ``LEAST_WORDS`` words are in none.
    """
    items = bounded_batches(benchmark).where("text is not null").select("item_id", "text")

    def entries(batches):
        for pdf in batches:
            rows = [(w, len(c) if k == 0 else 0) for t in pdf["text"] for c in chunked(sum(parts(t), [])) for k, w in enumerate(dict.fromkeys(c))]
            yield pd.DataFrame(rows, columns=["term", "length"])

    counted = items.mapInPandas(entries, "term string, length long").groupBy("term")
    counted = counted.agg(F.count("*").alias("df"), F.sum("length").alias("length"), F.sum((F.col("length") > 0).cast("long")).alias("n"))
    total = counted.agg(F.sum("length").alias("length"), F.sum("n").alias("n")).first()
    if not total["n"]:
        return
    rows = frozen(items.withColumn("row", F.monotonically_increasing_id()))
    pieces = max(-(-rows.count() // INDEX_ITEMS), -(-total["length"] // INDEX_WORDS))
    for piece in range(pieces):
        own = rows.where(F.pmod(F.xxhash64("row"), F.lit(pieces)) == piece).select("item_id", "text").toPandas()
        own = own[[len(words_of(t)) >= LEAST_WORDS for t in own["text"]]].sort_values(["item_id", "text"])
        if not len(own):
            continue
        words = {w for t in own["text"] for part in parts(t) for w in part}
        wanted = counted if pieces == 1 else counted.join(benchmark.sparkSession.createDataFrame([(w,) for w in words], "term string"), "term")
        frequency = {r["term"]: r["df"] for r in wanted.select("term", "df").collect()}
        yield Index.build(own["item_id"].tolist(), own["text"].tolist(), frequency, total["n"], total["length"] / total["n"])


def not_searched(benchmark: DataFrame) -> DataFrame:
    """The items that no index holds: null texts and those of fewer than ``LEAST_WORDS`` words."""

    @F.pandas_udf("boolean")
    def is_short(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t is None or len(words_of(t)) < LEAST_WORDS)

    return benchmark.where(is_short("text"))


def _batches(texts: pd.Series) -> Iterator[tuple[list[int], list[list[str]]]]:
    rows, own, size = [], [], 0
    for row, text in enumerate(texts):
        words = words_of(text.lower()) if text else []
        rows.append(row)
        own.append(words)
        size += len(words)
        if size > BATCH_WORDS:
            yield rows, own
            rows, own, size = [], [], 0
    if rows:
        yield rows, own


def find_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap, at: every test item that a document holds.

    A document without items gives no row; ``at`` is the first word of the
    best passage. Words are compared in lower case without punctuation. Null
    and empty texts hold nothing; items of fewer than ``LEAST_WORDS`` words are
    not searched (``not_searched``); repeated documents and items give rows of
    their own. Other columns are ignored. Every index is one scan of the
    documents, and what it found is written before the next one is built.
    """
    doc, item = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    columns = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "at"]
    schema = f"doc_id {doc}, item_id {item}, score double, question_overlap double, answer_overlap double, at long"

    def search_of(index: Index):
        def search(batches):
            for pdf in batches:
                ids = pdf["doc_id"]
                rows = [
                    (ids.iloc[own[text]], index.items[k], score, question, answer, at)
                    for own, texts in _batches(pdf["text"])
                    for text, k, at, score, question, answer in index.verified(texts)
                ]
                yield pd.DataFrame(rows, columns=columns)

        return search

    found: list[DataFrame] = []
    for index in indexes(benchmark):
        found[-1:] = [written(f, "found") for f in found[-1:]]
        found.append(docs.select("doc_id", "text").mapInPandas(search_of(index), schema))
    return reduce(DataFrame.unionAll, found) if found else docs.sparkSession.createDataFrame([], schema)


def holds_item(text: Column, index: Index) -> Column:
    """Whether a text holds a test item of the index (no shuffle, no id needed)."""

    @F.pandas_udf("boolean")
    def holds(texts: pd.Series) -> pd.Series:
        out = np.zeros(len(texts), dtype=bool)
        for own, words in _batches(texts):
            for text, *_ in index.verified(words):
                out[own[text]] = True
        return pd.Series(out)

    return holds(text)


def without_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, that hold no test item; with several indexes each pass is written before the next."""
    kept = docs
    for index in indexes(benchmark):
        kept = (kept if kept is docs else written(kept, "kept")).where(~holds_item(F.col("text"), index))
    return kept


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents that hold benchmark items, with the items."""
    return find_items(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


# The same by scoring every passage with every entry that shares a word with it.
OP5_SQL = r"""
WITH items AS MATERIALIZED (
  SELECT row_number() OVER () AS i, item_id, regexp_matches(text, '\?\s') AS asks,
    list_filter(list_transform(string_split(regexp_replace(text, '([.?!])\s+', '\1' || chr(1), 'g'), chr(1)),
      lambda s: regexp_extract_all(lower(s), '[\p{L}\p{N}_]+')), lambda s: len(s) > 0) AS s
  FROM benchmark WHERE text IS NOT NULL),
halves AS (
  SELECT i, item_id, asks, w, CASE WHEN n > 1 THEN flatten(s[1:n - 1]) ELSE w[1:(len(w) + 1) // 2] END AS question,
    CASE WHEN n > 1 THEN s[n] ELSE w[(len(w) + 1) // 2 + 1:len(w)] END AS answer
  FROM (SELECT *, flatten(s) AS w, len(s) AS n FROM items) WHERE n > 0),
entries AS MATERIALIZED (
  SELECT row_number() OVER () AS e, i, w[k * len(w) // n + 1:(k + 1) * len(w) // n] AS c
  FROM (SELECT i, w, n, unnest(range(0, n)) AS k FROM (SELECT i, w, (len(w) + 63) // 64 AS n FROM halves))),
means AS (SELECT count(*) AS n, sum(len(c)) / count(*) AS length FROM entries),
times AS (SELECT e, word, size, count(*) AS f FROM (SELECT e, len(c) AS size, unnest(c) AS word FROM entries) GROUP BY ALL),
spread AS (SELECT word, count(*) AS df FROM times GROUP BY word),
worth AS (
  SELECT e, word, ln(1 + (n - df + 0.5) / (df + 0.5)) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * size / length)) AS v
  FROM times JOIN spread USING (word) CROSS JOIN means),
impacts AS (SELECT e, word, v / sum(v) OVER (PARTITION BY e) AS v FROM worth),
docs AS MATERIALIZED (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents WHERE text IS NOT NULL),
placed AS (
  SELECT d, (pos - 1) // 64 AS piece, greatest((len(w) + 63) // 64 - 1, 1) AS pieces, w[pos] AS word
  FROM (SELECT d, w, unnest(range(1, len(w) + 1)) AS pos FROM docs)),
passages AS (
  SELECT DISTINCT d, p, word FROM (
    SELECT d, pieces, word, piece AS p FROM placed UNION ALL SELECT d, pieces, word, piece - 1 FROM placed WHERE piece > 0)
  WHERE p < pieces AND word IN (SELECT word FROM spread)),
scores AS (SELECT d, p, e, sum(v) AS score FROM passages JOIN impacts USING (word) GROUP BY d, p, e HAVING sum(v) >= 0.6 - 1e-6),
ranked AS (
  SELECT d, i, p * 64 AS pos, round(least(score, 1.0), 6) AS score,
    row_number() OVER (PARTITION BY d, i ORDER BY round(least(score, 1.0), 6) DESC, p) AS place
  FROM scores JOIN entries USING (e)),
candidates AS (
  SELECT r.d, r.i, r.pos, r.score, unnest([1, 2]) AS part, unnest([h.question, h.answer]) AS own
  FROM ranked r JOIN halves h USING (i) WHERE place = 1 AND len(h.w) >= 8),
sized AS (SELECT *, CASE WHEN len(own) < 5 THEN len(own) ELSE least(5, (len(own) + 1) // 3) END AS n FROM candidates),
counted AS (
  SELECT c.d, c.i, pos, score, part, CASE WHEN n = 0 THEN 0 ELSE len(own) - n + 1 END AS runs,
    CASE WHEN n = 0 THEN 0 ELSE len(list_filter(
      list_transform(range(1, len(own) - n + 2), lambda k: array_to_string(own[k:k + n - 1], ' ')),
      lambda r: list_contains(list_transform(range(1, len(w) - n + 2), lambda k: array_to_string(w[k:k + n - 1], ' ')), r))) END AS held
  FROM sized c JOIN docs USING (d)),
shares AS (
  SELECT q.d, q.i, q.pos, q.score, q.held AS qh, q.runs AS qn, a.held AS ah, a.runs AS an,
    CASE WHEN q.runs = 0 THEN 1.0 ELSE q.held / q.runs END AS question_overlap,
    CASE WHEN a.runs = 0 THEN 1.0 ELSE a.held / a.runs END AS answer_overlap
  FROM counted q JOIN counted a ON q.d = a.d AND q.i = a.i AND q.part = 1 AND a.part = 2)
SELECT doc_id, item_id, score, CAST(question_overlap AS DOUBLE) AS question_overlap, CAST(answer_overlap AS DOUBLE) AS answer_overlap, CAST(pos AS BIGINT) AS "at"
FROM shares JOIN halves USING (i) JOIN docs USING (d)
WHERE (qh + ah) / (qn + an) >= 0.5 AND NOT (asks AND len(answer) >= 5 AND answer_overlap < 0.5)
"""
