import random

import numpy as np

from quadra.llm import decontaminate as D


def made(seed=8):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)] + ["the", "of", "and"] * 40
    item = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [f"{item(rng.randrange(8, 30))}? {item(rng.randrange(1, 20))}." for _ in range(30)] + [item(150), "one two", "..."]
    docs = [item(rng.randrange(0, 400)) for _ in range(60)]
    planted = {}
    for k in range(0, 33, 2):
        words = docs[k].split()
        at = rng.randrange(len(words) + 1)
        docs[k] = " ".join(words[:at] + [items[k % 31].upper()] + words[at:])
        planted[k] = k % 31
    return items, docs, planted


def plain_bm25(items, texts):
    """Shares of every entry's own score in every passage, term by term."""
    entries = [(k, c) for k, t in enumerate(items) for c in D.chunked(sum(D.parts(t), []))]
    mean = np.mean([len(c) for _, c in entries])
    df = {}
    for _, c in entries:
        for w in set(c):
            df[w] = df.get(w, 0) + 1
    value = lambda w, c: np.log(1 + (len(entries) - df[w] + 0.5) / (df[w] + 0.5)) * c.count(w) * 2.2 / (
        c.count(w) + 1.2 * (0.25 + 0.75 * len(c) / mean)
    )
    own = [sum(value(w, c) for w in set(c)) for _, c in entries]
    for t, words in enumerate(texts):
        for begin in range(0, max(len(words) - D.ENTRY, 1), D.ENTRY):
            passage = set(words[begin : begin + 2 * D.ENTRY])
            for e, (k, c) in enumerate(entries):
                yield t, k, begin, sum(value(w, c) for w in set(c) & passage) / own[e]


def test_search_equals_scoring_every_passage(spark):
    items, docs, _ = made()
    (index,) = D.indexes(spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    texts = [D.words_of(t.lower()) for t in docs]
    for threshold in (0.3, 0.6):
        got = {(t, index.items[k], at): s for t, k, at, s in index.search(texts, threshold)}
        want = {}
        for t, k, at, s in plain_bm25(items, texts):
            if s >= threshold - 1e-6:
                want[t, k, at] = max(s, want.get((t, k, at), 0))
        assert set(got) == set(want) and len(want) > 15


def test_planted_items_are_found_and_no_others(spark):
    items, docs, planted = made()
    found = D.find_items(
        spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"),
        spark.createDataFrame([(k, t, "clash") for k, t in enumerate(items)], "item_id long, text string, doc_id string"),
    ).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == set(planted.items())
    assert all(r["question_overlap"] == 1 and r["answer_overlap"] == 1 for r in found)


def test_an_item_without_its_answer_is_no_leak(spark):
    question = "which of the seven rivers in the north carries the most water in the spring of a wet year"
    answer = "the long grey river that begins below the glacier"
    bench = spark.createDataFrame([(1, f"{question}? {answer}.")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"x {question} y {answer} z"), (2, f"x {question} y z")], "doc_id long, text string")
    assert [r["doc_id"] for r in D.find_items(docs, bench).collect()] == [1]


def test_edges(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "..."), (None, "one line here to repeat another line one line here")], "item_id long, text string")
    rows = D.find_items(edge_docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == {(9, None)}
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.find_items(edge_docs, none).count() == 0 and D.find_items(no_docs, bench).count() == 0
    (index,) = D.indexes(bench)
    held = edge_docs.select("doc_id", D.holds_item(edge_docs["text"], index).alias("h")).collect()
    assert {r["doc_id"] for r in held if r["h"]} == {9} and len(held) == edge_docs.count()
    kept = D.without_items(edge_docs, bench)
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, edge_docs.where("doc_id is null or doc_id <> 9").collect()))
    assert D.without_items(edge_docs, none).count() == edge_docs.count() and D.without_items(no_docs, bench).count() == 0
    twice = D.find_items(edge_docs.where("doc_id = 9").unionAll(edge_docs.where("doc_id = 9")), bench)
    assert twice.count() == 2


def test_many_items_are_searched_index_by_index(spark, monkeypatch):
    items, docs, planted = made()
    monkeypatch.setattr(D, "INDEX_ITEMS", 10)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    assert len(list(D.indexes(bench))) > 1
    texts = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    found = D.find_items(texts, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == set(planted.items())
    assert {r["doc_id"] for r in D.without_items(texts, bench).collect()} == set(range(len(docs))) - set(planted)


def test_a_repeated_item_does_not_fill_one_index(spark, monkeypatch):
    monkeypatch.setattr(D, "INDEX_ITEMS", 100)
    text = "which of the rivers in the north carries the most water? the long grey one below the hill."
    bench = spark.createDataFrame([(k % 3, text) for k in range(600)], "item_id long, text string")
    assert max(len(index.items) for index in D.indexes(bench)) < 200
    docs = spark.createDataFrame([(1, text), (2, "nothing of it")], "doc_id long, text string")
    assert D.find_items(docs, bench).groupBy("doc_id", "item_id").count().count() == 3
    assert D.find_items(docs, bench).count() == 600


def test_short_items_are_not_searched_but_listed(spark):
    bench = spark.createDataFrame([(1, "Yes."), (2, "one two three four five six seven"), (3, None), (4, " ".join("abcdefgh"))], "item_id long, text string")
    docs = spark.createDataFrame([(1, "well yes I think so: one two three four five six seven"), (2, "x a b c d e f g h y")], "doc_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in D.find_items(docs, bench).collect()] == [(2, 4)]
    assert {r["item_id"] for r in D.not_searched(bench).collect()} == {1, 2, 3}
    assert D.find_items(docs, bench.where("item_id < 4")).count() == 0


def test_lists_up_to_the_pivot_stay_closed_without_a_loss(spark, monkeypatch):
    items, docs, _ = made(3)
    (index,) = D.indexes(spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    texts = [D.words_of(t.lower()) for t in docs]
    want = sorted(index.search(texts, 0.3))
    for pivot, slots in ((0.0, 1 << 12), (1.0, 7), (0.3, 1)):
        monkeypatch.setattr(D, "PIVOT", pivot)
        monkeypatch.setattr(D, "OPEN_SLOTS", slots)
        assert sorted(index.search(texts, 0.3)) == want and len(want) > 15


def edited(words, rate, rng):
    """Words of which a share (one at least) is replaced."""
    out = list(words)
    for k in rng.sample(range(len(out)), max(1, round(rate * len(out)))):
        out[k] = f"changed{k}"
    return out


def test_an_edit_in_a_short_sentence_does_not_hide_a_leak(spark):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(3000)]
    item = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(item(rng.randrange(14, 50)), item(n)) for n in (1, 2, 3, 4, 5, 8, 12, 13) * 4]
    bench = spark.createDataFrame([(k, f"{' '.join(q)}. {' '.join(a)}.") for k, (q, a) in enumerate(items)], "item_id long, text string")
    docs = []
    for k, (q, a) in enumerate(items):
        for at in range(len(q), len(q + a)):  # every word of the last sentence, by turns
            words = q + a
            docs.append((k, " ".join([*item(50), *words[:at], "changed", *words[at + 1 :], *item(50)])))
        docs.append((k, " ".join([*item(50), *edited(q + a, 0, rng), *item(50)])))
        if len(q) >= 2 * len(a):  # no question is asked, so the rest is most of the item
            docs.append((k, " ".join([*item(50), *q, *item(50)])))
    found = D.find_items(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert len(docs) > 200 and sorted((r["doc_id"], r["item_id"]) for r in found) == sorted((k, k) for k, _ in docs)


def test_one_changed_word_leaves_half_of_a_part():
    for n in range(D.RUN, 80):
        words = [f"w{k}" for k in range(n)]
        for at in range(n):
            count, of = D.held(words, [*words[:at], "changed", *words[at + 1 :]], {})
            assert count >= D.OVERLAP * of


def test_an_asked_item_needs_a_long_answer_only(spark):
    question = "which of the seven rivers in the north carries the most water in the spring of a wet year"
    bench = spark.createDataFrame([(1, f"{question}? the long grey river below the glacier."), (2, f"tell {question}? blue.")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"x {question} the long grey stream below the glacier"), (2, f"x {question} y z"), (3, f"tell {question} green")], "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in D.find_items(docs, bench).collect()}
    assert (1, 1) in found and (2, 1) not in found and (3, 1) not in found and (3, 2) in found
