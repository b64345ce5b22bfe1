import random

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

from quadra.llm import langid, registry

QUESTION = "which of the seven rivers in the north carries the most water in the spring of a wet year? the long grey one below the glacier."


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus with texts to reject, groups to thin out and leaks to remove."""
    rng = random.Random(3)
    vocabulary = [a + b for a in ("ka", "lo", "mi", "ne", "su", "ta") for b in ("r", "nd", "st", "lk", "m", "p", "ve", "ing")]
    text = lambda: " ".join(rng.choice(vocabulary) + rng.choice(vocabulary) for _ in range(rng.randrange(40, 90)))
    rows = [(k, text(), "en", f"s{k % 3}") for k in range(120)]
    rows += [(200 + k, rows[k][1], "en", "s1") for k in range(0, 20, 2)]  # copies
    rows += [(300 + k, rows[k][1] + " end", "en", "s2") for k in range(1, 21, 2)]  # near copies
    rows += [(400 + k, f"{text()} {QUESTION} {text()}", "en", "s0") for k in range(5)]  # leaks
    rows += [(500, None, "en", "s0"), (501, "", None, None), (502, "123 456", "de", "s1"), (503, text(), None, None)]
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame([(i, t, lang, s, None if t is None else len(t), "clash") for i, t, lang, s in rows], "doc_id long, text string, lang string, source string, n_chars long, shard string")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, QUESTION)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_do_what_they_say(spark, folder):
    docs = P.documents(spark, folder)
    columns, ids = docs.columns, [{r["doc_id"] for r in docs.collect()}]
    for _, stage in P.STAGES[:3]:
        docs = P.written(stage(spark, docs, folder), "stage")
        assert docs.columns == columns
        ids.append({r["doc_id"] for r in docs.collect()})
    assert ids[0] - ids[1] == {500, 501, 502}
    assert ids[1] - ids[2] == {200 + k for k in range(0, 20, 2)} | {300 + k for k in range(1, 21, 2)}
    assert ids[2] - ids[3] == {400 + k for k in range(5)}
    mixed = P.written(P.STAGES[3][1](spark, docs, folder), "stage")
    assert mixed.columns == columns
    sizes = {r["source"]: r["n"] for r in docs.groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()}
    taken = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()}
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= 180
    assert all(taken[s] <= 2 * sizes[s] for s in taken)
    placed = P.STAGES[4][1](spark, mixed, folder)
    counts = [r["count"] for r in placed.groupBy("shard").count().collect()]
    assert len(counts) == 8 and max(counts) - min(counts) <= 1 and sum(counts) == mixed.count()
    whole = P.run(spark, folder)
    as_rows = lambda d: sorted((r["doc_id"], r["shard"]) for r in d.collect())
    assert as_rows(whole) == as_rows(placed)


def test_stages_take_an_empty_table(spark, folder):
    docs = P.documents(spark, folder).limit(0)
    for _, stage in P.STAGES:
        docs = P.written(stage(spark, docs, folder), "stage")
        assert docs.count() == 0


def test_null_and_repeated_ids_long_texts_and_ties(spark, folder, tmp_path):
    """One source holds nearly all rows, half of them without an id; stages lose nobody but those they should."""
    rng = random.Random(5)
    said = [" ".join(rng.choice(("kar", "lond", "mist", "nelk", "sum", "tap")) + rng.choice(("ve", "ing", "ra", "lo")) for _ in range(60)) for _ in range(90)]
    rows = [(None, said[k], "en", "hot") for k in range(60)] + [(None, said[0], "en", "hot")] * 3 + [(7, said[k], "en", "hot") for k in range(60, 89)]
    rows += [(8, " ".join(said[k] for k in range(89)) * 3, "en", "long")]
    path = str(tmp_path)
    docs = spark.createDataFrame([(i, t, lang, s, len(t), "clash") for i, t, lang, s in rows], "doc_id long, text string, lang string, source string, n_chars long, shard string")
    docs.repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, QUESTION)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    one_each = P.written(P.near_duplicates(spark, P.documents(spark, path), path), "stage")
    assert sorted(r["text"] for r in one_each.collect()) == sorted({t for _, t, _, _ in rows})
    placed = P.shards(spark, one_each, path)
    counts = [r["count"] for r in placed.groupBy("shard").count().collect()]
    assert sum(counts) == one_each.count() and max(counts) - min(counts) <= 1
    taken = P.mixture(spark, one_each, path)
    assert {r["n"] for r in taken.groupBy("text").agg(F.count("*").alias("n")).collect()} <= {1, 2}
    assert P.contamination(spark, one_each, path).count() == one_each.count()


def test_every_operator_has_one_query():
    numbers = sorted(int(q[2:].split("_")[0]) for q in registry.QUERIES)
    assert numbers == list(range(1, 14)) and set(registry.ORACLE_SQL) <= set(registry.QUERIES)
    assert len(P.STAGES) == 5


FOREIGN = [
    "os meninos correm pela rua enquanto a chuva cai sobre as casas velhas da cidade e ninguem quer sair de casa hoje",
    "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem",
    "все люди рождаются свободными и равными в своем достоинстве и правах они наделены разумом и совестью",
    "人人生而自由在尊严和权利上一律平等他们赋有理性和良心并应以兄弟关系的精神相对待",
    "bütün insanlar hür haysiyet ve haklar bakımından eşit doğarlar akıl ve vicdana sahiptirler",
]
GARBLED = ["for(int i=0;i<n;i++){x[i]+=y[j]*z;} if(!p)return NULL; while(k--){q->n=q;}", "@@## a $$%% ^^&& ** (( )) x !! ~~ == ++", "x" * 500]


def test_language_stage_rejects_what_it_never_learned(spark):
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyz"
    noise = [" ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 9))) for _ in range(60)) for _ in range(5)]
    planted = [t for text in (*FOREIGN, *GARBLED, *noise) for t in (text, " ".join([text] * 20))]
    known = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    own = spark.createDataFrame([(-k - 1, t, None) for k, t in enumerate(planted)], known.schema)
    kept = {r["doc_id"] for r in P.language(spark, known.unionAll(own), "").select("doc_id").collect()}
    assert not [planted[-k - 1][:40] for k in kept if k < 0]
    judged = known.select("doc_id", "lang", langid.identify(known["text"], langid.train(known)).alias("p")).collect()
    right = [r["doc_id"] in kept for r in judged if r["lang"] == r["p"]["lang_pred"]]
    assert right.count(False) <= langid.MAX_LOSS * len(right)


def test_cuts_lose_no_more_than_they_may(spark):
    known = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = langid.train(known)
    judged = [(r["lang"], r["text"], *model.predict(r["text"])) for r in known.collect()]
    right = [(score, model.likeness(t, lang)) for lang, t, found, score in judged if found == lang]
    for loss in (0.0, 0.002, 0.05, 0.5):
        for least, values in zip(langid.cuts(known, model, loss), zip(*right, strict=True), strict=True):
            assert sum(v < least for v in values) <= loss / 2 * len(values) < sum(v < least + 1 / langid.STEPS for v in values)
    assert langid.cuts(known.limit(0), model) == (-float("inf"), -float("inf"))
    french = known.where("lang = 'fr'")
    alone = langid.train(french)
    least = langid.cuts(french, alone)
    assert least[0] == 1 and all(alone.likeness(t, "fr") < least[1] for t in (*FOREIGN, *GARBLED))
