from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quadra.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, turns string"


def back(spark, rows):
    frame = chat.format_conversations(spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA))
    out = frame.select("*", chat.turns_of(F.col("formatted")).alias("turns"), chat.learned_text(F.col("formatted"), F.col("loss")).alias("learned"))
    return {r["conv_id"]: r for r in out.collect()}


def expected(rows):
    convs = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        convs.setdefault(c, []).append((role or "", text or ""))
    return convs


PIECES = [*"ab<|>\\n\n_ims", "<|im_end|>\n", "<|im_start|>", "<|im_sep|>", "<\\|", "\\b", "\U0001f600"]
NASTY = st.lists(st.sampled_from(PIECES), max_size=6).map("".join)


@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 6), st.sampled_from(["user", "assistant", "a\nb", "<|x", "\\n", None]), NASTY | st.none()), max_size=30))
@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
def test_turns_and_learned_text_come_back(spark, rows):
    got, want = back(spark, rows), expected(rows)
    assert set(got) == set(want)
    for c, turns in want.items():
        assert [tuple(t) for t in got[c]["turns"]] == turns
        assert got[c]["learned"] == "".join(t for r, t in turns if r == "assistant")


def test_adjacent_turns_of_a_role_share_a_block(spark):
    got = back(spark, [(1, 0, "user", "hi"), (1, 1, "assistant", "a"), (1, 2, "assistant", "b"), (1, 3, "user", "x")])[1]
    assert got["formatted"] == (
        "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\na<|im_sep|>b<|im_end|>\n<|im_start|>user\nx<|im_end|>\n"
    )
    assert [got["formatted"][s["start"] : s["end"]] for s in got["loss"]] == ["a", "b"]


def test_edges(spark):
    assert back(spark, []) == {}
    long = "y" * 200_000
    got = back(spark, [(None, None, None, None), (None, 0, "assistant", long), (2, 0, "user", ""), (2, 0, "user", ""), (3, 1, "assistant", None)])
    assert [tuple(t) for t in got[None]["turns"]] == [("", ""), ("assistant", long)]
    assert got[None]["learned"] == long
    assert [tuple(t) for t in got[2]["turns"]] == [("user", ""), ("user", "")]
    assert got[3]["learned"] == "" and len(got[3]["loss"]) == 1


def test_many_turns_of_one_conversation(spark):
    rows = [(1, i, ("user", "assistant")[i % 3 == 0], f"t{i}") for i in range(1500)]
    got = back(spark, rows)[1]
    assert [t["text"] for t in got["turns"]] == [f"t{i}" for i in range(1500)]
    assert got["learned"] == "".join(f"t{i}" for i in range(0, 1500, 3))
