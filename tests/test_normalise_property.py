"""District normalisation against a plain-Python statement of the rule.

The rule (trim, upper, NFKD, drop marks, punctuation to space, collapse,
token abbreviations) is written directly with ``unicodedata`` and ``re`` and
compared with the Spark expression on random names drawn from ASCII, Latin-1
and Latin Extended letters, combining marks, fractions and punctuation.
"""

from __future__ import annotations

import random
import re
import sys
import unicodedata

from pyspark.sql import functions as F

from quadra.functions import columns as C

ALPHABET = (
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    "     .,-_/()'\"ºª\t"
    + "".join(chr(c) for c in range(0xC0, 0x250) if chr(c).isalpha())
    + "̧́̃½¼²"
)
WORDS = list(C.ABBREVIATIONS) + ["SÃO", "jd.", "Vl", "pq", "Sta.", "CENTRO", "Cj"]


def python_rule(value: str | None) -> str | None:
    if value is None:
        return None
    s = unicodedata.normalize("NFKD", value.strip().upper())
    s = "".join(ch for ch in s if not unicodedata.category(ch).startswith("M"))
    s = re.sub(r"\s+", " ", re.sub(r"[^A-Z0-9 ]", " ", s)).strip()
    return " ".join(C.ABBREVIATIONS.get(t, t) for t in s.split(" "))


def _random_name(rng: random.Random) -> str:
    parts = []
    for _ in range(rng.randint(0, 5)):
        if rng.random() < 0.4:
            parts.append(rng.choice(WORDS))
        else:
            parts.append("".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 8))))
    return rng.choice([" ", "  ", ".", " - "]).join(parts)


def test_every_code_point_with_a_decomposition(spark):
    """No range of Unicode is left out: each such character between two letters, and alone."""
    chars = [chr(cp) for cp in range(0x80, sys.maxunicode + 1) if unicodedata.decomposition(chr(cp))]
    # Characters that upper-casing changes are upper-cased first, as the rule does.
    names = [n for ch in chars for n in (f"A{ch}B", ch) if ch.upper() == ch]
    df = spark.createDataFrame(list(enumerate(names)), "i int, name string")
    got = {r["i"]: r["out"] for r in df.select("i", C.normalise_district(F.col("name")).alias("out")).collect()}
    bad = [(names[i], got[i], python_rule(names[i])) for i in got if got[i] != python_rule(names[i])]
    assert len(names) > 8000 and not bad, (len(bad), bad[:5])


def test_normalise_matches_python_rule(spark):
    rng = random.Random(20261202)
    names = [_random_name(rng) for _ in range(3000)] + [None, "", "   "]
    # Spark and Python upper-case a few letters differently (e.g. ß, ŉ); keep
    # names whose Python upper-casing has the same length as the input.
    names = [n for n in names if n is None or len(n.upper()) == len(n)]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, name string")
    got = {r["i"]: r["out"] for r in df.select("i", C.normalise_district(F.col("name")).alias("out")).collect()}
    bad = [(names[i], got[i], python_rule(names[i])) for i in got if got[i] != python_rule(names[i])]
    assert not bad, bad[:5]
