"""Language identification in two steps: the family, then the language within it.

Texts are lower-cased, everything but letters becomes a blank, and hashed
trigrams of the UTF-8 bytes are counted. Linear support vector machines, one
for each pair of classes, vote: first the pairs of families, then the pairs of
languages of the family that won. A pair's margin is the mean weight over a
text's trigrams, so a whole text is scored by look-ups in one weight table,
whatever its length. The vote always has a winner; whether a text is in a known
language at all is judged by the certainty and by how usual its trigrams are
in the winner (``judge``), with cuts from all labelled rows (``cuts``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadra.llm.common import bounded_batches, crc_mod, documents, fraction_of, text_key

# Labelled documents to learn from, in equal parts from the languages, at most.
TRAIN_ROWS = 1600
BITS = 13
# An entry of a packed profile.
ENTRY = np.dtype([("from_end", ">u2"), ("value", "<f2")])
UNKNOWN = "und"
EPOCHS, COST, SEED = 20, 10.0, 1
# Share of the correctly identified labelled rows that the cuts may reject at most; steps of their histograms.
MAX_LOSS, STEPS = 0.002, 1024
# Weight of equally likely trigrams, for those that a language's training rows lack.
SMOOTH = 1 / 16
# Language families (fixed values); a language that is not listed is a family of its own.
FAMILIES = {
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "germanic": ("af", "da", "de", "en", "is", "lb", "nl", "no", "sv", "yi"),
    "slavic": ("be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "semitic": ("am", "ar", "he", "mt"),
    "turkic": ("az", "kk", "ky", "tr", "uz"),
}
_BLANKS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def family(lang: str) -> str:
    return next((name for name, langs in FAMILIES.items() if lang in langs), f"only {lang}")


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def trigrams(text: str) -> np.ndarray:
    """Hashed byte trigrams of a text with a blank at either end; runs of three blanks are left out."""
    raw = b" " + text.lower().encode("utf-8", "replace").translate(_BLANKS) + b" "
    b = np.frombuffer(raw, dtype=np.uint8).astype(np.uint32)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    code = code[code != 0x202020]
    return (code * np.uint32(2654435761)) >> np.uint32(32 - BITS)


def profile(text: str) -> np.ndarray:
    """Counts of the hashed trigrams, scaled to length 1."""
    codes = trigrams(text)
    return (np.bincount(codes, minlength=1 << BITS) / unit(codes)).astype(np.float16)


def packed_profile(text: str) -> bytes:
    """The entries of a text's profile that are not 0; these bytes sort as those of the whole profile do."""
    values = profile(text)
    at = np.flatnonzero(values)
    entries = np.empty(len(at), dtype=ENTRY)
    entries["from_end"], entries["value"] = (1 << BITS) - 1 - at, values[at]
    return entries.tobytes()


@dataclass
class Profiles:
    """Rows of ``width`` numbers, kept without their zeros: some hundred of the 8192 trigrams occur in a text."""

    codes: np.ndarray
    values: np.ndarray
    begins: np.ndarray  # of each row, and the end of the last one
    width: int

    @classmethod
    def unpack(cls, rows: list[bytes]) -> Profiles:
        entries = np.frombuffer(b"".join(rows), dtype=ENTRY)
        begins = np.cumsum([0, *[len(r) // ENTRY.itemsize for r in rows]])
        return cls((1 << BITS) - 1 - entries["from_end"].astype(np.int64), entries["value"].astype(np.float32), begins, 1 << BITS)

    @classmethod
    def of(cls, x: np.ndarray) -> Profiles:
        row, code = np.nonzero(x)
        return cls(code, x[row, code], np.searchsorted(row, np.arange(len(x) + 1)), x.shape[1])

    def __len__(self) -> int:
        return len(self.begins) - 1

    def row(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        own = slice(self.begins[k], self.begins[k + 1])
        return self.codes[own], self.values[own]

    def take(self, own: np.ndarray) -> Profiles:
        """The rows of a mask."""
        sizes = np.diff(self.begins)
        inside = np.repeat(own, sizes)
        return Profiles(self.codes[inside], self.values[inside], np.cumsum([0, *sizes[own]]), self.width)

    def squares(self) -> np.ndarray:
        """Sums of the rows' squares, of some whole rows at a time."""
        out = np.empty(len(self), dtype=self.values.dtype)
        for k in range(0, len(self), 64):
            x = np.zeros((min(64, len(self) - k), self.width), dtype=self.values.dtype)
            for i, row in enumerate(x):
                at, values = self.row(k + i)
                row[at] = values
            out[k : k + 64] = np.einsum("ij,ij->i", x, x)
        return out


def train_svm(x: np.ndarray | Profiles, y: np.ndarray, epochs: int = EPOCHS, cost: float = COST, seed: int = SEED) -> np.ndarray:
    """Weights and, last, the bias of a linear SVM (squared hinge loss, dual coordinate descent); y is -1 or 1."""
    x = x if isinstance(x, Profiles) else Profiles.of(x)
    weights, row = np.zeros(x.width + 1, dtype=np.float64), np.zeros(x.width)
    norms = x.squares() + 1 + 0.5 / cost
    alpha, rng = np.zeros(len(x)), np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(x)):
            at, values = x.row(i)
            row[at] = values
            slope = y[i] * (row @ weights[:-1] + weights[-1]) - 1 + alpha[i] * 0.5 / cost
            row[at] = 0
            new = max(alpha[i] - slope / norms[i], 0.0)
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                weights[at] += step * values
                weights[-1] += step
                moved, alpha[i] = max(moved, abs(step)), new
        if moved < 1e-3:
            break
    return weights


@dataclass
class Votes:
    """One-versus-one machines over ``classes``: a column of ``weights`` for each pair."""

    classes: list[str]
    weights: np.ndarray = field(default_factory=lambda: np.zeros((1 << BITS, 0), dtype=np.float32))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @classmethod
    def fit(cls, x: Profiles, names: np.ndarray) -> Votes:
        classes = sorted(set(names))
        columns = []
        for a, b in combinations(classes, 2):
            own = (names == a) | (names == b)
            columns.append(train_svm(x.take(own), np.where(names[own] == a, 1.0, -1.0)))
        if not columns:
            return cls(classes)
        both = np.stack(columns, axis=1)
        return cls(classes, np.ascontiguousarray(both[:-1], dtype=np.float32), both[-1])

    def decide(self, codes: np.ndarray, scale: float) -> tuple[str, float]:
        """The class with most votes (ties: larger margins) and the least certainty with which it won."""
        if len(self.classes) == 1:
            return self.classes[0], 1.0
        margins = self.weights[codes].sum(axis=0, dtype=np.float64) / scale + self.bias
        votes, sure = np.zeros(len(self.classes)), np.zeros(len(self.classes))
        for (a, b), m in zip(combinations(range(len(self.classes)), 2), margins, strict=True):
            votes[a if m >= 0 else b] += 1
            sure[a] += np.tanh(m)
            sure[b] -= np.tanh(m)
        best = int(np.lexsort((sure, votes))[-1])
        own = [m if a == best else -m for (a, b), m in zip(combinations(range(len(self.classes)), 2), margins, strict=True) if best in (a, b)]
        return self.classes[best], float(1 / (1 + np.exp(-np.clip(3 * min(own), -30, 30))))


@dataclass
class Identifier:
    families: Votes
    languages: dict[str, Votes]
    usual: dict[str, np.ndarray] = field(default_factory=dict)  # of each language: bits by which a trigram is likelier than by chance

    @classmethod
    def fit(cls, x: Profiles, langs: np.ndarray) -> Identifier:
        of = np.array([family(lang) for lang in langs], dtype=object)
        usual = {}
        for lang in sorted(set(langs)):
            own = x.take(langs == lang)
            total = np.bincount(own.codes, own.values, x.width)
            usual[lang] = np.log2((total / (total.sum() or 1.0) * len(total) + SMOOTH) / (1 + SMOOTH))
        return cls(Votes.fit(x, of), {f: Votes.fit(x.take(of == f), langs[of == f]) for f in sorted(set(of))}, usual)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and certainty (0 to 1); ``und`` and 0 for null, for texts without a letter, or if nothing was learned."""
        if not has_letter(text) or not self.languages:
            return UNKNOWN, 0.0
        codes = trigrams(text)
        scale = unit(codes)
        group, first = self.families.decide(codes, scale)
        lang, second = self.languages[group].decide(codes, scale)
        return lang, min(first, second)


    def likeness(self, text: str | None, lang: str) -> float:
        """Bits by which a trigram of the text is likelier in the language than by chance, on average."""
        return float(self.usual[lang][trigrams(text)].mean()) if lang in self.usual else 0.0


def unit(codes: np.ndarray) -> float:
    """Length of a text's trigram count vector."""
    counts = np.bincount(codes, minlength=1 << BITS).astype(np.float64)
    return float(np.sqrt(counts @ counts)) or 1.0


def train(labelled: DataFrame, rows: int = TRAIN_ROWS) -> Identifier:
    """Learn from about ``rows`` distinct texts with a lang, as many for each language, chosen by a hash of the text.

    Ids do not matter; repeated rows count once; a text with several languages
    is an example of each.
    """
    known = bounded_batches(labelled).where("lang is not null and text is not null").select("lang", "text", *text_key(F.col("text")))
    counts = {r["lang"]: r["count"] for r in known.select("lang", "k1", "k2").distinct().groupBy("lang").count().collect()}
    if not counts:
        return Identifier(Votes([]), {})
    each = max(rows // len(counts), 1)
    share = F.create_map(*[F.lit(v) for lang, n in sorted(counts.items()) for v in (lang, min(1.0, each / n))])
    chosen = known.where(fraction_of(F.col("text"), 31) < share[F.col("lang")]).dropDuplicates(["lang", "k1", "k2"]).select("lang", "text")

    def profiles(batches):
        for pdf in batches:
            pdf = pdf[pdf["text"].map(has_letter)]
            yield pd.DataFrame({"lang": pdf["lang"], "x": [packed_profile(t) for t in pdf["text"]]})

    found = chosen.mapInPandas(profiles, "lang string, x binary").limit(4 * rows).toPandas().sort_values(["lang", "x"])
    if not len(found):
        return Identifier(Votes([]), {})
    return Identifier.fit(Profiles.unpack(found["x"].tolist()), found["lang"].to_numpy())


def identify(text: Column, model: Identifier) -> Column:
    """lang_pred and score of a text column, as a struct."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict(text)


def judge(text: Column, model: Identifier) -> Column:
    """lang_pred, score and likeness of a text column, as a struct.

    Marked as not deterministic, though it is, so that a verdict that is both
    filtered on and read is made once: Spark copies a deterministic one into
    the filter, which doubles the work and the Python workers of a task.
    """

    @F.pandas_udf("lang_pred string, score double, likeness double")
    def judged(texts: pd.Series) -> pd.DataFrame:
        found = [(t, *model.predict(t)) for t in texts]
        return pd.DataFrame([(lang, score, model.likeness(t, lang)) for t, lang, score in found], columns=["lang_pred", "score", "likeness"])

    return judged.asNondeterministic()(text)


def cuts(labelled: DataFrame, model: Identifier, max_loss: float = MAX_LOSS) -> tuple[float, float]:
    """Least score and least likeness, that together reject at most ``max_loss`` of the correctly identified rows.

    The highest, in steps of 1 / ``STEPS``, that each reject at most half of
    that. All rows with lang and text count; if none is identified correctly
    nothing is rejected.
    """
    known = bounded_batches(labelled).where("lang is not null and text is not null")
    right = known.select("lang", judge(F.col("text"), model).alias("p")).where(F.col("p.lang_pred") == F.col("lang"))
    either = right.select(F.posexplode(F.array("p.score", "p.likeness")).alias("kind", "value"))
    found = either.groupBy("kind", F.floor(F.col("value") * STEPS).alias("step")).count().toPandas().sort_values("step")

    def least(own: pd.DataFrame) -> float:
        below = own["count"].cumsum() - own["count"]
        allowed = below <= max_loss / 2 * own["count"].sum()
        return float(own["step"][allowed].iloc[-1]) / STEPS if len(own) else -np.inf

    return least(found[found["kind"] == 0]), least(found[found["kind"] == 1])


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from those whose id's crc32 modulo 4 is not 2.

    Only the text decides. Null texts, empty ones and those without a letter
    are ``und``; repeated rows are judged alike; no rows give no rows. Without
    labelled rows every text is ``und``.
    """
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    model = train(docs.where(~held_out))
    return docs.select("doc_id", held_out.alias("held_out"), identify(F.col("text"), model).alias("p")).select("doc_id", "held_out", "p.*")
