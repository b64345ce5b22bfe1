"""Rule statistics of whole texts, and the ratios that the quality models learn from."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd

from quadra.llm.common import find_words

SYMBOLS = "#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_SPACE = b" \t\n\v\f\r"
_HIGH = bytes(range(128, 256))

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = (
    "mean_word", "symbols_per_word", "marks_per_word", "upper_share", "digit_share", "dup_line_share",
    "repeat_share", "distinct_share", "top_word_share", "words_per_line", "short_text",
)


def repeated_words(words: list[str]) -> int:
    """Words inside 3-word windows that occur twice or more, the first occurrence included."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    often = Counter(windows)
    inside = bytearray(len(words))
    for i, window in enumerate(windows):
        if often[window] > 1:
            inside[i : i + 3] = b"\1\1\1"
    return sum(inside)


def repeated_lines(text: str) -> int:
    """Lines (split at line feeds) that hold a word and equal an earlier line."""
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return 0
    often = Counter(lines)
    return sum(n - 1 for line, n in often.items() if n > 1 and find_words(line))


def statistics(text: str | None) -> tuple[float, ...]:
    """COUNTS, then RATIOS, of a text; all 0 for null and for a text without words (but short_text 1)."""
    text = text or ""
    words = find_words(text)
    if not words:
        return (0, 0, sum(map(text.count, SYMBOLS)), *[0.0] * (len(COUNTS) - 3 + len(RATIOS) - 1), 1.0)
    n = len(words)
    word_chars = sum(map(len, words))
    symbols = sum(map(text.count, SYMBOLS))
    lines, repeats = repeated_lines(text), repeated_words(words)
    raw = text.encode("utf-8", "surrogatepass")
    size = len(raw)
    upper = size - len(raw.translate(None, _UPPER))
    digits = size - len(raw.translate(None, _DIGIT))
    marks = len(raw.translate(None, _UPPER + _LOWER + _DIGIT + _SPACE + _HIGH))
    often = Counter(words)
    return (
        n, word_chars, symbols, lines, repeats,
        word_chars / n,
        symbols / n,
        marks / n,
        upper / size,
        digits / size,
        lines / (text.count("\n") + 1),
        repeats / n,
        len(often) / math.sqrt(n),
        max(often.values()) / n,
        math.log1p(n / (text.count("\n") + 1)),
        1 / math.log2(n + 1),
    )


def table(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([statistics(t) for t in texts], columns=[*COUNTS, *RATIOS], index=texts.index)


def matrix(stats: pd.DataFrame, columns: tuple[str, ...] = RATIOS) -> np.ndarray:
    return stats[list(columns)].to_numpy(dtype=np.float64)
