"""Column expressions (``Column -> Column``) for the derived fields.

Everything here is a native Catalyst expression, so it runs inside
whole-stage codegen (or, for the higher-order ``transform``, interpreted in
the JVM) and never crosses into Python.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from quadra import model as M

# --- fixed values (must equal the reference's) ------------------------------
# Token-by-token abbreviation expansion applied to district names.
ABBREVIATIONS: dict[str, str] = {
    "JD": "JARDIM",
    "JDM": "JARDIM",
    "VL": "VILA",
    "PQ": "PARQUE",
    "PQE": "PARQUE",
    "STA": "SANTA",
    "STO": "SANTO",
    "CID": "CIDADE",
    "CJ": "CONJUNTO",
    "CONJ": "CONJUNTO",
    "NSA": "NOSSA",
    "SRA": "SENHORA",
    "PCA": "PRACA",
}

# Text that a decimal number must look like before it is cast (trap 6).
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# --- P1 / P12 / P13: casts that agree with the reference engines ------------
def parse_decimal_text(c: Column) -> Column:
    """First ``,`` becomes ``.``, then a non-strict cast to double.

    Text that does not look like a plain decimal number gives null (Spark's
    own ``try_cast`` would accept suffixes such as ``d``/``f``).
    """
    dotted = F.regexp_replace(c, r"^([^,]*),", "$1.")
    return F.when(dotted.rlike(NUMBER_PATTERN), F.trim(dotted).try_cast("double"))


def coordinate(c: Column, source_type: str) -> Column:
    """P1 applied only when the landing column is text; numbers pass through."""
    if source_type == "string":
        return parse_decimal_text(c)
    return c.cast("double")


def safe_int(c: Column) -> Column:
    """``TRY_CAST(x AS INTEGER)`` with rounding of decimal text.

    Decimal and exponent text is rounded half away from zero, as the
    reference engine does; a dot right after the exponent is tolerated too.
    """
    raw = c.cast("string")
    text = F.regexp_replace(raw, r"([eE][+-]?\d+)\.(\s*)$", "$1$2")
    as_double = F.when(text.rlike(NUMBER_PATTERN), F.trim(text).try_cast("double"))
    general = F.round(as_double).try_cast("int")
    # fast path: plain digits (the usual version number) need no regex work
    return F.when(raw.rlike(r"^\d{1,9}$"), raw.cast("int")).otherwise(general)


# Year (1-4 digits), month and day with one separator (-, / or space) used
# twice, then an optional time of day.
_DATE_PARTS = (
    r"^\s*(\d{1,4})([-/ ])(\d{1,2})\2(\d{1,2})(([ T])(\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?))?\s*$"
)


def safe_date(c: Column) -> Column:
    """``TRY_CAST(x AS DATE)`` on year-first date text, else null.

    The year is zero-padded to four digits (short years are valid dates);
    when a time of day follows, the whole timestamp must be valid. Years of
    more than four digits, BC years and year 0 give null.
    """
    text = c.cast("string")

    def part(i: int) -> Column:
        return F.regexp_extract(text, _DATE_PARTS, i)

    day = F.concat_ws("-", F.lpad(part(1), 4, "0"), part(3), part(4))
    clock = part(7)
    as_date = F.when(clock == "", day.try_cast("date")).otherwise(
        F.concat(day, F.lit(" "), clock).try_cast("timestamp_ntz").cast("date")
    )
    # year 0 has no calendar date here (the year before 1 is 1 BC)
    general = F.when(text.rlike(_DATE_PARTS) & (part(1).cast("int") > 0), as_date)
    # fast path: a plain ISO date (the usual form) is cast directly
    iso = text.rlike(r"^\d{4}-\d{2}-\d{2}$") & ~text.startswith("0000")
    return F.when(iso, text.try_cast("date")).otherwise(general)


def landing_timestamp(c: Column) -> Column:
    """Date or date and time of a landing text: ISO or day first, else null."""
    text = F.trim(c.cast("string"))
    day_first = F.regexp_replace(text, r"^(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$2-$1")
    return F.coalesce(text.try_cast("timestamp_ntz"), day_first.try_cast("timestamp_ntz"))


# --- P3 / P10: calendar ------------------------------------------------------
def quarter_of_month(month: Column) -> Column:
    """``(month - 1) // 3 + 1`` with floor division; null stays null."""
    return (F.floor((month - F.lit(1)) / F.lit(3)) + F.lit(1)).cast("int")


def month_label(year: Column, month: Column) -> Column:
    """P10: ``YYYY-MM`` with a zero-padded month; null in, null out."""
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


# --- P5 / P6 / P14 / P15: flags and labels -----------------------------------
def has_coordinates(lat: Column | None, lon: Column | None) -> Column:
    """P5: southern latitude and a longitude present; never null."""
    if lat is None or lon is None:
        return F.lit(False)
    return lat.isNotNull() & (lat < 0) & lon.isNotNull()


def category(heading: Column) -> Column:
    """Category from the legal heading; first match wins; null -> Outros."""
    low = F.lower(heading)
    return (
        F.when(low.contains("roubo"), F.lit("Roubo"))
        .when(low.contains("furto"), F.lit("Furto"))
        .when(low.contains("perda") | low.contains("extravio"), F.lit("Perda"))
        .otherwise(F.lit("Outros"))
    )


def direction(delta: Column) -> Column:
    """Alta when the change is zero or positive, Queda otherwise."""
    return F.when(delta >= 0, F.lit(M.UP)).otherwise(F.lit(M.DOWN))


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` rounded half-to-even to one place."""
    return F.bround(part.cast("double") / whole * F.lit(100), 1)


def guarded_percent_change(current: Column, previous: Column) -> Column:
    """``(a - b) / b * 100`` rounded to one place; null when b is 0."""
    return F.when(previous > 0, percent(current - previous, previous))


def guarded_percent(part: Column, whole: Column) -> Column:
    """Share in percent; null when the whole is zero (trap 22)."""
    return F.when(whole > 0, percent(part, whole))


# --- P8: district normalisation ---------------------------------------------
def _strip_marks(text: str) -> str:
    decomposed = unicodedata.normalize("NFKD", text)
    return "".join(ch for ch in decomposed if not unicodedata.category(ch).startswith("M"))


# First code point after the Latin blocks with accents.
_LATIN_END = "\u0250"


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str, dict[str, str]]:
    """What every code point with a decomposition becomes, from ``unicodedata``.

    Spark has no Unicode normaliser, so the composition ``NFKD -> drop marks
    -> [^A-Z0-9 ] to space`` is folded per character into what that
    character finally becomes. One-character results go into a ``translate``
    table; results of several characters (fractions, Roman numerals, ligature
    letters) into a map. Characters that end up blank are left out: the
    punctuation step already blanks them.
    """
    src: list[str] = []
    dst: list[str] = []
    dropped: list[str] = []
    expansions: dict[str, str] = {}
    for cp in range(0x80, sys.maxunicode + 1):
        ch = chr(cp)
        if not unicodedata.decomposition(ch):
            continue
        stripped = _strip_marks(ch)
        final = re.sub(r"[^A-Z0-9 ]", " ", stripped)
        if not stripped:
            dropped.append(ch)
        elif final.strip() == "":
            continue
        elif len(final) == 1:
            src.append(ch)
            dst.append(final)
        else:
            expansions[ch] = final
    # ``translate`` deletes what has no counterpart: characters that are marks once decomposed.
    return "".join(src + dropped), "".join(dst), expansions


def latin_table() -> tuple[str, str]:
    """The part of :func:`accent_table` that makes one character of a Latin one (below ``_LATIN_END``)."""
    src, dst, _ = accent_table()
    pairs = [(a, b) for a, b in zip(src, dst) if a < _LATIN_END]  # those dropped have no counterpart
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def strip_accents(c: Column) -> Column:
    """NFKD + removal of combining marks, restricted to the output alphabet.

    The map of longer results is only looked up for the characters that are
    still outside ASCII after ``translate``.
    """
    src, dst, expansions = accent_table()
    out = F.regexp_replace(F.translate(c, src, dst), r"\p{M}", "")
    longer = F.create_map(*[F.lit(x) for kv in expansions.items() for x in kv])
    spread = F.array_join(
        F.transform(F.split(out, ""), lambda ch: F.when(F.octet_length(ch) > 1, F.coalesce(longer[ch], F.lit(" "))).otherwise(ch)), ""
    )
    return F.when(F.length(out) == F.octet_length(out), out).otherwise(spread)


# ASCII characters outside the output alphabet ``[A-Z0-9 ]`` (generated).
_ASCII_BLANKED = "".join(
    chr(i) for i in range(128) if not ("A" <= chr(i) <= "Z" or "0" <= chr(i) <= "9" or chr(i) == " ")
)


def normalise_district(c: Column) -> Column:
    """Trim, upper, strip accents, punctuation to space, collapse, expand.

    Null stays null and a blank name stays ``''``. Names that are pure ASCII
    after upper-casing (the vast majority) skip the accent folding, and those
    whose other letters are Latin ones get by with a small table (Spark compares
    the whole table with the last one's for every row). What follows
    is plain substring replacement, for every row runs it: ``<`` and ``>``, which
    are no longer in the text, mark the ends of a run of blanks, then every
    word has a blank of its own on both sides, so one replacement per
    abbreviation expands whole words only (no expansion is an abbreviation).
    """
    up = F.upper(c)
    ascii_only = F.length(up) == F.octet_length(up)
    src, dst = latin_table()
    latin = F.translate(up, src, dst)
    # One character for one: ASCII if there are as many bytes as characters.
    folded = F.when(ascii_only, up).when(F.octet_length(latin) == F.length(up), latin).otherwise(
        F.regexp_replace(strip_accents(up), r"[^A-Z0-9 ]", " ")
    )
    cleaned = F.translate(folded, _ASCII_BLANKED, " " * len(_ASCII_BLANKED))
    words = F.concat(F.lit(" "), cleaned, F.lit(" "))
    for old, new in ((" ", "<>"), ("><", ""), ("<>", "  "), *((f" {k} ", f" {v} ") for k, v in ABBREVIATIONS.items()), ("  ", " ")):
        words = F.replace(words, F.lit(old), F.lit(new))
    return F.trim(words)
