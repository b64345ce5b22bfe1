"""Line dedup over the whole corpus by deletion neighbourhoods, Spark expressions only.

A line is compared in lower case with its white space collapsed. A line equal
to an earlier one is dropped; so is one of ``MIN_LENGTH`` characters or more
that is one edit (a character put in, left out or changed) from an earlier
distinct line. Earlier: by doc_id, then row, then place in the text.

Equal lines meet by 128-bit digests, pre-aggregated, so a line that stands in
every document is one row per task. For the edits, every distinct line emits
the digests of its deletion variants:

* two lines of one length, a character changed at place i, share the variant
  without character i: they meet on (variant, i);
* a line with a character left out is itself a variant of the longer one.

In either case the lines that meet are neighbours, so each is paired with the
earliest of its group (never all with all) and the edit distance is verified.

Of two lines one edit apart, with m the shorter length, either the first m/2
characters or the last m - m/2 are equal. So lines meet on a half first, each
as the shorter one (m its length) and as the longer one; only lines that do,
with lengths that fit, emit variants, and only of the other half, which holds
the edit. No pair is lost by this, and a variant costs a quarter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadra.llm.common import checked_broadcast, documents, written

MIN_LENGTH = 20
BROADCAST_ROWS = 200_000
SPACE = r"[\x20\x09-\x0D]+"


def normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, SPACE, " ")))


def _halves(line: Column, n: Column) -> Column:
    """Digests of both halves, as the shorter line of a pair and as the longer one."""

    def keys(m: Column, salt: int) -> list[Column]:
        half = F.floor(m / 2).cast("int")
        return [
            F.xxhash64(m, F.lit(salt), F.substring(line, F.lit(1), half)),
            F.xxhash64(m, F.lit(salt + 1), F.substring(line, n - (m - half) + 1, m - half)),
        ]

    return F.array(*keys(n, 0), *keys(n - 1, 0))


def distinct_lines(rows: DataFrame) -> DataFrame:
    """h1, h2, first (doc_id, row, pos) and halves of every distinct line that is not blank."""
    lines = rows.select("row", "doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    lines = lines.select("row", "doc_id", "pos", normal(F.col("raw")).alias("line")).where("line != ''")
    n = F.length("line")
    first = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "pos")
    halves = _halves(F.col("line"), n)
    lines = lines.select(
        F.xxhash64("line").alias("h1"),
        F.xxhash64(F.lit(7), "line").alias("h2"),
        first.alias("first"),
        *[F.when(n >= MIN_LENGTH, halves[k]).alias(f"half{k}") for k in range(4)],
    )
    same = [F.first(f"half{k}").alias(f"half{k}") for k in range(4)]
    return written(lines.groupBy("h1", "h2").agg(F.min("first").alias("first"), *same), "lines")


def meetings(lines: DataFrame) -> DataFrame:
    """h1, h2, roles of the lines that share a half with a line of a length that fits.

    A role is (k, half, shorts, longs): k 0 and 1 are the first and last half
    of a line as the shorter one, 2 and 3 as the longer one; shorts and longs
    count the lines that share the half in these roles.
    """
    halves = lines.where("half0 is not null").select("h1", "h2", F.posexplode(F.array(*[f"half{k}" for k in range(4)])).alias("k", "half"))
    met = halves.groupBy(F.col("half").alias("met")).agg(F.count_if(F.col("k") < 2).alias("shorts"), F.count_if(F.col("k") >= 2).alias("longs"))
    met = met.where("shorts >= 2 or (shorts >= 1 and longs >= 1)")
    halves = halves.join(met, F.col("half") == F.col("met")).where("k >= 2 or shorts >= 2 or longs >= 1")
    return halves.groupBy("h1", "h2").agg(F.collect_list(F.struct("k", "half", "shorts", "longs")).alias("roles"))


def neighbours(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """first of every distinct line that is one edit from an earlier one."""
    firsts = lines.select(F.col("h1").alias("l1"), F.col("h2").alias("l2"), "first")
    chosen = checked_broadcast(written(meetings(lines), "meetings"), BROADCAST_ROWS)
    chosen = written(firsts.join(chosen, (F.col("l1") == F.col("h1")) & (F.col("l2") == F.col("h2"))).select("first", "roles"), "chosen")
    places = checked_broadcast(chosen.select(F.col("first.row").alias("at"), "first", "roles"), BROADCAST_ROWS)
    text = rows.join(places, F.col("row") == F.col("at")).select(
        "first", "roles", normal(F.get(F.split("text", "\n"), F.col("first.pos"))).alias("line")
    )
    # Ids rise in the order of the lines, so the least id of a group is its earliest line.
    found = written(text.orderBy("first").withColumn("id", F.monotonically_increasing_id()), "near-lines")

    n = F.length("line")
    parts = found.select("id", "line", F.inline("roles"))
    shorter = n - (F.col("k") >= 2).cast("int")
    half = F.floor(shorter / 2).cast("int")
    rest = F.when(F.col("k") % 2 == 0, F.substring(F.col("line"), half + 1, n)).otherwise(F.substring(F.col("line"), F.lit(1), n - (shorter - half)))
    parts = parts.select("id", "k", "half", "shorts", "longs", rest.alias("rest"))
    variants = F.transform(
        F.sequence(F.lit(1), F.length("rest")),
        lambda i: F.xxhash64(
            F.col("half"), F.concat(F.substring(F.col("rest"), F.lit(1), i - 1), F.substring(F.col("rest"), i + 1, F.length("rest")))
        ),
    )
    changed = parts.where("k < 2 and shorts >= 2").select("id", F.posexplode(variants).alias("i", "variant"))
    changed = changed.select("id", F.xxhash64("variant", "i").alias("key"))
    groups = changed.groupBy("key").agg(F.min("id").alias("early"), F.max("id").alias("late")).where("early < late")
    groups = checked_broadcast(written(groups.select(F.col("key").alias("in"), "early"), "groups"), BROADCAST_ROWS)
    changed = changed.join(groups, F.col("key") == F.col("in")).where("id > early").select("early", F.col("id").alias("late"))
    left_out = parts.where("k >= 2").select("id", F.explode(variants).alias("variant"))
    own = checked_broadcast(
        parts.where("k < 2 and longs >= 1").select(F.col("id").alias("other"), F.xxhash64("half", "rest").alias("own")), BROADCAST_ROWS
    )
    left_out = left_out.join(own, F.col("variant") == F.col("own")).where("id != other")
    left_out = left_out.select(F.least("id", "other").alias("early"), F.greatest("id", "other").alias("late"))
    pairs = changed.union(left_out).distinct()
    early = found.select(F.col("id").alias("early_id"), F.col("line").alias("early_line"))
    late = found.select(F.col("id").alias("late_id"), "line", "first")
    near = (
        pairs.join(early, F.col("early") == F.col("early_id"))
        .join(late, F.col("late") == F.col("late_id"))
        .where(F.levenshtein("early_line", "line", 1) >= 0)
    )
    return near.select("first").distinct()


def dedup_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text, n_lines, n_exact, n_near of every document, the text without the dropped lines.

    n_lines counts lines with a character, n_exact and n_near those dropped.
    Lines are split at line feeds; blank lines stay. A null text has no lines
    and stays null. Documents without id come last; repeated rows are
    documents of their own, so the later ones lose their lines. No rows give
    no rows; other columns are ignored.
    """
    rows = written(docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id()), "rows")
    lines = distinct_lines(rows.where("text is not null"))
    near = neighbours(rows, lines)
    marks = lines.select("first.row", "first.pos", F.lit(False).alias("near")).unionByName(
        near.select("first.row", "first.pos", F.lit(True).alias("near"))
    )
    marks = marks.groupBy(F.col("row").alias("of")).agg(
        F.collect_list(F.when(~F.col("near"), F.col("pos"))).alias("firsts"), F.collect_list(F.when(F.col("near"), F.col("pos"))).alias("nears")
    )
    none = F.array().cast("array<int>")
    split = F.split("text", "\n")
    places = F.sequence(F.lit(0), F.size("split") - 1)
    blank = F.filter(places, lambda i: ~F.rlike(F.get("split", i), F.lit(r"[^\x20\x09-\x0D]")))
    joined = rows.join(marks, F.col("row") == F.col("of"), "left").select(
        "doc_id", split.alias("split"), F.coalesce("firsts", none).alias("firsts"), F.coalesce("nears", none).alias("nears")
    )
    joined = joined.withColumn("blank", F.when(F.col("split").isNotNull(), blank))
    kept = F.array_sort(F.concat(F.array_except("firsts", "nears"), F.col("blank")))
    counted = F.coalesce(F.size("split") - F.size("blank"), F.lit(0))
    return joined.select(
        "doc_id",
        F.array_join(F.transform(kept, lambda i: F.get("split", i)), "\n").alias("text"),
        F.when(F.col("split").isNull(), 0).otherwise(counted).cast("long").alias("n_lines"),
        F.when(F.col("split").isNull(), 0).otherwise(counted - F.size("firsts")).cast("long").alias("n_exact"),
        F.size("nears").cast("long").alias("n_near"),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line dedup leaves of every document."""
    return dedup_lines(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_exact", "n_near", F.length("text").cast("long").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256")
    )


OP6_SQL = """
WITH lines AS (
  SELECT doc_id, pos, raw, lower(trim(regexp_replace(raw, '[\\x20\\x09-\\x0D]+', ' ', 'g'))) AS line FROM (
    SELECT doc_id, unnest(range(len(parts))) AS pos, unnest(parts) AS raw
    FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL))),
firsts AS (
  SELECT line, length(line) AS n, min({'d': doc_id, 'p': pos}) AS first FROM lines WHERE line != '' GROUP BY line),
near AS (
  SELECT DISTINCT b.first FROM firsts a JOIN firsts b ON a.n BETWEEN b.n - 1 AND b.n + 1 AND a.first < b.first
  WHERE a.n >= 20 AND b.n >= 20
    AND levenshtein(a.line, b.line) <= 1),
marked AS (
  SELECT l.*, f.first IS NOT NULL AS is_first, n.first IS NOT NULL AS is_near
  FROM lines l LEFT JOIN firsts f ON l.line = f.line AND f.first = {'d': l.doc_id, 'p': l.pos}
    LEFT JOIN near n ON n.first = {'d': l.doc_id, 'p': l.pos}),
texts AS (
  SELECT doc_id, count(*) FILTER (line != '') AS n_lines, count(*) FILTER (line != '' AND NOT is_first) AS n_exact,
    count(*) FILTER (is_near) AS n_near,
    coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (line = '' OR (is_first AND NOT is_near)), '') AS kept
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_exact, 0) AS n_exact, coalesce(n_near, 0) AS n_near,
  length(kept) AS kept_chars, sha256(kept) AS kept_sha256
FROM documents d LEFT JOIN texts t ON d.doc_id = t.doc_id
"""
