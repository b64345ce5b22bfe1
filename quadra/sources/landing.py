"""Landing scan: folders of files whose headers drift, records over several lines, malformed records.

A folder is listed by Spark; the header of every file is looked at, and files
that share one are read in one scan, so columns go by name from file to file.
CSV is read as text. A record may hold line breaks within quotes: files no
larger than a scan split are parsed whole, which costs no parallelism; larger ones
are split, unless a scan for unbalanced quotes finds that a record of theirs goes
over lines, and then each is parsed by one task. A record with more or fewer
fields than its header keeps what can be placed, and its whole text as well.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text of a record whose fields do not match its header (null elsewhere).
RECORD = "_record"
# One way to read CSV, in batch and in streams: a quoted empty text stays empty,
# only a field without text is null, quotes are doubled; whole rows are parsed, so that
# a malformed record is seen whatever columns a query needs.
CSV_OPTIONS = {
    "header": "true", "escape": '"', "nullValue": "\x00", "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": RECORD, "columnPruning": "false",
}
_WHOLE_ONLY = (".gz", ".zst", ".snappy", ".lz4", ".xz")
_LOOKS = 16  # headers looked at side by side


def listed(spark: SparkSession, path: str) -> list[tuple[str, int, str]]:
    """path, bytes and URI of every file under a path (no contents are read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return sorted(tuple(r) for r in files.select("path", "length", F.col("_metadata.file_path")).where("length > 0").collect())


def split_bytes(spark: SparkSession) -> int:
    """Bytes of a scan split as the session sets them (128m, 134217728b, ...)."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", spark.conf.get("spark.sql.files.maxPartitionBytes").lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def over_lines(spark: SparkSession, files: list[tuple[str, int, str]]) -> set[str]:
    """Of the files larger than a split, those with a line whose quotes do not balance."""
    large = {uri: path for path, size, uri in files if size > split_bytes(spark) and not path.endswith(_WHOLE_ONLY)}
    if not large:
        return set()
    lines = spark.read.text(list(large.values())).where(F.regexp_count("value", F.lit('"')) % 2 == 1)
    return {large[r[0]] for r in lines.select("_metadata.file_path").distinct().collect()}


def csv_schema(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in (*names, RECORD)])


def _csv_frames(spark: SparkSession, path: str, schema: T.StructType | None) -> list[DataFrame]:
    files = listed(spark, path)
    small = {p for p, size, _ in files if size <= split_bytes(spark) or p.endswith(_WHOLE_ONLY)}
    whole = small | over_lines(spark, files)

    def header(file: str) -> tuple[str, ...]:
        if schema is not None:
            return ()
        return tuple(n.lstrip("﻿") for n in spark.read.options(**CSV_OPTIONS, multiLine="true").csv(file).columns)

    with ThreadPoolExecutor(_LOOKS) as pool:
        headers = list(pool.map(header, [p for p, _, _ in files]))
    groups: dict[tuple, list[str]] = {}
    for (file, _, _), names in zip(files, headers, strict=True):
        groups.setdefault((names, file in whole), []).append(file)
    frames = []
    for (names, lines), members in groups.items():
        fields = csv_schema(names) if schema is None else T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
        reader = spark.read.schema(fields).options(**CSV_OPTIONS, multiLine=str(lines).lower())
        frames.append(reader.csv(members))
    return frames


def _typed_frames(spark: SparkSession, path: str, fmt: str) -> list[DataFrame]:
    """Files that bear their own schema (Parquet, ORC), one scan per schema."""
    files = [p for p, _, _ in listed(spark, path)]
    with ThreadPoolExecutor(_LOOKS) as pool:
        schemas = list(pool.map(lambda p: spark.read.format(fmt).load(p).schema, files))
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for file, schema in zip(files, schemas, strict=True):
        groups.setdefault(schema.json(), (schema, []))[1].append(file)
    return [spark.read.schema(schema).format(fmt).load(members) for schema, members in groups.values()]


def frames(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType | None = None) -> list[DataFrame]:
    """The scans of a landing file or folder, one for every header or schema in it.

    A declared ``schema`` holds for all files of the path. JSON is read by name
    as it is. A folder without files, or with empty ones only, gives none.
    """
    if fmt == "csv":
        return _csv_frames(spark, path, schema)
    if schema is None and fmt in ("parquet", "orc"):
        return _typed_frames(spark, path, fmt)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return [reader.format(fmt).load(path)]
