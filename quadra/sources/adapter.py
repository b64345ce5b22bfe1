"""Incident-shaped landing rows derived from the driver's star-schema tables.

The checks run on TPC-H-like tables, not on incident reports, so the landing
rows are derived from ``lineitem`` joined to its dimensions: every line item
becomes one incident row. The key arithmetic below (``l_partkey % 41`` ...)
only *assigns* attribute values — spellings, blanks, placeholders, bad texts,
the second city — so every data-quality case of the reference occurs; it never
removes a row. The same mapping is written in SQL in
:mod:`quadra.plans.oracle` so both engines start from the same rows.

Join plan (designed for the fact table being by far the largest input):

* only the tables whose columns a query asks for are joined;
* the order side is built first — ``orders`` with its customer's nation — so
  ``customer`` is joined to ``orders`` (a quarter of the fact rows), not to
  ``lineitem``;
* every join is a LEFT join from the fact side, so no line is ever lost when
  a key has no match (the lake's rule: no record is dropped);
* no broadcast hint is given: the planner broadcasts a side only when its
  measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE
  re-plans at run time from real shuffle sizes; above that, sort-merge join,
  with AQE's skew-join split for a hot key on the fact side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadra import model as M

# --- fixed values of the mapping (shared with the SQL form) -----------------
# Legal headings by order priority.
HEADINGS = {
    "1-URGENT": "Roubo (art. 157)",
    "2-HIGH": "FURTO (art. 155)",
    "3-MEDIUM": "Perda de objeto",
    "4-NOT SPECIFIED": "Extravio de documento",
    "5-LOW": "Estelionato",
}
# Period text by ``l_orderkey % 7`` (5 is the source's placeholder, 6 null).
PERIOD_BY_REMAINDER = ("De madrugada", "Pela manhã", "A tarde", "A noite", "Em hora incerta", "NULL")
OTHER_CITY = "CAMPINAS"
# Rows shipped from this date on belong to the other city only, so the city
# scope of the newest year lacks a quarter (comparable quarters are then a
# true intersection).
OTHER_CITY_FROM = "2001-10-01"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(*branches: tuple[Column, Column], otherwise: Column | None = None) -> Column:
    expr = F.when(branches[0][0], branches[0][1])
    for cond, value in branches[1:]:
        expr = expr.when(cond, value)
    return expr.otherwise(otherwise) if otherwise is not None else expr


# Landing columns by the tables they need besides ``lineitem``.
NEEDS = {
    M.ANO_BO: {"orders"},
    M.RUBRICA: {"orders"},
    M.DATAHORA_REGISTRO_BO: {"orders"},
    M.BAIRRO: {"orders", "nation"},
    M.MARCA_OBJETO: {"part"},
    M.LOGRADOURO: {"supplier"},
}


def _lines(spark: SparkSession, sf_dir: str, tables: set[str]) -> DataFrame:
    """Line items joined to the dimensions among ``tables``, every line kept."""
    rows = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_shipdate"
    )
    if "orders" in tables:
        orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
        if "nation" in tables:
            nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
            customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
            orders = orders.join(customer, orders.o_custkey == customer.c_custkey, "left").join(
                nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"
            )
        rows = rows.join(orders, rows.l_orderkey == orders.o_orderkey, "left")
    if "part" in tables:
        part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
        rows = rows.join(part, rows.l_partkey == part.p_partkey, "left")
    if "supplier" in tables:
        supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
        rows = rows.join(supplier, rows.l_suppkey == supplier.s_suppkey, "left")
    return rows


def landing_incidents(spark: SparkSession, sf_dir: str, columns: set[str] | None = None) -> DataFrame:
    """Landing rows: text coordinates, drifting texts, every line kept.

    With ``columns`` only those are derived, and only the tables they need are
    joined.
    """
    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    line = F.col("l_linenumber")
    name = F.col("n_name")

    heading = _case(
        (F.col("o_orderkey") % 53 == 0, F.lit(None).cast("string")),
        *[(F.col("o_orderpriority") == k, F.lit(v)) for k, v in HEADINGS.items()],
    )
    district = _case(
        (pk % 41 == 0, F.lit(None).cast("string")),
        (pk % 43 == 0, F.lit("")),
        (pk % 89 == 0, F.concat(F.lit("PQ. DO CARMO "), name)),
        (pk % 97 == 0, F.concat(F.lit("Ⅷ CENTENÁRIO "), name)),
        (pk % 83 == 0, F.concat(F.lit("ＪＤ ＰＡＺ "), name)),
        (pk % 5 == 0, F.concat(F.lit("  jd.  são "), F.lower(name))),
        (pk % 5 == 1, F.concat(F.lit("JARDIM SÃO "), name)),
        (pk % 5 == 2, F.concat(F.lit("VL "), name)),
        (pk % 5 == 3, F.concat(F.lit("Vila-"), name)),
        otherwise=F.concat(F.lit("STA "), name),
    )
    period = _case(
        *[
            (ok % 7 == i, F.lit(text))
            for i, text in enumerate(PERIOD_BY_REMAINDER)
            if i != 4
        ],
        (ok % 7 == 4, F.when(line == 7, F.lit("")).otherwise(F.lit(PERIOD_BY_REMAINDER[4]))),
    )
    brand = _case(
        (pk % 59 == 0, F.lit(None).cast("string")),
        (pk % 37 == 0, F.lit("")),
        (pk % 31 == 0, F.lit(M.NULL_TEXT)),
        otherwise=F.col("p_brand"),
    )
    latitude = _case(
        (F.col("l_returnflag") == "N", F.lit(None).cast("string")),
        (pk % 211 == 0, F.lit("-23.5d")),
        (ok % 223 == 0, F.lit("n/d")),
        (sk % 17 == 0, F.lit("10.0")),
        otherwise=F.concat(F.lit("-23,"), (F.lit(4000) + pk % 3000).cast("string")),
    )
    longitude = F.when(sk % 13 == 0, F.lit(None).cast("string")).when(ok % 307 == 0, F.lit("-1000000000000")).otherwise(
        F.concat(F.lit("-46,"), (F.lit(5000) + ok % 3000).cast("string"))
    )
    version = _case(
        (ok % 101 == 0, F.lit("1.5")),
        (ok % 103 == 0, F.lit("v2")),
        otherwise=line.cast("string"),
    )
    registered = _case(
        (F.col("o_orderkey") % 97 == 0, F.lit("2024")),
        (F.col("o_orderkey") % 113 == 0, F.lit("sem data")),
        otherwise=F.col("o_orderdate").cast("date").cast("string"),
    )
    city = F.when(
        (sk % 10 == 0) | (F.col("l_shipdate") >= F.lit(OTHER_CITY_FROM).cast("timestamp_ntz")),
        F.lit(OTHER_CITY),
    ).otherwise(F.lit(M.CITY))
    month = F.when((ok % 131 == 0) & (line == 1), F.lit(None).cast("int")).otherwise(
        F.month("l_shipdate")
    )

    year = F.when((ok % 127 == 0) & (line == 2), F.lit(None).cast("int")).otherwise(F.year("l_shipdate"))
    derived = {
        M.NUM_BO: F.lpad(ok.cast("string"), 9, "0"),
        M.VERSAO: version,
        M.ANO_BO: F.year("o_orderdate"),
        M.ANO: year,
        M.MES: month,
        M.CIDADE: city,
        M.RUBRICA: heading,
        M.BAIRRO: district,
        M.DESCR_PERIODO: period,
        M.MARCA_OBJETO: brand,
        M.LOGRADOURO: F.col("s_name"),
        M.LATITUDE: latitude,
        M.LONGITUDE: longitude,
        M.DATA_OCORRENCIA_BO: F.when(ok % 89 == 0, F.lit(None)).otherwise(F.col("l_shipdate")),
        M.DATAHORA_REGISTRO_BO: registered,
    }
    wanted = [c for c in derived if columns is None or c in columns]
    tables = set().union(*[NEEDS.get(c, set()) for c in wanted])
    return _lines(spark, sf_dir, tables).select(*[derived[c].alias(c) for c in wanted])


# --- landing files ------------------------------------------------------------
# Files from this year on use the newer year/month names and carry the
# report-version columns; older files lack them. Rows without a year land in
# the newer one.
NEW_FORMAT_FROM = 1999
# A column no layer declares: digits in the older file, text in the newer one.
REMARK = "OBSERVACAO"
# Columns of the landing files that the checks read.
LANDED = frozenset(
    (M.NUM_BO, M.VERSAO, M.ANO_BO, M.ANO, M.MES, M.BAIRRO, M.LATITUDE, M.LONGITUDE, M.DATA_OCORRENCIA_BO)
)


def write_landing_files(
    spark: SparkSession, sf_dir: str, root: str, columns: frozenset[str] | None = LANDED, together: bool = False
) -> list[str]:
    """Two drifting CSV file groups that together hold every landing row (``columns`` None: whole).

    Dates are day first in a third of the rows and unreadable in some, some
    months are words, report numbers have leading zeros. Each group has a folder
    of its own, or the files of both lie side by side in one.
    """
    rows = landing_incidents(spark, sf_dir, columns)
    key, date = F.col(M.NUM_BO).cast("bigint"), F.col(M.DATA_OCORRENCIA_BO)
    rows = rows.withColumns(
        {
            M.MES: F.when(key % 137 == 0, F.lit("jan")).otherwise(F.col(M.MES).cast("string")),
            M.DATA_OCORRENCIA_BO: F.when(key % 149 == 0, F.lit("ontem"))
            .when(key % 3 == 0, F.date_format(date, "dd/MM/yyyy HH:mm:ss"))
            .otherwise(F.date_format(date, "yyyy-MM-dd HH:mm:ss")),
        }
    )
    old = F.coalesce(F.col(M.ANO) < NEW_FORMAT_FROM, F.lit(False))
    groups = {
        "older": rows.where(old).drop(M.VERSAO, M.ANO_BO).withColumn(REMARK, (key % 10).cast("string")),
        "newer": rows.where(~old)
        .withColumnsRenamed({M.ANO: M.ANO_REGISTRO_BO, M.MES: M.MES_REGISTRO_BO})
        .withColumn(REMARK, F.when(key % 2 == 0, F.lit("S/N")).otherwise(F.lpad((key % 10).cast("string"), 3, "0"))),
    }
    options = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    for name, group in groups.items():
        group.write.mode("append").options(**options).csv(root if together else f"{root}/{name}")
    return [root] if together else [f"{root}/{name}" for name in groups]


# Files that the malformed records are dealt to.
MALFORMED_FILES = 32
MALFORMED_HEADER = (M.NUM_BO, M.VERSAO, M.ANO, M.MES, M.BAIRRO, REMARK)


def write_malformed_files(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Every landing row as a CSV record written out as text: in some a remark with quotes goes
    over two lines, some have fields to spare, some end after the year."""
    rows = landing_incidents(spark, sf_dir, {M.NUM_BO, M.VERSAO, M.ANO, M.MES, M.BAIRRO})
    key = F.col(M.NUM_BO).cast("bigint")
    remark = F.when(key % 11 == 0, F.concat(F.lit('linha 1\ndisse ""'), (key % 10).cast("string"), F.lit('"", fim'))).otherwise(F.lit("ok"))
    head = F.concat_ws(",", M.NUM_BO, M.VERSAO, F.coalesce(F.col(M.ANO).cast("string"), F.lit("")))
    district = F.when(F.col(M.BAIRRO).isNull(), F.lit("")).otherwise(F.concat(F.lit('"'), M.BAIRRO, F.lit('"')))
    whole = F.concat_ws(",", head, F.coalesce(F.col(M.MES).cast("string"), F.lit("")), district, F.concat(F.lit('"'), remark, F.lit('"')))
    record = F.when(key % 17 == 0, F.concat(whole, F.lit(',sobra,"x, y"'))).when(key % 19 == 0, head).otherwise(whole)
    dealt = rows.select(F.pmod(F.xxhash64(M.NUM_BO), F.lit(MALFORMED_FILES)).alias("file"), F.lit(1).alias("place"), record.alias("value"))
    headers = spark.range(MALFORMED_FILES).select(F.col("id").alias("file"), F.lit(0).alias("place"), F.lit(",".join(MALFORMED_HEADER)).alias("value"))
    files = dealt.unionByName(headers).repartition(MALFORMED_FILES, "file").sortWithinPartitions("file", "place").select("file", "value")
    files.write.partitionBy("file").text(root)
    return root
