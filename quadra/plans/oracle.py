"""DuckDB SQL for every registered query — the independent check.

The landing mapping, the raw and transformed derivations and each report
are restated in plain SQL over the driver's tables (pre-registered views
``lineitem orders customer nation part supplier``). Where DuckDB's own
semantics are the reference behaviour (``TRY_CAST``, ``strip_accents``,
``round_even``), the SQL uses them directly instead of our Spark guards.
"""

from __future__ import annotations

# All values are written out here, so that a slip in the package under test
# cannot agree with itself.
_ABBREV_MAP = """MAP {'JD': 'JARDIM', 'JDM': 'JARDIM', 'VL': 'VILA', 'PQ': 'PARQUE', 'PQE': 'PARQUE', 'STA': 'SANTA',
          'STO': 'SANTO', 'CID': 'CIDADE', 'CJ': 'CONJUNTO', 'CONJ': 'CONJUNTO', 'NSA': 'NOSSA', 'SRA': 'SENHORA',
          'PCA': 'PRACA'}"""

LANDING = """
order_side AS (
    SELECT o_orderkey, o_orderdate, o_orderpriority, n_name
    FROM orders
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
),
landing AS (
    SELECT
      lpad(CAST(l_orderkey AS VARCHAR), 9, '0') AS NUM_BO,
      CASE WHEN l_orderkey % 101 = 0 THEN '1.5'
           WHEN l_orderkey % 103 = 0 THEN 'v2'
           ELSE CAST(l_linenumber AS VARCHAR) END AS VERSAO,
      year(o_orderdate) AS ANO_BO,
      CASE WHEN l_orderkey % 127 = 0 AND l_linenumber = 2 THEN NULL ELSE year(l_shipdate) END AS ANO,
      CASE WHEN l_orderkey % 131 = 0 AND l_linenumber = 1 THEN NULL ELSE month(l_shipdate) END AS MES,
      CASE WHEN l_suppkey % 10 = 0 OR l_shipdate >= TIMESTAMP '2001-10-01'
           THEN 'CAMPINAS' ELSE 'S.PAULO' END AS CIDADE,
      CASE WHEN o_orderkey % 53 = 0 THEN NULL
           WHEN o_orderpriority = '1-URGENT' THEN 'Roubo (art. 157)'
           WHEN o_orderpriority = '2-HIGH' THEN 'FURTO (art. 155)'
           WHEN o_orderpriority = '3-MEDIUM' THEN 'Perda de objeto'
           WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Extravio de documento'
           WHEN o_orderpriority = '5-LOW' THEN 'Estelionato'
      END AS RUBRICA,
      CASE WHEN l_partkey % 41 = 0 THEN NULL
           WHEN l_partkey % 43 = 0 THEN ''
           WHEN l_partkey % 89 = 0 THEN 'PQ. DO CARMO ' || n_name
           WHEN l_partkey % 97 = 0 THEN 'Ⅷ CENTENÁRIO ' || n_name
           WHEN l_partkey % 83 = 0 THEN 'ＪＤ ＰＡＺ ' || n_name
           WHEN l_partkey % 5 = 0 THEN '  jd.  são ' || lower(n_name)
           WHEN l_partkey % 5 = 1 THEN 'JARDIM SÃO ' || n_name
           WHEN l_partkey % 5 = 2 THEN 'VL ' || n_name
           WHEN l_partkey % 5 = 3 THEN 'Vila-' || n_name
           ELSE 'STA ' || n_name END AS BAIRRO,
      CASE l_orderkey % 7
           WHEN 0 THEN 'De madrugada' WHEN 1 THEN 'Pela manhã' WHEN 2 THEN 'A tarde'
           WHEN 3 THEN 'A noite'
           WHEN 4 THEN CASE WHEN l_linenumber = 7 THEN '' ELSE 'Em hora incerta' END
           WHEN 5 THEN 'NULL'
           ELSE NULL END AS DESCR_PERIODO,
      CASE WHEN l_partkey % 59 = 0 THEN NULL
           WHEN l_partkey % 37 = 0 THEN ''
           WHEN l_partkey % 31 = 0 THEN 'NULL'
           ELSE p_brand END AS MARCA_OBJETO,
      s_name AS LOGRADOURO,
      CASE WHEN l_returnflag = 'N' THEN NULL
           WHEN l_partkey % 211 = 0 THEN '-23.5d'
           WHEN l_orderkey % 223 = 0 THEN 'n/d'
           WHEN l_suppkey % 17 = 0 THEN '10.0'
           ELSE '-23,' || CAST(4000 + l_partkey % 3000 AS VARCHAR) END AS LATITUDE,
      CASE WHEN l_suppkey % 13 = 0 THEN NULL
           WHEN l_orderkey % 307 = 0 THEN '-1000000000000'
           ELSE '-46,' || CAST(5000 + l_orderkey % 3000 AS VARCHAR) END AS LONGITUDE,
      CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE l_shipdate END AS DATA_OCORRENCIA_BO,
      CASE WHEN o_orderkey % 97 = 0 THEN '2024'
           WHEN o_orderkey % 113 = 0 THEN 'sem data'
           ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS DATAHORA_REGISTRO_BO
    FROM lineitem
    LEFT JOIN order_side ON l_orderkey = o_orderkey
    LEFT JOIN part ON l_partkey = p_partkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey
),
raw AS (
    SELECT NUM_BO, VERSAO, CAST(ANO_BO AS VARCHAR) AS ANO_BO,
           CAST(ANO AS INTEGER) AS ANO, CAST(MES AS INTEGER) AS MES,
           CAST(floor((MES - 1) / 3) + 1 AS INTEGER) AS TRIMESTRE,
           CIDADE, RUBRICA, BAIRRO, DESCR_PERIODO, MARCA_OBJETO, LOGRADOURO,
           TRY_CAST(regexp_replace(LATITUDE, ',', '.') AS DOUBLE) AS LATITUDE,
           TRY_CAST(regexp_replace(LONGITUDE, ',', '.') AS DOUBLE) AS LONGITUDE,
           DATA_OCORRENCIA_BO, DATAHORA_REGISTRO_BO,
           CASE WHEN TRY_CAST(regexp_replace(LATITUDE, ',', '.') AS DOUBLE) IS NULL AND LATITUDE IS NOT NULL
                THEN '{"LATITUDE":"' || LATITUDE || '"}' END AS VALORES_NAO_LIDOS
    FROM landing
)"""
# Each row of the landing files: words for months, unreadable dates, a column
# that is not declared, older files without two columns.
FILES = """
files AS (
    SELECT NUM_BO, ANO, coalesce(ANO < 1999, false) AS old, BAIRRO, LATITUDE, LONGITUDE,
      CASE WHEN coalesce(ANO < 1999, false) THEN NULL ELSE VERSAO END AS VERSAO,
      CASE WHEN coalesce(ANO < 1999, false) THEN NULL ELSE ANO_BO END AS ANO_BO,
      CASE WHEN CAST(NUM_BO AS BIGINT) % 137 = 0 THEN NULL ELSE MES END AS MES,
      CASE WHEN CAST(NUM_BO AS BIGINT) % 137 = 0 THEN NULL ELSE TRIMESTRE END AS TRIMESTRE,
      CASE WHEN CAST(NUM_BO AS BIGINT) % 149 = 0 THEN NULL ELSE DATA_OCORRENCIA_BO END AS DATA_OCORRENCIA_BO,
      CASE WHEN coalesce(ANO < 1999, false) THEN CAST(CAST(NUM_BO AS BIGINT) % 10 AS VARCHAR)
           WHEN CAST(NUM_BO AS BIGINT) % 2 = 0 THEN 'S/N'
           ELSE lpad(CAST(CAST(NUM_BO AS BIGINT) % 10 AS VARCHAR), 3, '0') END AS OBSERVACAO,
      list_filter([CASE WHEN CAST(NUM_BO AS BIGINT) % 137 = 0 THEN '"MES":"jan"' END,
                   replace(replace(VALORES_NAO_LIDOS, '{', ''), '}', ''),
                   CASE WHEN CAST(NUM_BO AS BIGINT) % 149 = 0 THEN '"DATA_OCORRENCIA_BO":"ontem"' END],
                  lambda x: x IS NOT NULL) AS lost
    FROM raw
)"""

# The batch job's two runs: the second replaces every partition it has a row of.
TWO_RUNS = """
second_run AS (SELECT * FROM incidents WHERE ANO >= 1997 AND CAST(NUM_BO AS BIGINT) % 3 = 0),
touched AS (SELECT DISTINCT ANO, TRIMESTRE FROM second_run),
published AS (
    SELECT * FROM second_run
    UNION ALL
    SELECT * FROM incidents i
    WHERE NOT EXISTS (SELECT 1 FROM touched t WHERE t.ANO = i.ANO AND t.TRIMESTRE IS NOT DISTINCT FROM i.TRIMESTRE)
)"""
# Records written out as text: remarks over two lines, fields to spare, missing ones.
MALFORMED = """
records AS (
    SELECT NUM_BO, VERSAO, ANO, CAST(NUM_BO AS BIGINT) % 17 = 0 AS more,
      CAST(NUM_BO AS BIGINT) % 17 <> 0 AND CAST(NUM_BO AS BIGINT) % 19 = 0 AS less, MES, TRIMESTRE, BAIRRO,
      CASE WHEN CAST(NUM_BO AS BIGINT) % 11 = 0
           THEN 'linha 1' || chr(10) || 'disse "' || CAST(CAST(NUM_BO AS BIGINT) % 10 AS VARCHAR) || '", fim' ELSE 'ok' END AS remark,
      NUM_BO || ',' || VERSAO || ',' || coalesce(CAST(ANO AS VARCHAR), '') AS head
    FROM raw
),
malformed AS (
    SELECT NUM_BO, VERSAO, ANO, CASE WHEN NOT less THEN MES END AS MES, CASE WHEN NOT less THEN TRIMESTRE END AS TRIMESTRE,
      CASE WHEN NOT less THEN BAIRRO END AS BAIRRO, CASE WHEN NOT less THEN remark END AS OBSERVACAO,
      CASE WHEN less THEN CAST(json_object('REGISTRO', head) AS VARCHAR)
           WHEN more THEN CAST(json_object('REGISTRO', head || ',' || coalesce(CAST(MES AS VARCHAR), '') || ','
             || coalesce('"' || BAIRRO || '"', '') || ',"' || replace(remark, '"', '""') || '",sobra,"x, y"') AS VARCHAR) END AS VALORES_NAO_LIDOS
    FROM records
)"""

_NORMALISED = f"""array_to_string(list_transform(string_split(trim(regexp_replace(regexp_replace(
          strip_accents(upper(trim(replace(replace(BAIRRO, 'Ⅷ', 'VIII'), 'ＪＤ ＰＡＺ', 'JD PAZ')))), '[^A-Z0-9 ]', ' ', 'g'), ' +', ' ', 'g')), ' '),
          lambda t: coalesce({_ABBREV_MAP}[t], t)), ' ')"""

TRANSFORMED = f"""
incidents AS (
    SELECT raw.* EXCLUDE (BAIRRO),
      (LATITUDE IS NOT NULL AND LATITUDE < 0 AND LONGITUDE IS NOT NULL) AS HAS_COORDINATES,
      CASE WHEN contains(lower(RUBRICA), 'roubo') THEN 'Roubo'
           WHEN contains(lower(RUBRICA), 'furto') THEN 'Furto'
           WHEN contains(lower(RUBRICA), 'perda') OR contains(lower(RUBRICA), 'extravio') THEN 'Perda'
           ELSE 'Outros' END AS RUBRICA_MOD,
      BAIRRO AS BAIRRO_ORIGINAL,
      CASE WHEN BAIRRO IS NULL THEN NULL ELSE {_NORMALISED} END AS BAIRRO
    FROM raw
)"""

CITY = "CIDADE = 'S.PAULO'"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in (LANDING, TRANSFORMED, *ctes)) + "\n"


STATS_WHERE = f"{CITY} AND ANO = 2000 AND TRIMESTRE IN (1, 2, 3, 4)"
FILTERED_WHERE = f"""{CITY} AND ANO = 2000 AND TRIMESTRE IN (2, 3)
    AND BAIRRO IN ('JARDIM SAO NATION 3', 'VILA NATION 7', 'SANTA NATION 12', 'D''AVILA')
    AND RUBRICA_MOD IN ('Roubo', 'Furto', 'Outros')
    AND DESCR_PERIODO IN ('A noite', 'De madrugada', '')"""


def _stats_cte(where: str) -> str:
    return f"""stats AS (
    SELECT NUM_BO, DATA_OCORRENCIA_BO, DESCR_PERIODO, RUBRICA, RUBRICA_MOD, BAIRRO, LOGRADOURO,
           MARCA_OBJETO, HAS_COORDINATES, MES, ANO, TRIMESTRE
    FROM incidents WHERE {where}
)"""


def _pct(part: str, whole: str) -> str:
    return f"round_even(CAST({part} AS DOUBLE) / {whole} * 100, 1)"


# Year pair (U3) and common quarters (U2), as CTEs.
COMPARISON = f"""
years AS (SELECT DISTINCT ANO FROM incidents WHERE {CITY} AND ANO IS NOT NULL),
yb AS (SELECT max(ANO) AS ano_base FROM years),
yrs AS (
    SELECT ano_base,
           CASE WHEN EXISTS (SELECT 1 FROM years WHERE ANO = ano_base - 1) THEN ano_base - 1
                ELSE (SELECT max(ANO) FROM years WHERE ANO <> ano_base) END AS ano_anterior
    FROM yb
),
parts AS (SELECT DISTINCT ANO, TRIMESTRE FROM incidents WHERE {CITY}),
qs AS (
    SELECT TRIMESTRE FROM parts WHERE TRIMESTRE IS NOT NULL AND ANO = (SELECT ano_base FROM yrs)
    INTERSECT
    SELECT TRIMESTRE FROM parts WHERE TRIMESTRE IS NOT NULL AND ANO = (SELECT ano_anterior FROM yrs)
),
cmp_rows AS (
    SELECT * FROM incidents
    WHERE {CITY}
      AND ANO IN ((SELECT ano_base FROM yrs), (SELECT ano_anterior FROM yrs))
      AND TRIMESTRE IN (SELECT TRIMESTRE FROM qs)
),
monthly AS (
    SELECT ANO, MES, RUBRICA_MOD, count(*) AS total,
           count(*) FILTER (WHERE HAS_COORDINATES) AS com_coordenadas
    FROM cmp_rows GROUP BY ANO, MES, RUBRICA_MOD
),
dyc AS (
    SELECT BAIRRO,
           count(*) FILTER (WHERE ANO = (SELECT ano_base FROM yrs)) AS total_atual,
           count(*) FILTER (WHERE ANO = (SELECT ano_anterior FROM yrs)) AS total_anterior
    FROM cmp_rows WHERE BAIRRO IS NOT NULL AND BAIRRO <> ''
    GROUP BY BAIRRO
)"""

_DETAIL_REST = ", ".join(
    f"{c} ASC NULLS LAST"
    for c in ("NUM_BO", "DESCR_PERIODO", "RUBRICA_MOD", "BAIRRO", "LOGRADOURO", "MARCA_OBJETO")
)
_DETAIL_SELECT = "NUM_BO, DATA_OCORRENCIA_BO, DESCR_PERIODO, RUBRICA_MOD, BAIRRO, LOGRADOURO, MARCA_OBJETO"

_ALIASES = """
aliases AS (
    SELECT 'SANTA ' || replace(n_name, '_', ' ') AS bairro_variante,
           CASE WHEN n_nationkey % 10 <> 0 THEN 'JARDIM SAO ' || replace(n_name, '_', ' ') END AS bairro_canonico
    FROM nation WHERE n_nationkey % 2 = 0
)"""

_TILE_SCALE = 2048.0
_ON_MAP = "abs(LATITUDE) <= 85.0511 AND abs(LONGITUDE) <= 180"


def _kpi_sum(year_expr: str, col: str = "total", cat: str | None = None) -> str:
    cond = f"ANO = (SELECT {year_expr} FROM yrs)"
    if cat:
        cond += f" AND RUBRICA_MOD = '{cat}'"
    return f"CAST(coalesce(sum({col}) FILTER (WHERE {cond}), 0) AS BIGINT)"


def _geo(coords: str, total: str) -> str:
    return f"(CASE WHEN {total} > 0 THEN CAST({coords} AS DOUBLE) / {total} * 100 ELSE 0.0 END)"


def _change(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN {_pct(f'{a} - {b}', b)} END"


ORACLE_SQL: dict[str, str] = {
    # --- sources and sinks
    "landing_union": _with(FILES)
    + """SELECT NUM_BO, VERSAO, CAST(ANO_BO AS VARCHAR) AS ANO_BO, ANO, MES, TRIMESTRE, BAIRRO, LATITUDE, LONGITUDE,
       DATA_OCORRENCIA_BO, OBSERVACAO,
       CASE WHEN len(lost) > 0 THEN '{' || array_to_string(lost, ',') || '}' END AS VALORES_NAO_LIDOS
FROM files""",
    "landing_directory": _with(FILES)
    + """SELECT NUM_BO, VERSAO, CAST(ANO_BO AS VARCHAR) AS ANO_BO, ANO, MES, TRIMESTRE, BAIRRO, LATITUDE, LONGITUDE,
       DATA_OCORRENCIA_BO, OBSERVACAO,
       CASE WHEN len(lost) > 0 THEN '{' || array_to_string(lost, ',') || '}' END AS VALORES_NAO_LIDOS
FROM files""",
    "landing_malformed": _with(MALFORMED) + "SELECT * FROM malformed",
    "malformed_records": _with(MALFORMED)
    + "SELECT ANO, 'REGISTRO' AS coluna, count(*) AS linhas FROM malformed WHERE VALORES_NAO_LIDOS IS NOT NULL GROUP BY ANO",
    "harmonise_columns": _with(FILES) + "SELECT NUM_BO, VERSAO, ANO, MES, TRIMESTRE FROM files",
    "unread_values": _with(FILES)
    + """SELECT ANO, split_part(item, '"', 2) AS coluna, count(*) AS linhas
FROM (SELECT ANO, unnest(lost) AS item FROM files) GROUP BY ANO, coluna""",
    "manifest_read": _with(
        "mp AS (SELECT ANO, TRIMESTRE, count(*) AS rows FROM incidents GROUP BY ANO, TRIMESTRE)"
    )
    + """SELECT 1 AS schema_version, 'check' AS source,
       (SELECT CAST(to_json(list(DISTINCT ANO ORDER BY ANO) FILTER (WHERE ANO IS NOT NULL)) AS VARCHAR) FROM mp) AS anos_processados,
       (SELECT CAST(sum(rows) AS BIGINT) FROM mp) AS total_rows, ANO AS ano, TRIMESTRE AS trimestre, rows
FROM mp""",
    "alias_source": _with()
    + """SELECT DISTINCT BAIRRO AS bairro_variante, CASE WHEN NOT starts_with(BAIRRO, 'VILA') THEN BAIRRO || ' UNIFICADO' END AS bairro_canonico
FROM incidents WHERE BAIRRO IS NOT NULL AND BAIRRO <> ''""",
    "publish_two_runs": _with(TWO_RUNS) + "SELECT * FROM published",
    "kept_statistics": _with(TWO_RUNS)
    + """SELECT ANO, TRIMESTRE, CIDADE, count(*) AS linhas,
       count(DISTINCT coalesce(CAST(ANO_BO AS VARCHAR), '') || '/' || coalesce(NUM_BO, '')) AS bos_unicos,
       count(*) FILTER (WHERE TRY_CAST(VERSAO AS INTEGER) > 1) AS linhas_versao_maior_1,
       count(*) FILTER (WHERE HAS_COORDINATES) AS com_coordenadas,
       count(*) FILTER (WHERE BAIRRO IS NULL OR BAIRRO = '') AS bairro_vazio,
       count(*) FILTER (WHERE DESCR_PERIODO IS NULL OR DESCR_PERIODO = 'NULL') AS periodo_nulo,
       count(*) FILTER (WHERE MARCA_OBJETO IS NULL OR MARCA_OBJETO = '' OR MARCA_OBJETO = 'NULL') AS marca_vazia,
       max(TRY_CAST(DATAHORA_REGISTRO_BO AS DATE)) AS ultima
FROM published GROUP BY ANO, TRIMESTRE, CIDADE""",
    "kept_options": _with(TWO_RUNS)
    + f"""SELECT DISTINCT option, value FROM (
    SELECT 'anos' AS option, CAST(ANO AS VARCHAR) AS value FROM published WHERE {CITY}
    UNION ALL SELECT 'trimestres', CAST(TRIMESTRE AS VARCHAR) FROM published WHERE {CITY}
    UNION ALL SELECT 'bairros', BAIRRO FROM published WHERE {CITY}
    UNION ALL SELECT 'tipos_crime', RUBRICA_MOD FROM published WHERE {CITY}
    UNION ALL SELECT 'periodos', DESCR_PERIODO FROM published WHERE {CITY} AND DESCR_PERIODO <> 'NULL'
) WHERE value IS NOT NULL""",
    "kept_variants": _with(TWO_RUNS)
    + f"""SELECT BAIRRO, count(DISTINCT BAIRRO_ORIGINAL) AS variantes,
       string_agg(DISTINCT BAIRRO_ORIGINAL, ' | ' ORDER BY BAIRRO_ORIGINAL) AS exemplos,
       count(*) AS total_bos
FROM published WHERE {CITY} AND BAIRRO IS NOT NULL AND BAIRRO <> ''
GROUP BY BAIRRO HAVING count(DISTINCT BAIRRO_ORIGINAL) > 1
ORDER BY variantes DESC, total_bos DESC, BAIRRO ASC LIMIT 100""",
    "kept_manifest": _with(TWO_RUNS)
    + """SELECT 1 AS schema_version, 'second' AS source, (SELECT count(*) FROM second_run) AS total_rows,
       ANO AS ano, TRIMESTRE AS trimestre, count(*) AS rows FROM second_run GROUP BY ANO, TRIMESTRE""",
    "lake_roundtrip": _with() + "SELECT * FROM incidents",
    "schema_merge_scan": _with(FILES)
    + "SELECT NUM_BO, VERSAO, CAST(ANO_BO AS VARCHAR) AS ANO_BO, ANO, TRIMESTRE, MES, BAIRRO, OBSERVACAO FROM files",
    "manifest_partitions": _with()
    + "SELECT ANO, TRIMESTRE, count(*) AS rows FROM incidents GROUP BY ANO, TRIMESTRE",
    "manifest_summary": _with(
        "mp AS (SELECT ANO, TRIMESTRE, count(*) AS rows FROM incidents GROUP BY ANO, TRIMESTRE)"
    )
    + f"""SELECT 1 AS schema_version,
       CAST(to_json(list(DISTINCT ANO ORDER BY ANO) FILTER (WHERE ANO IS NOT NULL)) AS VARCHAR) AS anos_processados,
       count(*) AS n_partitions,
       CAST(coalesce(sum(rows), 0) AS BIGINT) AS total_rows
FROM mp""",
    # --- derivations
    "coord_parse": _with()
    + """SELECT NUM_BO,
       LATITUDE AS LATITUDE_TEXTO,
       TRY_CAST(regexp_replace(LATITUDE, ',', '.') AS DOUBLE) AS LATITUDE,
       LONGITUDE AS LONGITUDE_TEXTO,
       TRY_CAST(regexp_replace(LONGITUDE, ',', '.') AS DOUBLE) AS LONGITUDE
FROM landing""",
    "quarter_derive": _with() + "SELECT MES, TRIMESTRE, count(*) AS rows FROM raw GROUP BY MES, TRIMESTRE",
    "has_coordinates": _with()
    + "SELECT NUM_BO, VERSAO, LATITUDE, LONGITUDE, HAS_COORDINATES FROM incidents",
    "category_map": _with()
    + "SELECT RUBRICA, RUBRICA_MOD, count(*) AS rows FROM incidents GROUP BY RUBRICA, RUBRICA_MOD",
    "district_normalise": _with()
    + "SELECT BAIRRO_ORIGINAL, BAIRRO, count(*) AS rows FROM incidents GROUP BY BAIRRO_ORIGINAL, BAIRRO",
    "district_alias": _with(_ALIASES)
    + """SELECT BAIRRO_ORIGINAL, CASE WHEN bairro_variante IS NOT NULL THEN bairro_canonico ELSE BAIRRO END AS BAIRRO, count(*) AS rows
FROM incidents LEFT JOIN aliases ON BAIRRO = bairro_variante
GROUP BY ALL""",
    # --- extracts
    "map_points": _with()
    + f"""SELECT LATITUDE, LONGITUDE, RUBRICA_MOD, BAIRRO, DESCR_PERIODO, LOGRADOURO, NUM_BO,
       DATA_OCORRENCIA_BO, MARCA_OBJETO
FROM incidents WHERE {STATS_WHERE} AND HAS_COORDINATES""",
    "stats_extract": _with(_stats_cte(STATS_WHERE)) + "SELECT * FROM stats",
    "stats_extract_filtered": _with(_stats_cte(FILTERED_WHERE)) + "SELECT * FROM stats",
    "detail_table": _with(_stats_cte(STATS_WHERE))
    + f"""SELECT {_DETAIL_SELECT} FROM stats
ORDER BY DATA_OCORRENCIA_BO DESC NULLS LAST, {_DETAIL_REST} LIMIT 1000""",
    "detail_table_page": _with(_stats_cte(STATS_WHERE))
    + "SELECT "
    + ", ".join(
        f'{c} AS "{h}"' for c, h in zip(
            _DETAIL_SELECT.split(", "), ("BO", "Data", "Período", "Tipo", "Bairro", "Logradouro", "Marca"), strict=True
        )
    )
    + f"""
FROM stats ORDER BY DATA_OCORRENCIA_BO DESC NULLS FIRST, {_DETAIL_REST} LIMIT 1000""",
    "map_tiles": _with()
    + f"""SELECT CASE WHEN {_ON_MAP} THEN CAST(floor((LONGITUDE + 180.0) / 360.0 * {_TILE_SCALE}) AS BIGINT) END AS tile_x,
       CASE WHEN {_ON_MAP}
            THEN CAST(floor((1.0 - asinh(tan(radians(LATITUDE))) / pi()) / 2.0 * {_TILE_SCALE}) AS BIGINT) END AS tile_y,
       count(*) AS points,
       round_even(CAST(sum(CASE WHEN {_ON_MAP} THEN CAST(round(LATITUDE * 1000000.0) AS BIGINT) END) AS DOUBLE) / count(*), 0)
         / 1000000.0 AS mean_lat,
       round_even(CAST(sum(CASE WHEN {_ON_MAP} THEN CAST(round(LONGITUDE * 1000000.0) AS BIGINT) END) AS DOUBLE) / count(*), 0)
         / 1000000.0 AS mean_lon,
       11 AS zoom
FROM incidents WHERE {STATS_WHERE} AND HAS_COORDINATES
GROUP BY 1, 2""",
    # --- aggregates
    "coverage": _with()
    + f"""SELECT count(*) AS total,
       count(*) FILTER (WHERE HAS_COORDINATES) AS com_coordenadas,
       coalesce(CASE WHEN count(*) > 0 THEN {_pct('count(*) FILTER (WHERE HAS_COORDINATES)', 'count(*)')} END, 0.0) AS pct_geo
FROM incidents WHERE {CITY} AND ANO = 2000 AND TRIMESTRE IN (1, 2, 3, 4)""",
    "partition_counts": _with()
    + f"""SELECT ANO, TRIMESTRE, count(*) AS total,
       count(*) FILTER (WHERE HAS_COORDINATES) AS com_coordenadas
FROM incidents WHERE {CITY} GROUP BY ANO, TRIMESTRE ORDER BY ANO, TRIMESTRE""",
    "partition_coverage": _with()
    + f"""SELECT ANO, TRIMESTRE, count(*) AS total,
       count(*) FILTER (WHERE HAS_COORDINATES) AS com_coordenadas,
       {_pct('count(*) FILTER (WHERE HAS_COORDINATES)', 'count(*)')} AS pct_geo
FROM incidents WHERE {CITY} GROUP BY ANO, TRIMESTRE ORDER BY ANO, TRIMESTRE""",
    "default_years": _with(COMPARISON) + "SELECT ano_base, ano_anterior FROM yrs",
    "comparable_quarters": _with(COMPARISON) + "SELECT TRIMESTRE FROM qs",
    "comparison_base_year": _with(COMPARISON)
    + """SELECT 1995 AS ano_base, b.ano_anterior, CAST(to_json((
         SELECT list(x.TRIMESTRE ORDER BY x.TRIMESTRE) FROM parts x JOIN parts y ON x.TRIMESTRE = y.TRIMESTRE
         WHERE x.ANO = 1995 AND y.ANO = b.ano_anterior)) AS VARCHAR) AS trimestres
FROM (SELECT max(ANO) AS ano_anterior FROM years WHERE ANO <> 1995) b""",
    "monthly_comparison": _with(COMPARISON) + "SELECT * FROM monthly ORDER BY ANO, MES",
    "district_year_counts": _with(COMPARISON) + "SELECT * FROM dyc ORDER BY total_atual DESC",
    "monthly_overlay": _with(COMPARISON)
    + "SELECT ANO, MES, CAST(sum(total) AS BIGINT) AS total FROM monthly GROUP BY ANO, MES ORDER BY ANO, MES",
    "category_by_year": _with(COMPARISON)
    + """SELECT ANO, RUBRICA_MOD, CAST(sum(total) AS BIGINT) AS total FROM monthly
GROUP BY ANO, RUBRICA_MOD ORDER BY ANO, RUBRICA_MOD""",
    "year_kpis": _with(
        COMPARISON,
        f"""k AS (
    SELECT {_kpi_sum('ano_base')} AS total_atual,
           {_kpi_sum('ano_anterior')} AS total_anterior,
           {_kpi_sum('ano_base', cat='Roubo')} AS roubos_atual,
           {_kpi_sum('ano_anterior', cat='Roubo')} AS roubos_anterior,
           {_kpi_sum('ano_base', cat='Furto')} AS furtos_atual,
           {_kpi_sum('ano_anterior', cat='Furto')} AS furtos_anterior,
           {_kpi_sum('ano_base', 'com_coordenadas')} AS coords_atual,
           {_kpi_sum('ano_anterior', 'com_coordenadas')} AS coords_anterior
    FROM monthly
)""",
    )
    + f"""SELECT *,
       {_change('total_atual', 'total_anterior')} AS delta_total_pct,
       {_change('roubos_atual', 'roubos_anterior')} AS delta_roubos_pct,
       {_change('furtos_atual', 'furtos_anterior')} AS delta_furtos_pct,
       round_even({_geo('coords_atual', 'total_atual')}, 1) AS pct_geo_atual,
       round_even({_geo('coords_anterior', 'total_anterior')}, 1) AS pct_geo_anterior,
       round_even({_geo('coords_atual', 'total_atual')} - {_geo('coords_anterior', 'total_anterior')}, 1) AS delta_geo_pp
FROM k""",
    "district_variation": _with(COMPARISON)
    + f"""SELECT * FROM (
    SELECT BAIRRO, total_atual, total_anterior,
           total_atual - total_anterior AS delta,
           {_pct('total_atual - total_anterior', 'total_anterior')} AS delta_pct,
           CASE WHEN total_atual - total_anterior >= 0 THEN 'Alta' ELSE 'Queda' END AS direcao
    FROM dyc WHERE total_anterior >= 30
    ORDER BY abs(total_atual - total_anterior) DESC, BAIRRO ASC
    LIMIT 15
) ORDER BY delta, BAIRRO""",
    "district_comparison": _with(COMPARISON)
    + f"""SELECT BAIRRO, total_atual, total_anterior,
       total_atual - total_anterior AS delta,
       {_change('total_atual', 'total_anterior')} AS delta_pct
FROM dyc ORDER BY total_atual DESC, BAIRRO ASC""",
    "period_distribution": _with(_stats_cte(STATS_WHERE))
    + f"""SELECT DESCR_PERIODO, count(*) AS count,
       {_pct('count(*)', 'sum(count(*)) OVER ()')} AS share_pct
FROM stats WHERE DESCR_PERIODO IS NOT NULL AND DESCR_PERIODO <> 'NULL' AND DESCR_PERIODO <> ''
GROUP BY DESCR_PERIODO""",
    "category_distribution": _with(_stats_cte(STATS_WHERE))
    + f"""SELECT RUBRICA_MOD, count(*) AS count,
       {_pct('count(*)', 'sum(count(*)) OVER ()')} AS share_pct
FROM stats GROUP BY RUBRICA_MOD""",
    "monthly_series": _with(_stats_cte(STATS_WHERE))
    + """SELECT ANO, MES, count(*) AS count,
       CAST(ANO AS VARCHAR) || '-' || lpad(CAST(MES AS VARCHAR), 2, '0') AS MES_ANO
FROM stats GROUP BY ANO, MES""",
    "top_districts": _with(_stats_cte(STATS_WHERE))
    + f"""SELECT BAIRRO, count(*) AS count FROM stats WHERE BAIRRO IS NOT NULL AND BAIRRO <> ''
GROUP BY BAIRRO ORDER BY count DESC, BAIRRO ASC LIMIT 10""",
    "top_brands": _with(_stats_cte(STATS_WHERE))
    + f"""SELECT MARCA_OBJETO, count(*) AS count FROM stats
WHERE MARCA_OBJETO IS NOT NULL AND MARCA_OBJETO <> ''
GROUP BY MARCA_OBJETO ORDER BY count DESC, MARCA_OBJETO ASC LIMIT 10""",
    "top_one": _with(_stats_cte(STATS_WHERE))
    + """SELECT * FROM (
    SELECT 'BAIRRO' AS dimension, BAIRRO AS value, count(*) AS count FROM stats
    WHERE BAIRRO IS NOT NULL AND BAIRRO <> '' GROUP BY BAIRRO ORDER BY count DESC, value ASC LIMIT 1)
UNION ALL SELECT * FROM (
    SELECT 'DESCR_PERIODO' AS dimension, DESCR_PERIODO AS value, count(*) AS count FROM stats
    WHERE DESCR_PERIODO IS NOT NULL AND DESCR_PERIODO <> 'NULL'
    GROUP BY DESCR_PERIODO ORDER BY count DESC, value ASC LIMIT 1)""",
    "filter_options": _with()
    + f"""SELECT DISTINCT option, value FROM (
    SELECT 'anos' AS option, CAST(ANO AS VARCHAR) AS value FROM incidents WHERE {CITY}
    UNION ALL SELECT 'trimestres', CAST(TRIMESTRE AS VARCHAR) FROM incidents WHERE {CITY}
    UNION ALL SELECT 'bairros', BAIRRO FROM incidents WHERE {CITY}
    UNION ALL SELECT 'tipos_crime', RUBRICA_MOD FROM incidents WHERE {CITY}
    UNION ALL SELECT 'periodos', DESCR_PERIODO FROM incidents WHERE {CITY} AND DESCR_PERIODO <> 'NULL'
) WHERE value IS NOT NULL""",
    # --- quality and run statistics
    "quality_metrics": _with()
    + f"""SELECT ANO, TRIMESTRE, count(*) AS linhas,
       count(DISTINCT coalesce(CAST(ANO_BO AS VARCHAR), '') || '/' || coalesce(NUM_BO, '')) AS bos_unicos,
       count(*) FILTER (WHERE TRY_CAST(VERSAO AS INTEGER) > 1) AS linhas_versao_maior_1,
       count(*) FILTER (WHERE HAS_COORDINATES) AS com_coordenadas,
       count(*) FILTER (WHERE BAIRRO IS NULL OR BAIRRO = '') AS bairro_vazio,
       count(*) FILTER (WHERE DESCR_PERIODO IS NULL OR DESCR_PERIODO = 'NULL') AS periodo_nulo,
       count(*) FILTER (WHERE MARCA_OBJETO IS NULL OR MARCA_OBJETO = '' OR MARCA_OBJETO = 'NULL') AS marca_vazia
FROM incidents WHERE {CITY} GROUP BY ANO, TRIMESTRE ORDER BY ANO, TRIMESTRE""",
    "quality_report": _with()
    + f"""SELECT ANO, TRIMESTRE, count(*) AS linhas,
       count(DISTINCT coalesce(CAST(ANO_BO AS VARCHAR), '') || '/' || coalesce(NUM_BO, '')) AS bos_unicos,
       count(*) - count(DISTINCT coalesce(CAST(ANO_BO AS VARCHAR), '') || '/' || coalesce(NUM_BO, '')) AS linhas_excedentes,
       {_pct("count(*) FILTER (WHERE BAIRRO IS NULL OR BAIRRO = '')", 'count(*)')} AS pct_bairro_vazio,
       {_pct("count(*) FILTER (WHERE DESCR_PERIODO IS NULL OR DESCR_PERIODO = 'NULL')", 'count(*)')} AS pct_periodo_nulo,
       {_pct("count(*) FILTER (WHERE MARCA_OBJETO IS NULL OR MARCA_OBJETO = '' OR MARCA_OBJETO = 'NULL')", 'count(*)')} AS pct_marca_vazia
FROM incidents WHERE {CITY} GROUP BY ANO, TRIMESTRE ORDER BY ANO, TRIMESTRE""",
    "district_variants": _with()
    + f"""SELECT BAIRRO, count(DISTINCT BAIRRO_ORIGINAL) AS variantes,
       string_agg(DISTINCT BAIRRO_ORIGINAL, ' | ' ORDER BY BAIRRO_ORIGINAL) AS exemplos,
       count(*) AS total_bos
FROM incidents WHERE {CITY} AND BAIRRO IS NOT NULL AND BAIRRO <> ''
GROUP BY BAIRRO HAVING count(DISTINCT BAIRRO_ORIGINAL) > 1
ORDER BY variantes DESC, total_bos DESC, BAIRRO ASC LIMIT 100""",
    "latest_record": _with()
    + f"SELECT max(TRY_CAST(DATAHORA_REGISTRO_BO AS DATE)) AS ultima FROM incidents WHERE {CITY}",
    "transform_stats": _with()
    + f"""SELECT count(*) AS rows,
       count(*) FILTER (WHERE HAS_COORDINATES) AS rows_with_coordinates,
       CAST(count(DISTINCT BAIRRO_ORIGINAL) + max(CASE WHEN BAIRRO_ORIGINAL IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS districts_before,
       CAST(count(DISTINCT BAIRRO) + max(CASE WHEN BAIRRO IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS districts_after,
       CASE WHEN count(*) > 0 THEN {_pct('count(*) FILTER (WHERE HAS_COORDINATES)', 'count(*)')} END AS pct_with_coordinates
FROM incidents""",
    "category_counts": _with()
    + "SELECT RUBRICA_MOD, count(*) AS count FROM incidents GROUP BY RUBRICA_MOD ORDER BY count DESC, RUBRICA_MOD",
    "health_check": _with() + "SELECT count(*) AS n, count(*) > 0 AS healthy FROM incidents",
}
