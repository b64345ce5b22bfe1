"""Data model, column roles and report settings.

The lake holds one row per incident report line. The schema is declared
here (not inferred) because yearly landing files drift: every known column is
cast to the type below when the raw layer is written, so later reads with
``mergeSchema`` never see two types for one column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- column names -----------------------------------------------------------
NUM_BO = "NUM_BO"
ANO_BO = "ANO_BO"
VERSAO = "VERSAO"
ANO = "ANO"
MES = "MES"
TRIMESTRE = "TRIMESTRE"
CIDADE = "CIDADE"
RUBRICA = "RUBRICA"
RUBRICA_MOD = "RUBRICA_MOD"
BAIRRO = "BAIRRO"
BAIRRO_ORIGINAL = "BAIRRO_ORIGINAL"
LATITUDE = "LATITUDE"
LONGITUDE = "LONGITUDE"
HAS_COORDINATES = "HAS_COORDINATES"
DESCR_PERIODO = "DESCR_PERIODO"
LOGRADOURO = "LOGRADOURO"
MARCA_OBJETO = "MARCA_OBJETO"
DATA_OCORRENCIA_BO = "DATA_OCORRENCIA_BO"
DATAHORA_REGISTRO_BO = "DATAHORA_REGISTRO_BO"

# Newer landing files name year and month differently.
ANO_REGISTRO_BO = "ANO_REGISTRO_BO"
MES_REGISTRO_BO = "MES_REGISTRO_BO"

PARTITION_COLUMNS = (ANO, TRIMESTRE)

# Texts of typed columns that could not be read, as a JSON object by column
# (null where all could); so no landing value is lost.
UNREAD = "VALORES_NAO_LIDOS"
# Its entry for the whole text of a record with more or fewer fields than its header.
UNREAD_RECORD = "REGISTRO"

# Types forced at raw write; a column that is not listed is a string in every
# layer, so a year that holds only digits never clashes with the next one.
RAW_TYPES: dict[str, T.DataType] = {
    NUM_BO: T.StringType(),
    ANO_BO: T.StringType(),
    VERSAO: T.StringType(),
    ANO: T.IntegerType(),
    MES: T.IntegerType(),
    TRIMESTRE: T.IntegerType(),
    CIDADE: T.StringType(),
    RUBRICA: T.StringType(),
    BAIRRO: T.StringType(),
    LATITUDE: T.DoubleType(),
    LONGITUDE: T.DoubleType(),
    DESCR_PERIODO: T.StringType(),
    LOGRADOURO: T.StringType(),
    MARCA_OBJETO: T.StringType(),
    DATA_OCORRENCIA_BO: T.TimestampNTZType(),
    DATAHORA_REGISTRO_BO: T.StringType(),
    UNREAD: T.StringType(),
}

# Columns the transformed layer adds.
TRANSFORMED_TYPES: dict[str, T.DataType] = {
    HAS_COORDINATES: T.BooleanType(),
    RUBRICA_MOD: T.StringType(),
    BAIRRO_ORIGINAL: T.StringType(),
}


def layer_schema(transformed: bool = True) -> T.StructType:
    """Declared schema of a lake layer as stored (partition keys last, in the
    lower-case names of the directory keys)."""
    types = dict(RAW_TYPES)
    if transformed:
        types.update(TRANSFORMED_TYPES)
    fields = [T.StructField(n, t, True) for n, t in types.items() if n not in (ANO, TRIMESTRE)]
    fields += [T.StructField("ano", T.IntegerType(), True), T.StructField("trimestre", T.IntegerType(), True)]
    return T.StructType(fields)


ALIAS_SCHEMA = T.StructType(
    [
        T.StructField("bairro_variante", T.StringType(), True),
        T.StructField("bairro_canonico", T.StringType(), True),
    ]
)

# Optional column of an alias table: the number of the line.
ALIAS_LINE = "linha"

# --- fixed values (must equal the reference's) ------------------------------
# City kept by every dashboard query.
CITY = "S.PAULO"
# Placeholder text the source uses for a missing value.
NULL_TEXT = "NULL"
# Category labels.
CATEGORIES = ("Roubo", "Furto", "Perda", "Outros")
# Period-of-day labels, in display order.
PERIODS = ("De madrugada", "Pela manhã", "A tarde", "A noite", "Em hora incerta")
# Direction labels of a year-over-year change.
UP, DOWN = "Alta", "Queda"
# Minimum previous-year volume for a district to enter the variation chart.
MIN_PREVIOUS_COUNT = 30
# Report sizes.
TOP_DISTRICTS = 10
TOP_BRANDS = 10
TOP_VARIATION = 15
TOP_VARIANTS = 100
DETAIL_ROWS = 1000
# Manifest format version.
MANIFEST_SCHEMA_VERSION = 1


@dataclass(frozen=True)
class Scope:
    """Year/quarter scope of a dashboard query (F1 + F2 + F4)."""

    year: int
    quarters: tuple[int, ...]
    city: str = CITY
    districts: tuple[str, ...] | None = None
    categories: tuple[str, ...] | None = None
    periods: tuple[str, ...] | None = None

    def __post_init__(self) -> None:
        if not self.quarters:
            raise ValueError("at least one quarter must be selected")
