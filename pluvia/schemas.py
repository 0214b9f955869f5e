"""Fixed table schemas and the source's vocabulary."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# They must equal what the station files and their consumers use.
# ---------------------------------------------------------------------------------------------

# Metadata key above the header -> Silver column.
METADATA_KEYS = {
    "REGIAO": "regiao",
    "UF": "uf",
    "ESTACAO": "estacao_nome",
    "CODIGO (WMO)": "estacao_codigo",
    "LATITUDE": "latitude",
    "LONGITUDE": "longitude",
    "ALTITUDE": "altitude",
}
NUMERIC_METADATA = ("latitude", "longitude", "altitude")

# Lines of metadata above the header row.
METADATA_LINES = 8

# Header of the two key columns.
DATE_HEADER = "Data"
HOUR_HEADER = "Hora UTC"

# Header of a measure -> Silver column.
MEASURE_HEADERS = {
    "PRECIPITAÇÃO TOTAL, HORÁRIO (mm)": "precipitacao_mm",
    "PRESSAO ATMOSFERICA AO NIVEL DA ESTACAO, HORARIA (mB)": "pressao_mb",
    "PRESSÃO ATMOSFERICA MAX.NA HORA ANT. (AUT) (mB)": "pressao_max_hora_ant_mb",
    "PRESSÃO ATMOSFERICA MIN. NA HORA ANT. (AUT) (mB)": "pressao_min_hora_ant_mb",
    "RADIACAO GLOBAL (Kj/m²)": "radiacao_kj_m2",
    "TEMPERATURA DO AR - BULBO SECO, HORARIA (°C)": "temperatura_c",
    "TEMPERATURA DO PONTO DE ORVALHO (°C)": "temperatura_orvalho_c",
    "TEMPERATURA MÁXIMA NA HORA ANT. (AUT) (°C)": "temperatura_max_hora_ant_c",
    "TEMPERATURA MÍNIMA NA HORA ANT. (AUT) (°C)": "temperatura_min_hora_ant_c",
    "TEMPERATURA ORVALHO MAX. NA HORA ANT. (AUT) (°C)": "temperatura_orvalho_max_hora_ant_c",
    "TEMPERATURA ORVALHO MIN. NA HORA ANT. (AUT) (°C)": "temperatura_orvalho_min_hora_ant_c",
    "UMIDADE REL. MAX. NA HORA ANT. (AUT) (%)": "umidade_max_hora_ant_pct",
    "UMIDADE REL. MIN. NA HORA ANT. (AUT) (%)": "umidade_min_hora_ant_pct",
    "UMIDADE RELATIVA DO AR, HORARIA (%)": "umidade_pct",
    "VENTO, DIREÇÃO HORARIA (gr) (° (gr))": "vento_direcao_gr",
    "VENTO, RAJADA MAXIMA (m/s)": "vento_rajada_maxima_ms",
    "VENTO, VELOCIDADE HORARIA (m/s)": "vento_velocidade_ms",
}

# Texts that mean "missing": in metadata (any case), and in measures (as pandas documents them).
METADATA_NULLS = ("", "NULL")
MEASURE_NULLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Season of a month in the southern hemisphere; any other month (or none) is the default.
SOUTHERN_SEASONS = {"verao": (12, 1, 2), "outono": (3, 4, 5), "inverno": (6, 7, 8)}
SOUTHERN_DEFAULT_SEASON = "primavera"

# Measures the fact table keeps, in its column order.
FACT_MEASURES = (
    "temperatura_c",
    "temperatura_orvalho_c",
    "precipitacao_mm",
    "pressao_mb",
    "umidade_pct",
    "vento_velocidade_ms",
    "vento_direcao_gr",
    "radiacao_kj_m2",
)

# Attributes of the station dimension, after its key.
STATION_KEY = "estacao_codigo"
STATION_ATTRIBUTES = ("estacao_nome", "uf", "regiao", "latitude", "longitude", "altitude")

# Gold table names.
DIM_STATION = "dim_estacao"
DIM_DATE = "dim_data"
FACT = "fato_leitura_climatica"
RAIN_BY_REGION = "chuva_mensal_por_regiao"
TEMPERATURE_BY_UF = "temperatura_mensal_por_uf"

# What is known of each station, Silver year and month, from which all Gold tables but the fact are made.
STATE = "estado_mensal"

# Stage names and outcomes in the run log.
STAGE_INGEST = "ingestao_bronze"
STAGE_SILVER = "transformacao_silver"
STAGE_GOLD = "modelagem_gold"
SUCCESS = "sucesso"
FAILURE = "falha"

# ---------------------------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------------------------

MEASURES = tuple(MEASURE_HEADERS.values())
METADATA_COLUMNS = tuple(METADATA_KEYS.values())


def _fields(kind: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(name, kind) for name in names]


_STR, _INT, _DBL = T.StringType(), T.IntegerType(), T.DoubleType()
_METADATA_FIELDS = [
    T.StructField(name, _DBL if name in NUMERIC_METADATA else _STR) for name in METADATA_COLUMNS
]

# ``extras`` keeps the cells of headers outside MEASURE_HEADERS; ``ano`` is the landing folder's year.
SILVER_SCHEMA = T.StructType(
    _fields(T.TimestampNTZType(), "datetime")
    + _fields(_DBL, *MEASURES)
    + _METADATA_FIELDS
    + _fields(T.MapType(_STR, _STR), "extras")
    + _fields(_INT, "ano")
)

GOLD_SCHEMAS = {
    DIM_STATION: T.StructType(
        _fields(_STR, STATION_KEY, "estacao_nome", "uf", "regiao")
        + _fields(_DBL, "latitude", "longitude", "altitude")
    ),
    DIM_DATE: T.StructType(
        _fields(T.DateType(), "data")
        + _fields(_INT, "ano", "mes", "dia", "trimestre")
        + _fields(_STR, "estacao_do_ano")
    ),
    FACT: T.StructType(
        _fields(T.DateType(), "data")
        + _fields(T.TimestampNTZType(), "datetime")
        + _fields(_STR, STATION_KEY)
        + _fields(_DBL, *FACT_MEASURES)
        + _fields(_INT, "ano", "mes")
    ),
    RAIN_BY_REGION: T.StructType(
        _fields(_STR, "regiao") + _fields(_INT, "ano", "mes") + _fields(_DBL, "precipitacao_media_mm")
    ),
    TEMPERATURE_BY_UF: T.StructType(
        _fields(_STR, "uf") + _fields(_INT, "ano", "mes") + _fields(_DBL, "temperatura_media_c")
    ),
}

# ``mes`` counts months from year 0, ``dias`` has a bit per day that occurs.
STATE_SCHEMA = T.StructType(
    _fields(_STR, STATION_KEY, "estacao_nome", "uf", "regiao")
    + _fields(_DBL, "latitude", "longitude", "altitude")
    + _fields(_INT, "mes")
    + _fields(T.TimestampNTZType(), "ultima")
    + _fields(_INT, "dias")
    + _fields(_DBL, "precipitacao_mm", "temperatura_c")
    + _fields(T.LongType(), "precipitacao_mm_n", "temperatura_c_n", "linhas")
    + _fields(_INT, "origem")
)

RUN_LOG_SCHEMA = T.StructType(
    _fields(_STR, "etapa", "ano", "status")
    + _fields(T.LongType(), "linhas")
    + _fields(T.TimestampType(), "inicio", "fim")
    + _fields(_DBL, "duracao_s")
    + _fields(_STR, "erro")
)
