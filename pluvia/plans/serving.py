"""Parameterised lookups over Gold.  No match is an empty result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import station_totals, top_stations
from ..schemas import STATION_KEY


def _monthly_lookup(
    table: DataFrame, key: str, value: str, ano: int, mes: int, measure: str, digits: int
) -> DataFrame:
    wanted = (F.col(key) == F.upper(F.lit(value))) & (F.col("ano") == ano) & (F.col("mes") == mes)
    return table.where(wanted).select(key, "ano", "mes", F.round(measure, digits).alias(measure))


def mean_temperature_by_uf(
    table: DataFrame,
    uf: str,
    ano: int,
    mes: int,
    key: str = "uf",
    measure: str = "temperatura_media_c",
) -> DataFrame:
    """Mean temperature (°C, 2 digits) of a state in a month."""
    return _monthly_lookup(table, key, uf, ano, mes, measure, 2)


def mean_rain_by_region(
    table: DataFrame,
    regiao: str,
    ano: int,
    mes: int,
    key: str = "regiao",
    measure: str = "precipitacao_media_mm",
) -> DataFrame:
    """Mean rain (mm per hour, 4 digits) of a region (N, NE, CO, SE, S) in a month."""
    return _monthly_lookup(table, key, regiao, ano, mes, measure, 4)


def stations_with_most_rain(
    fact: DataFrame,
    stations: DataFrame,
    ano: int,
    mes: int,
    limite: int = 5,
    station: str = STATION_KEY,
    attributes: tuple[str, ...] = ("estacao_nome", "uf"),
    measure: str = "precipitacao_mm",
    alias: str = "chuva_total_mm",
) -> DataFrame:
    """The ``limite`` stations with the largest rain total (mm, 1 digit) in a month."""
    month = fact.where((F.col("ano") == ano) & (F.col("mes") == mes))
    totals = station_totals(month, stations, measure, alias, station, attributes)
    top = top_stations(totals, alias, limite, station)
    return top.withColumn(alias, F.round(alias, 1))
