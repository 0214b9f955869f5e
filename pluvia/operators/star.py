"""Dimensions and fact of the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import date_parts, season
from ..schemas import FACT_MEASURES, STATION_ATTRIBUTES, STATION_KEY


def project_station(
    df: DataFrame, key: str = STATION_KEY, attributes: Sequence[str] = STATION_ATTRIBUTES
) -> DataFrame:
    """The station columns of a reading."""
    return df.select(key, *attributes)


def dim_station(
    df: DataFrame,
    key: str = STATION_KEY,
    attributes: Sequence[str] = STATION_ATTRIBUTES,
    time: str = "datetime",
) -> DataFrame:
    """One row per station, with the attributes of its latest reading (ties: the greatest).

    First the last time each version of a station was seen: a hash aggregate whose only buffer is a
    number, leaving a handful of rows per station.  Only those few go through the costlier max_by.
    """
    versions = df.groupBy(key, *attributes).agg(F.max(time).alias("_seen"))
    record = F.struct(*attributes)
    latest = versions.groupBy(key).agg(
        F.max_by(record, F.struct(F.col("_seen"), record)).alias("_latest")
    )
    return project_station(latest.select(key, "_latest.*"), key, attributes)


def distinct_dates(df: DataFrame, time: str = "datetime", date: str = "data") -> DataFrame:
    """The dates that occur (NULL included, where a reading has no time); gaps are not filled."""
    return df.select(F.to_date(time).alias(date)).distinct()


def dim_date(df: DataFrame, time: str = "datetime") -> DataFrame:
    """The observed dates with their parts and season."""
    dated = distinct_dates(df, time).withColumns(date_parts(F.col("data")))
    return dated.withColumn("estacao_do_ano", season(F.col("mes")))


def project_fact(
    df: DataFrame,
    time: str = "datetime",
    key: str = STATION_KEY,
    measures: Sequence[str] = FACT_MEASURES,
    extra: Sequence[str] = (),
) -> DataFrame:
    """The fact's columns: date, time, station, measures and the month it is partitioned by; then any ``extra`` ones."""
    parts = date_parts(F.col(time))
    return df.select(
        F.to_date(time).alias("data"),
        time,
        key,
        *measures,
        parts["ano"].alias("ano"),
        parts["mes"].alias("mes"),
        *extra,
    )
