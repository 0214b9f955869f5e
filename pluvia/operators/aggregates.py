"""Monthly means, totals, top-k and row counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import with_month_keys
from ..schemas import STATION_KEY


def _addend(measure: str, scale: int | None) -> Column:
    value = F.col(measure)
    return value if scale is None else value.cast(f"decimal(18,{scale})")


def monthly_totals(
    df: DataFrame, keys: Sequence[str], measure: str, time: str = "datetime", scale: int | None = None
) -> DataFrame:
    """Sum and count of the readings of each key and month."""
    return (
        with_month_keys(df.select(*keys, time, measure), time)
        .groupBy(*keys, "ano", "mes")
        .agg(F.sum(_addend(measure, scale)).alias("_sum"), F.count(measure).alias("_count"))
    )


def monthly_mean(
    df: DataFrame,
    key: str,
    measure: str,
    alias: str,
    time: str = "datetime",
    scale: int | None = None,
    stations: DataFrame | None = None,
    station: str = STATION_KEY,
) -> DataFrame:
    """Mean over the readings (not over stations) of each ``key`` and month; NULL measures are skipped.

    ``scale`` adds decimals of that many digits instead of doubles, for a mean that does not depend on
    the order of the rows.  With ``stations`` the key is looked up there by ``station``: readings are
    first reduced to one row per station and month, and only those are joined.
    """
    if stations is None:
        totals = monthly_totals(df, [key], measure, time, scale)
    else:
        per_station = monthly_totals(df, [station], measure, time, scale)
        totals = (
            per_station.join(stations.select(station, key), station)
            .groupBy(key, "ano", "mes")
            .agg(F.sum("_sum").alias("_sum"), F.sum("_count").alias("_count"))
        )
    mean = F.col("_sum").cast("double") / F.nullif(F.col("_count"), F.lit(0))
    return totals.select(key, "ano", "mes", mean.alias(alias))


def station_totals(
    fact: DataFrame,
    stations: DataFrame,
    measure: str,
    alias: str,
    station: str = STATION_KEY,
    attributes: Sequence[str] = ("estacao_nome", "uf"),
) -> DataFrame:
    """Total of ``measure`` per station that the dimension knows.

    The fact is summed per station before the join, so the join sees one row per station; summing again
    after it keeps the result right even if a station had several rows in the dimension.
    """
    totals = fact.groupBy(station).agg(F.sum(measure).alias("_total"))
    known = totals.join(stations.select(station, *attributes), station)
    return known.groupBy(station, *attributes).agg(F.sum("_total").alias(alias))


def top_stations(totals: DataFrame, by: str, limit: int, station: str = STATION_KEY) -> DataFrame:
    """The ``limit`` largest totals; equal totals go by station."""
    return totals.orderBy(F.desc(by), station).limit(limit)


def row_counts(tables: Mapping[str, DataFrame], table: str = "tabela", rows: str = "linhas") -> DataFrame:
    """One row per named table with its row count."""
    counts = [
        df.agg(F.count(F.lit(1)).alias(rows)).select(F.lit(name).alias(table), rows)
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
