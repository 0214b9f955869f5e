"""Monthly state of the stations: what Gold needs of a Silver year, in a form that adds up over years.

One row per station (in each version of its attributes), landing year and month of the readings.  Everything in it merges:
last times by maximum, days by or, sums and counts by addition.  So a change of one year needs the readings of that year
and the few state rows of the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import STATE_SCHEMA, STATION_ATTRIBUTES, STATION_KEY
from .star import dim_date

#: Measures whose monthly means are kept.
MEAN_MEASURES = ("precipitacao_mm", "temperatura_c")


def monthly_state(silver: DataFrame, time: str = "datetime", year: str = "ano") -> DataFrame:
    """The state of a Silver table, in one scan and one hash aggregate; readings without a time have no month."""
    at = F.col(time)
    totals = [f(m).alias(name) for m in MEAN_MEASURES for f, name in ((F.sum, m), (F.count, f"{m}_n"))]
    month = (F.year(at) * 12 + F.month(at) - 1).alias("mes")
    return (
        silver.groupBy(STATION_KEY, *STATION_ATTRIBUTES, month, F.col(year).alias("origem"))
        .agg(
            F.max(at).alias("ultima"),
            F.bit_or(F.call_function("shiftleft", F.lit(1), F.dayofmonth(at))).alias("dias"),
            *totals,
            F.count(F.lit(1)).alias("linhas"),
        )
        .select(*STATE_SCHEMA.names)
    )


def state_dates(state: DataFrame) -> DataFrame:
    """The date dimension of the months' days."""
    months = state.groupBy("mes").agg(F.bit_or("dias").alias("dias"))
    days = F.filter(F.sequence(F.lit(1), F.lit(31)), lambda day: F.getbit("dias", day) == 1)
    year, month = F.expr("mes div 12").cast("int"), F.col("mes") % 12 + 1
    # Readings without a time give a row without a date.
    dated = months.select(year.alias("year"), month.alias("month"), F.explode_outer(days).alias("day"))
    return dim_date(dated.select(F.make_date("year", "month", "day").alias("datetime")))


def state_mean(state: DataFrame, key: str, measure: str, alias: str) -> DataFrame:
    """Mean over the readings of each ``key`` and month."""
    totals = state.groupBy(key, "mes").agg(F.sum(measure).alias("_sum"), F.sum(f"{measure}_n").alias("_count"))
    mean: Column = F.col("_sum") / F.nullif(F.col("_count"), F.lit(0))
    year, month = F.expr("mes div 12").cast("int").alias("ano"), (F.col("mes") % 12 + 1).alias("mes")
    return totals.select(key, year, month, mean.alias(alias))
