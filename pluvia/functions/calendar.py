"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import SOUTHERN_DEFAULT_SEASON, SOUTHERN_SEASONS


def season(
    month: Column,
    seasons: dict[str, tuple[int, ...]] = SOUTHERN_SEASONS,
    default: str = SOUTHERN_DEFAULT_SEASON,
) -> Column:
    """The season holding ``month``; a month in none of them, NULL included, gets ``default``."""
    branches = [F.when(month.isin(*months), F.lit(name)) for name, months in seasons.items()]
    return F.coalesce(*branches, F.lit(default))


def date_parts(date: Column) -> dict[str, Column]:
    """Year, month, day and quarter of a date under their Gold names."""
    return {
        "ano": F.year(date),
        "mes": F.month(date),
        "dia": F.dayofmonth(date),
        "trimestre": F.quarter(date),
    }


def with_month_keys(df: DataFrame, time: str = "datetime") -> DataFrame:
    """Add ``ano`` and ``mes`` of ``time``, replacing columns of that name."""
    parts = date_parts(F.col(time))
    return df.withColumns({"ano": parts["ano"], "mes": parts["mes"]})


def month_span(time: Column, first: int, last: int) -> Column:
    """``time`` lies within months ``first`` to ``last``, numbered ``ano * 12 + mes - 1``.

    A half-open range: unlike a test on year() and month() it reaches the scan.
    """
    # Bounds go through text: a Python datetime would become a literal of the session zone.
    low, high = (
        F.lit(f"{number // 12:04d}-{number % 12 + 1:02d}-01 00:00:00").cast("timestamp_ntz")
        for number in (first, last + 1)
    )
    return (time >= low) & (time < high)


def month_window(time: Column, ano: int, mes: int) -> Column:
    """``time`` lies in the month."""
    number = ano * 12 + mes - 1
    return month_span(time, number, number)
