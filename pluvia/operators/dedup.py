"""Deduplication of readings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType


def _sortable(field) -> Column:
    return F.to_json(field.name) if isinstance(field.dataType, MapType) else F.col(field.name)


def dedup_readings(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] | None = None
) -> DataFrame:
    """One row per key, NULL keys counting as equal.

    The survivor is the first by ``order``, so it does not depend on how the rows are spread: by default the
    row with the most values that are not NULL, then the least by all other columns.  Spark limits each key to one row per map task before the shuffle, which
    keeps a key holding most of the rows from flooding one task.
    """
    if order is None:
        others = [field for field in df.schema if field.name not in keys]
        missing = reduce(add, (F.col(field.name).isNull().cast("int") for field in others), F.lit(0))
        order = [missing, *(_sortable(field).asc_nulls_last() for field in others)]
    order = order or [F.lit(0)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
