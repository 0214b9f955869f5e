"""Set operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all frames, columns matched by name; a column a frame lacks is NULL."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), others, first)
