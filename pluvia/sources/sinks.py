"""Writers of the Silver and Gold tables.  All Parquet, all safe to run again.

Each takes an optional ``Observation`` and reports ``linhas``, the rows written, without a second scan.
It observes above the last shuffle, where a task counts once however often it is retried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..schemas import FACT, STATION_KEY


def observed(df: DataFrame, seen: Observation | None, *metrics: Column) -> DataFrame:
    """``df`` reporting its row count and ``metrics`` to ``seen`` when it is computed."""
    return df if seen is None else df.observe(seen, F.count(F.lit(1)).alias("linhas"), *metrics)


def write_silver(df: DataFrame, root: str) -> None:
    """Replace the years ``df`` holds and keep the others.

    Rows arrive spread by the deduplication's shuffle.  One year per call therefore writes one file per
    task; a frame of several years should be rebalanced on ``ano`` first.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ano")
        .parquet(root)
    )


def write_dimension(df: DataFrame, root: str, name: str, seen: Observation | None = None) -> None:
    """Replace a dimension."""
    observed(df, seen).write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")


def write_aggregate(
    df: DataFrame, root: str, name: str, keys: list[str], seen: Observation | None = None
) -> None:
    """Replace an aggregate, its rows sorted by ``keys``."""
    write_dimension(df.orderBy(*keys), root, name, seen)


def write_fact(
    fact: DataFrame,
    root: str,
    replace_all: bool = False,
    seen: Observation | None = None,
    name: str = FACT,
    by: Sequence[str] = ("ano", "mes"),
) -> None:
    """Replace the months ``fact`` holds, or with ``replace_all`` the whole table.

    The months' rows are brought together first.  Rebalancing splits a month over as many tasks as its
    bytes ask for and merges small ones; a plain repartition on the month would send each month to a
    single task.  The write sorts by month in any case; going on by station and time makes the files
    smaller and lets readers skip row groups.
    """
    balanced = fact.hint("rebalance", *map(F.col, by))
    ordered = balanced.sortWithinPartitions(*by, STATION_KEY, "datetime")
    (
        observed(ordered, seen)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .partitionBy(*by)
        .parquet(f"{root.rstrip('/')}/{name}")
    )
