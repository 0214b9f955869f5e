"""Readers of the Silver and Gold tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import DIM_STATION, FACT, GOLD_SCHEMAS, SILVER_SCHEMA
from .publishing import Folder, Manifest, current, read_published


def read_or_empty(
    spark: SparkSession, schema: StructType | str, read: Callable[[], DataFrame]
) -> DataFrame:
    """``read()``, or an empty frame where its path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_years(df: DataFrame, years: Iterable[int], year: str = "ano") -> DataFrame:
    """The rows of ``years``; on a table partitioned by ``year`` only those folders are read."""
    return df.where(F.col(year).isin(list(years)))


def read_silver(spark: SparkSession, root: str, years: Iterable[int] | None = None) -> DataFrame:
    """Silver readings of ``years`` (all by default).  ``ano`` is the landing folder's year."""
    table = read_or_empty(spark, SILVER_SCHEMA, lambda: spark.read.schema(SILVER_SCHEMA).parquet(root))
    return table if years is None else read_years(table, years)


def available_years(df: DataFrame, year: str = "ano") -> DataFrame:
    """The years present, in order.  On a partition column no data column is read."""
    return df.select(year).distinct().orderBy(year)


def silver_years(spark: SparkSession, root: str) -> dict[int, str]:
    """The years Silver holds, each with a mark that changes when its files do; from folders alone, no file is opened."""
    found = {}
    for name in Folder(spark, root).names():
        key, _, year = name.partition("=")
        if key == "ano" and year.isdigit() and (mark := Folder(spark, f"{root.rstrip('/')}/{name}").fingerprint()):
            found[int(year)] = mark
    return found


def read_gold_table(spark: SparkSession, root: str, name: str, manifest: Manifest | None = None) -> DataFrame:
    """One Gold table under its fixed schema, as the newest manifest has it (or the given one)."""
    return read_published(spark, root, name, GOLD_SCHEMAS[name], manifest)


def read_gold_fact(spark: SparkSession, root: str, manifest: Manifest | None = None) -> DataFrame:
    """The fact; ``ano`` and ``mes`` come from its folders, so filters on them prune the scan."""
    return read_gold_table(spark, root, FACT, manifest)


def staging_views(spark: SparkSession, gold_root: str) -> list[str]:
    """Register the two views quality checks and ad-hoc SQL go through, both of one manifest; returns their names."""
    names, manifest = [], current(spark, gold_root)
    for table in (DIM_STATION, FACT):
        names.append(f"stg_{table}")
        read_gold_table(spark, gold_root, table, manifest).createOrReplaceTempView(names[-1])
    return names
