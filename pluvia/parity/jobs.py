"""The jobs with their writes, on the relational tables; for timing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from ..plans import bronze_to_silver, silver_to_gold
from ..session import shared_dir
from .queries import FILES, landing_years, raw_files, silver_of_files


def job_bronze_to_silver(spark: SparkSession, sf_dir: str) -> None:
    """Raw files to a new Silver table."""
    bronze_to_silver(spark, raw_files(spark, sf_dir), shared_dir(spark, "job-silver"), landing_years(spark, sf_dir), glob=FILES)


def job_silver_to_gold(spark: SparkSession, sf_dir: str) -> None:
    """Silver to a new Gold."""
    silver_to_gold(spark, silver_of_files(spark, sf_dir), shared_dir(spark, "job-gold"))


JOBS: dict[str, Callable[[SparkSession, str], None]] = {
    "job_bronze_to_silver": job_bronze_to_silver,
    "job_silver_to_gold": job_silver_to_gold,
}
