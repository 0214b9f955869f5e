"""Landing of the yearly archives."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..errors import EmptyInputError, LandingError
from ..schemas import STAGE_INGEST
from ..sources import land_archives, landed_files, landed_years, mark_landed, pending_years
from .runlog import run_stage


def ingest(
    spark: SparkSession,
    archive_root: str,
    raw_root: str,
    years: Iterable[int],
    log_dir: str | None = None,
) -> dict[int, int]:
    """Extract the archives of the years that have not landed completely; station files per year.

    One job lands all of them.  A year counts as landed once every member of its archive is in place, which a
    mark says; what is wrong with one archive fails and logs its own year only.
    """
    inicio, years = datetime.now(timezone.utc), sorted(set(years))
    pending, outcomes, counts, broken = set(years), {}, {}, None
    try:
        requested = spark.createDataFrame([(year,) for year in years], "ano int")
        pending = {row.ano for row in pending_years(requested, landed_years(spark, raw_root)).collect()}
        if pending:
            landed = land_archives(spark, archive_root, raw_root, pending)
            totals = landed.groupBy("ano").agg(F.count("member").alias("members"), F.min("error").alias("error"))
            outcomes = {row.ano: row for row in totals.collect()}
        counts = {row.ano: row.arquivos for row in landed_files(spark, raw_root, years).collect()}
    except Exception as failure:
        broken = failure
    failures = []
    for year in years:
        try:
            with run_stage(spark, log_dir, STAGE_INGEST, year, inicio) as run:
                if broken:
                    raise broken
                if year in pending:
                    outcome = outcomes.get(year)
                    if outcome is None:
                        raise EmptyInputError(f"no archive of {year}")
                    if outcome.error:
                        raise LandingError(outcome.error)
                if year not in counts:
                    raise EmptyInputError(f"no station files for {year}")
                if year in pending:
                    mark_landed(spark, raw_root, year, outcome.members)
                run.linhas = counts[year]
        except Exception as failure:
            failures.append(failure)
    if failures:
        raise failures[0]
    return counts
