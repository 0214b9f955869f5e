"""Bronze -> Silver: typed, deduplicated readings."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import add

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..errors import EmptyInputError
from ..functions.parsing import (
    invalid_number,
    parse_decimal,
    parse_utc_timestamp,
    split_cells,
    without_sentinels,
)
from ..operators.binding import bind_cells, extra_cells
from ..operators.dedup import dedup_readings
from ..schemas import MEASURES, METADATA_COLUMNS, SILVER_SCHEMA, STAGE_SILVER, STATION_KEY
from ..sources.sinks import write_silver
from ..sources.station_files import FILE_GLOB, WHOLE_FILE_LIMIT, scan_station_files
from .runlog import run_stage

READING_KEYS = ("ano", STATION_KEY, "datetime")
COUNTERS = ("invalid_numbers", "invalid_times")
# Jobs submitted together.
YEARS_AT_ONCE = 4


def parse_readings(
    rows: DataFrame, strict: bool = True, sentinels: Iterable[float] = ()
) -> DataFrame:
    """Scanned rows -> Silver columns, plus ``file``, ``number`` and how many texts of the row did not parse.

    Every measure is a double whatever its file holds, and a missing one is NULL.
    """
    texts = {name: f"_{name}" for name in MEASURES}
    split = rows.select(
        "file", "ano", *METADATA_COLUMNS, "positions", "unknown", "number",
        split_cells(F.col("line")).alias("cells"),
    )
    bound = bind_cells(split, ["_date", "_hour", *texts.values()])
    date, hour, codes = F.col("_date"), F.col("_hour"), list(sentinels)
    timeless = F.coalesce((F.get("positions", F.lit(0)) < 0) | (F.get("positions", F.lit(1)) < 0), F.lit(True))
    time = parse_utc_timestamp(date, hour, strict)
    if strict:
        # Not the same as empty cells: without the columns every row would lose its time unnoticed.
        failure = F.raise_error(F.concat(F.lit("no date or hour column in "), F.col("file")))
        time = F.when(timeless, failure.cast("timestamp_ntz")).otherwise(time)
    # Parsing shares a projection with the map on purpose.  A map built by a lambda ends the stage's
    # single generated method; without that it grows past what the JVM compiles and runs twice as long.
    parsed = bound.withColumns(
        {"datetime": time}
        | {name: parse_decimal(F.col(text)) for name, text in texts.items()}
        | {"extras": extra_cells(F.col("unknown"), F.col("cells"))}
    )
    invalid = [invalid_number(F.col(text), F.col(name)).cast("int") for name, text in texts.items()]
    unreadable = timeless | (date.isNotNull() & hour.isNotNull() & F.col("datetime").isNull())
    return parsed.select(
        "datetime",
        *[without_sentinels(F.col(name), codes).alias(name) for name in MEASURES],
        *METADATA_COLUMNS,
        "extras",
        "ano",
        "file",
        "number",
        reduce(add, invalid).alias("invalid_numbers"),
        unreadable.cast("int").alias("invalid_times"),
    )


def deduplicated(readings: DataFrame) -> DataFrame:
    """One reading per landing year, station and time.

    A row whose time does not parse is no duplicate of any other: it stays.  ``file`` and ``number`` only
    help to choose and to tell such rows apart.
    """
    unread = F.when(F.col("invalid_times") > 0, F.struct("file", "number"))
    told_apart = readings.withColumn("_unread", unread).drop("number")
    return dedup_readings(told_apart, (*READING_KEYS, "_unread")).drop("file", "_unread")


def with_error_rows(readings: DataFrame) -> DataFrame:
    """The readings, and beside each one with unreadable texts a row that only says how many.

    Such a row (``_errors``) goes through the deduplication's shuffle without meeting any other, so that the texts of a
    reading that loses against a duplicate can be counted behind the shuffle, where a task that runs again counts once.
    """
    any_errors = reduce(add, map(F.col, COUNTERS)) > 0
    kinds = F.when(any_errors, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    rows = readings.withColumn("_errors", F.explode(kinds))
    told, kept = F.col("_errors"), ("ano", "file", "number", "_errors", *COUNTERS)
    return rows.select(
        *[F.col(c) if c in kept else F.when(~told, F.col(c)).alias(c) for c in readings.columns],
        "_errors",
    )


def deduplicated_with_errors(readings: DataFrame) -> DataFrame:
    """``deduplicated``, with the rows of ``with_error_rows``, in one shuffle."""
    rows = with_error_rows(readings)
    apart = F.when(F.col("_errors") | (F.col("invalid_times") > 0), F.struct("file", "number"))
    keys = (*READING_KEYS, "_unread", "_errors")
    return dedup_readings(rows.withColumn("_unread", apart).drop("number"), keys).drop("file", "_unread")


def silver_readings(
    spark: SparkSession,
    raw_root: str,
    years: Iterable[int],
    strict: bool = True,
    sentinels: Iterable[float] = (),
    whole_file_limit: int = WHOLE_FILE_LIMIT,
    glob: str = FILE_GLOB,
) -> DataFrame:
    """The deduplicated readings of the years, with the two counters of unreadable texts."""
    rows = scan_station_files(spark, raw_root, years, whole_file_limit, glob, strict)
    return deduplicated(parse_readings(rows, strict, sentinels))


def bronze_to_silver(
    spark: SparkSession,
    raw_root: str,
    silver_root: str,
    years: Iterable[int],
    log_dir: str | None = None,
    strict: bool = True,
    sentinels: Iterable[float] = (),
    whole_file_limit: int = WHOLE_FILE_LIMIT,
    glob: str = FILE_GLOB,
) -> dict[int, dict[str, int]]:
    """Replace the Silver years; returns each year's row count and the unreadable texts of all its rows.

    One job per year: its one shuffle serves both the deduplication and the files of that year's folder.  Some
    years are submitted together, so that one fills the cores that another's tail leaves idle.  Each is logged by
    itself; one that fails leaves the others written, and its error is raised when all have ended.
    """
    def build(year: int) -> dict[str, int]:
        with run_stage(spark, log_dir, STAGE_SILVER, year) as run:
            try:
                rows = scan_station_files(spark, raw_root, [year], whole_file_limit, glob, strict)
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
                raise EmptyInputError(f"no folder {raw_root}/{year}") from error
            seen = Observation(f"{STAGE_SILVER} {year}")
            told = F.col("_errors")
            rows = deduplicated_with_errors(parse_readings(rows, strict, sentinels)).observe(
                seen,
                F.count_if(~told).alias("linhas"),
                *(F.coalesce(F.sum(F.when(told, F.col(name))), F.lit(0)).alias(name) for name in COUNTERS),
            )
            write_silver(rows.where(~told).select(*SILVER_SCHEMA.names), silver_root)
            counts = dict(seen.get)
            if not counts["linhas"]:
                raise EmptyInputError(f"no readings in {raw_root}/{year}")
            run.linhas = counts["linhas"]
        return counts

    asked = list(dict.fromkeys(years))
    with ThreadPoolExecutor(YEARS_AT_ONCE) as pool:
        jobs = {year: pool.submit(build, year) for year in asked}
    return {year: job.result() for year, job in jobs.items()}
