"""Silver -> Gold: star schema and monthly means."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..errors import EmptyInputError
from ..operators.quality import GOLD_RULES, enforce, quality_report
from ..operators.rollup import monthly_state, state_dates, state_mean
from ..operators.star import dim_station, project_fact
from ..schemas import (
    DIM_DATE,
    DIM_STATION,
    FACT,
    GOLD_SCHEMAS,
    RAIN_BY_REGION,
    STAGE_GOLD,
    STATE,
    STATE_SCHEMA,
    TEMPERATURE_BY_UF,
)
from ..sources.publishing import Manifest, current, discard, new_run, publish, read_published, version
from ..sources.sinks import write_aggregate, write_dimension, write_fact
from ..sources.tables import read_gold_table, read_silver, silver_years
from .runlog import run_stage, year_label

#: Tables that are written year by year.
PARTED = (STATE, FACT)


def small_tables(state: DataFrame) -> dict[str, DataFrame]:
    """The Gold tables that follow from the monthly state of the stations, not yet computed.

    Regions and states are those of the readings themselves, not of the station dimension: a station
    whose metadata changed keeps its old readings where they were.
    """
    return {
        DIM_STATION: dim_station(state, time="ultima"),
        DIM_DATE: state_dates(state),
        RAIN_BY_REGION: state_mean(state, "regiao", "precipitacao_mm", "precipitacao_media_mm"),
        TEMPERATURE_BY_UF: state_mean(state, "uf", "temperatura_c", "temperatura_media_c"),
    }


def gold_tables(silver: DataFrame) -> dict[str, DataFrame]:
    """The five Gold tables of a Silver table, not yet computed."""
    return small_tables(monthly_state(silver)) | {FACT: project_fact(silver)}


def parted_fact(silver: DataFrame) -> DataFrame:
    """The fact with ``origem``, the Silver year of each reading."""
    return project_fact(silver.withColumn("origem", F.col("ano")), extra=("origem",))


def _together(jobs: dict[str, Callable[[], int]]) -> dict[str, int]:
    """Run independent jobs at once: short ones fill the cores that the tail of a longer one leaves idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        started = {name: pool.submit(job) for name, job in jobs.items()}
    return {name: job.result() for name, job in started.items()}


def _part(name: str, run: str, year: int | str) -> str:
    return f"{name}/{version(run)}/origem={year}"


def _write_parts(spark: SparkSession, silver: DataFrame, gold_root: str, run: str) -> dict[str, int]:
    """Write state and fact of the readings; rows of each."""

    def state() -> int:
        seen = Observation(STATE)
        parts = monthly_state(silver).hint("rebalance", F.col("origem"))
        write = parts.observe(seen, F.count(F.lit(1)).alias("linhas")).write.partitionBy("origem")
        write.parquet(f"{gold_root}/{STATE}/{version(run)}")
        return seen.get["linhas"]

    def fact() -> int:
        seen = Observation(FACT)
        write_fact(parted_fact(silver), gold_root, True, seen, f"{FACT}/{version(run)}", ("origem", "ano", "mes"))
        return seen.get["linhas"]

    return _together({STATE: state, FACT: fact})


def _write_small(spark: SparkSession, state: DataFrame, gold_root: str, run: str) -> dict[str, int]:
    """Write the tables that follow from the state; rows of each."""
    tables = small_tables(state)

    def dimension(name: str) -> int:
        seen = Observation(name)
        write_dimension(tables[name], gold_root, f"{name}/{version(run)}", seen)
        return seen.get["linhas"]

    def aggregate(name: str, key: str) -> int:
        seen = Observation(name)
        write_aggregate(tables[name], gold_root, f"{name}/{version(run)}", [key, "ano", "mes"], seen)
        return seen.get["linhas"]

    return _together(
        {
            DIM_STATION: lambda: dimension(DIM_STATION),
            DIM_DATE: lambda: dimension(DIM_DATE),
            RAIN_BY_REGION: lambda: aggregate(RAIN_BY_REGION, "regiao"),
            TEMPERATURE_BY_UF: lambda: aggregate(TEMPERATURE_BY_UF, "uf"),
        }
    )


def _write_gold(
    spark: SparkSession, silver_root: str, gold_root: str, held: dict[int, str], asked: list[int] | None
) -> dict[str, int]:
    """Read the years that are asked for or have changed, keep the parts of the others, publish all at once."""
    gold_root = gold_root.rstrip("/")
    before = current(spark, gold_root) or Manifest()
    kept = {} if asked is None else {y: mark for y, mark in held.items() if before.years.get(str(y)) == mark and y not in asked}
    stale, run = sorted(set(held) - set(kept)), new_run()
    parts = {
        name: [f for f in before.tables.get(name, ()) if int(f.rpartition("=")[2]) in kept] + [_part(name, run, y) for y in stale]
        for name in PARTED
    }
    try:
        counts = _write_parts(spark, read_silver(spark, silver_root, stale), gold_root, run)
        state = read_published(spark, gold_root, STATE, STATE_SCHEMA, Manifest(tables=parts))
        counts |= _write_small(spark, state, gold_root, run)
        small = {name: [f"{name}/{version(run)}"] for name in counts if name not in PARTED}
        publish(spark, gold_root, before, parts | small, {str(year): mark for year, mark in held.items()})
    except BaseException:
        discard(spark, gold_root, [f"{name}/{version(run)}" for name in (STATE, *GOLD_SCHEMAS)])
        raise
    return {name: counts[name] for name in GOLD_SCHEMAS}


def silver_to_gold(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    years: Iterable[int] | None = None,
    log_dir: str | None = None,
) -> dict[str, int]:
    """Build Gold from all of Silver, or refresh it after a change of some ``years``.

    A refresh reads these years of Silver, and any other whose files have changed since Gold read them.  Dimensions and
    monthly means always cover all years, by the state kept of each.  Readers see the new tables all at once; if the
    job fails they keep the old ones.  Returns the rows written per table.
    """
    asked = sorted(set(years or ())) or None
    inicio, held, broken = datetime.now(timezone.utc), {}, None
    try:
        held = silver_years(spark, silver_root)
    except Exception as failure:
        broken = failure
    with run_stage(spark, log_dir, STAGE_GOLD, year_label(asked or held), inicio) as run:
        if broken:
            raise broken
        missing = sorted(set(asked or ()) - set(held))
        if missing or not held:
            raise EmptyInputError(f"Silver holds no readings of {missing or 'any year'}")
        counts = _write_gold(spark, silver_root, gold_root, held, asked)
        run.linhas = counts[FACT]
    return counts


def check_gold(spark: SparkSession, gold_root: str) -> DataFrame:
    """Quality report of the written Gold tables; raises if a rule of severity ``error`` failed."""
    manifest = current(spark, gold_root)
    reports = [
        quality_report(read_gold_table(spark, gold_root, name, manifest), rules, name)
        for name, rules in GOLD_RULES.items()
    ]
    return enforce(reduce(DataFrame.unionByName, reports))
