"""Run log: one JSON record per stage run."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import FAILURE, RUN_LOG_SCHEMA, SUCCESS
from ..sources.publishing import Folder
from ..sources.tables import read_or_empty


@dataclass(frozen=True)
class Span:
    """From when to when something ran."""

    begin: datetime
    end: datetime

    @property
    def seconds(self) -> float:
        return (self.end - self.begin).total_seconds()


@dataclass
class StageRun:
    """What a running stage reports; ``linhas`` goes to the log if it succeeds."""

    linhas: int = 0


def year_label(years: Iterable[int]) -> str:
    """``2023`` or ``2020-2023``."""
    ordered = sorted(set(years))
    return "-".join(str(year) for year in dict.fromkeys(ordered[:1] + ordered[-1:]))


def append_run_log(
    spark: SparkSession,
    log_dir: str,
    etapa: str,
    ano: int | str,
    status: str,
    linhas: int = 0,
    span: Span | None = None,
    erro: str | None = None,
) -> DataFrame:
    """Append one record to the log folder and return it.  Without a ``span`` only its end is known: now.

    A record is a file of its own, whole or absent, under a name no other run gives.  Any number of drivers and threads may
    append to one folder, and no Spark job is run for it.
    """
    times = (span.begin, span.end, span.seconds) if span else (None, datetime.now(timezone.utc), None)
    values = (etapa, str(ano), status, linhas, *times, erro)
    texts = [value.isoformat(timespec="microseconds") if isinstance(value, datetime) else value for value in values]
    line = json.dumps(dict(zip(RUN_LOG_SCHEMA.names, texts)), ensure_ascii=False)
    name = f"{times[1].astimezone(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex}.json"
    Folder(spark, log_dir).write(name, line + "\n")
    return spark.createDataFrame([values], RUN_LOG_SCHEMA)


@contextmanager
def run_stage(
    spark: SparkSession,
    log_dir: str | None,
    etapa: str,
    ano: int | str,
    inicio: datetime | None = None,
) -> Iterator[StageRun]:
    """Run a stage and log how it ended; an error is logged with 0 rows and goes on to the caller.

    ``inicio`` is for work that began before, together with that of other records.
    """
    inicio, run = inicio or datetime.now(timezone.utc), StageRun()

    def log(status: str, **details) -> None:
        if log_dir is not None:
            span = Span(inicio, datetime.now(timezone.utc))
            append_run_log(spark, log_dir, etapa, ano, status, span=span, **details)

    try:
        yield run
    except Exception as error:
        log(FAILURE, erro=str(error))
        raise
    log(SUCCESS, linhas=run.linhas)


def read_run_log(spark: SparkSession, log_dir: str) -> DataFrame:
    """The log's records; a log that was never written is empty."""
    return read_or_empty(
        spark, RUN_LOG_SCHEMA, lambda: spark.read.schema(RUN_LOG_SCHEMA).json(log_dir)
    )


def run_summary(log: DataFrame) -> DataFrame:
    """Per stage and outcome: number of runs, rows, last end and mean duration."""
    return log.groupBy("etapa", "status").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("linhas").alias("linhas"),
        F.max("fim").alias("fim"),
        F.avg("duracao_s").alias("duracao_media_s"),
    )
