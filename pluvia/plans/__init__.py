"""Whole jobs: ingest, Bronze to Silver, Silver to Gold, serving and the run log."""

from .bronze_to_silver import bronze_to_silver, parse_readings, silver_readings
from .ingest import ingest
from .runlog import append_run_log, read_run_log, run_stage, run_summary, year_label
from .serving import mean_rain_by_region, mean_temperature_by_uf, stations_with_most_rain
from .silver_to_gold import check_gold, gold_tables, silver_to_gold

__all__ = [
    "append_run_log",
    "bronze_to_silver",
    "check_gold",
    "gold_tables",
    "ingest",
    "mean_rain_by_region",
    "mean_temperature_by_uf",
    "parse_readings",
    "read_run_log",
    "run_stage",
    "run_summary",
    "silver_readings",
    "silver_to_gold",
    "stations_with_most_rain",
    "year_label",
]
