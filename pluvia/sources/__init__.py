"""Scans and sinks."""

from .archives import archive_members, land_archives
from .publishing import Manifest, current, publish
from .sinks import observed, write_aggregate, write_dimension, write_fact, write_silver
from .station_files import (
    file_lines,
    landed_files,
    landed_years,
    mark_landed,
    pending_years,
    rows_from_files,
    rows_from_lines,
    scan_large_files,
    scan_small_files,
    scan_station_files,
)
from .tables import (
    available_years,
    read_gold_fact,
    read_gold_table,
    read_or_empty,
    read_silver,
    read_years,
    silver_years,
    staging_views,
)

__all__ = [
    "Manifest",
    "archive_members",
    "available_years",
    "current",
    "file_lines",
    "land_archives",
    "landed_files",
    "landed_years",
    "mark_landed",
    "observed",
    "pending_years",
    "publish",
    "read_gold_fact",
    "read_gold_table",
    "read_or_empty",
    "read_silver",
    "read_years",
    "rows_from_files",
    "rows_from_lines",
    "scan_large_files",
    "scan_small_files",
    "scan_station_files",
    "silver_years",
    "staging_views",
    "write_aggregate",
    "write_dimension",
    "write_fact",
    "write_silver",
]
