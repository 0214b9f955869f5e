"""DataFrame -> DataFrame operators."""

from .aggregates import monthly_mean, monthly_totals, row_counts, station_totals, top_stations
from .binding import (
    attach_metadata,
    bind_cells,
    bind_columns_by_name,
    extra_cells,
    header_positions,
    read_file_metadata,
    read_line_metadata,
    unknown_headers,
)
from .combine import union_by_name
from .dedup import dedup_readings
from .quality import (
    Rule,
    accepted_range,
    check_accepted_range,
    check_not_null,
    check_unique,
    enforce,
    not_null,
    quality_report,
    unique,
    value_counts,
)
from .rollup import monthly_state, state_dates, state_mean
from .star import dim_date, dim_station, distinct_dates, project_fact, project_station

__all__ = [
    "Rule",
    "accepted_range",
    "attach_metadata",
    "bind_cells",
    "bind_columns_by_name",
    "check_accepted_range",
    "check_not_null",
    "check_unique",
    "dedup_readings",
    "dim_date",
    "dim_station",
    "distinct_dates",
    "enforce",
    "extra_cells",
    "header_positions",
    "monthly_mean",
    "monthly_state",
    "monthly_totals",
    "not_null",
    "project_fact",
    "project_station",
    "quality_report",
    "read_file_metadata",
    "read_line_metadata",
    "row_counts",
    "state_dates",
    "state_mean",
    "station_totals",
    "top_stations",
    "union_by_name",
    "unique",
    "unknown_headers",
    "value_counts",
]
