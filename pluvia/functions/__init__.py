"""Column expressions."""

from .calendar import date_parts, month_span, month_window, season, with_month_keys
from .parsing import (
    invalid_number,
    is_blank,
    parse_decimal,
    parse_measure,
    parse_utc_timestamp,
    split_cells,
    split_key_value,
    without_sentinels,
)

__all__ = [
    "date_parts",
    "invalid_number",
    "is_blank",
    "month_span",
    "month_window",
    "parse_decimal",
    "parse_measure",
    "parse_utc_timestamp",
    "season",
    "split_cells",
    "split_key_value",
    "with_month_keys",
    "without_sentinels",
]
