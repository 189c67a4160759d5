"""Column functions: pure expressions, no Python workers."""

from portolan.functions.dates import (
    SERIAL_EPOCH,
    calendar_columns,
    date_to_serial_day,
    parse_date,
    season_of_month,
    sentinel_date,
    serial_day_to_date,
    serial_day_to_timestamp,
)
from portolan.functions.numbers import null_to, to_number, zero_as_missing
from portolan.functions.text import hemisphere_coordinate, place_key, split_pick, trimmed

__all__ = [
    "SERIAL_EPOCH",
    "calendar_columns",
    "date_to_serial_day",
    "hemisphere_coordinate",
    "null_to",
    "parse_date",
    "place_key",
    "season_of_month",
    "sentinel_date",
    "serial_day_to_date",
    "serial_day_to_timestamp",
    "split_pick",
    "to_number",
    "trimmed",
    "zero_as_missing",
]
