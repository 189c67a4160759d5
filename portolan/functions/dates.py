"""Date expressions: serial days, format parsing, calendar attributes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from portolan.functions._columns import ColumnLike, as_column

# Day zero of the serial day numbers used by statistical packages.
SERIAL_EPOCH = dt.date(1960, 1, 1)

# Month names as the JVM formats them with pattern MMMM (English).
MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)


def serial_day_to_date(serial: ColumnLike) -> Column:
    """Days since 1960-01-01 to a date; null, zero, negative and NaN serials give null.

    A fraction is time of day and is dropped.
    """
    c = as_column(serial)
    return F.when(c > 0, F.date_add(F.lit(SERIAL_EPOCH), c.try_cast("int")))


def serial_day_to_timestamp(serial: ColumnLike) -> Column:
    """As :func:`serial_day_to_date`, keeping the fraction as time of day.

    The result has no time zone, so it does not shift with the session's zone.
    """
    c = as_column(serial)
    days = c.try_cast("int")
    seconds = ((c - days) * 86400).cast("decimal(18,6)")
    midnight = F.lit(SERIAL_EPOCH).cast("timestamp_ntz")
    return F.when(c > 0, midnight + F.make_dt_interval(days, F.lit(0), F.lit(0), seconds))


def date_to_serial_day(date: ColumnLike) -> Column:
    return F.datediff(as_column(date), F.lit(SERIAL_EPOCH)).cast("double")


def serial_of(date: dt.date) -> int:
    return (date - SERIAL_EPOCH).days


def parse_date(text: ColumnLike, fmt: str = "yyyy-MM-dd") -> Column:
    """Text to date; text that does not fit the pattern gives null, not an error."""
    return F.try_to_date(as_column(text), fmt)


def sentinel_date(
    text: ColumnLike, fmt: str = "yyyy-MM-dd", sentinel: str = "D/S"
) -> tuple[Column, Column]:
    """``(date, is_sentinel)`` for text holding either a date or one agreed marker.

    A column has one type, so the marker comes back as a flag beside a null date.
    Null text gives a null date and a false flag.
    """
    c = as_column(text)
    is_sentinel = F.coalesce(c == sentinel, F.lit(False))
    return F.when(~is_sentinel, parse_date(c, fmt)), is_sentinel


def calendar_columns(date: ColumnLike) -> dict[str, Column]:
    """Calendar attributes of a date, keyed by output name.

    ``week`` is the ISO week; ``day_of_week`` runs from 1 (Sunday) to 7 (Saturday).
    """
    c = as_column(date)
    return {
        "day": F.dayofmonth(c),
        "week": F.weekofyear(c),
        "month": F.month(c),
        "month_name": F.date_format(c, "MMMM"),
        "year": F.year(c),
        "day_of_week": F.dayofweek(c),
        "day_of_week_name": F.date_format(c, "E"),
    }


def season_of_month(month: ColumnLike) -> Column:
    """Northern-hemisphere meteorological season of a month number."""
    c = as_column(month)
    return (
        F.when(c.isin(12, 1, 2), "winter")
        .when(c.isin(3, 4, 5), "spring")
        .when(c.isin(6, 7, 8), "summer")
        .when(c.isin(9, 10, 11), "autumn")
    )
