"""Row filters, written as plain comparisons so that scans can skip on them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.functions._columns import ColumnLike, as_column
from portolan.functions.dates import serial_of
from portolan.operators.lookup import lookup_join

def recorded_and_not(df: DataFrame, unwanted: dict[str, object]) -> DataFrame:
    """Rows where every named column is recorded and differs from the unwanted value."""
    for name, value in unwanted.items():
        df = df.filter(F.col(name) != F.lit(value))
    return df


def exclude_values(df: DataFrame, column: str, values: Sequence[object] | DataFrame) -> DataFrame:
    """Rows whose recorded value is not on the list; null values are dropped.

    A list given as a one-column DataFrame is anti-joined and may be of any size.
    """
    recorded = df.filter(F.col(column).isNotNull())
    if isinstance(values, DataFrame):
        listed = values.select(F.col(values.columns[0]).alias(column)).distinct()
        return lookup_join(recorded, listed, [column], "left_anti")
    return recorded.filter(~F.col(column).isin(list(values)))


def open_or_within_year(end: ColumnLike, year: int) -> Column:
    """True when ``end`` lies in the year or is null; a range test, not ``year(end)``."""
    c = as_column(end)
    first, after = dt.date(year, 1, 1), dt.date(year + 1, 1, 1)
    return c.isNull() | ((c >= F.lit(first)) & (c < F.lit(after)))


def serial_open_or_within_year(serial: ColumnLike, year: int) -> Column:
    """:func:`open_or_within_year` on raw serial days.

    What has no date is open: null, 0 and below, NaN, and days past the integers.

    Parquet row groups are skipped on this one, since it tests the stored column.
    """
    c = as_column(serial)
    first, after = serial_of(dt.date(year, 1, 1)), serial_of(dt.date(year + 1, 1, 1))
    return (
        ((c >= F.lit(float(first))) & (c < F.lit(float(after))))
        | c.isNull()
        | (c <= F.lit(0.0))
        | (c >= F.lit(2147483648.0))  # NaN is greater than every number
    )


def open_or_ordered(start: ColumnLike, end: ColumnLike) -> Column:
    """True when the interval has no end or does not end before the day it starts."""
    return as_column(end).isNull() | (F.datediff(as_column(end), as_column(start)) >= 0)


def since(date: ColumnLike, first: dt.date) -> Column:
    return as_column(date) >= F.lit(first)
