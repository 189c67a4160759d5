"""Numeric expressions: zero-as-missing casts and tolerant text-to-number casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from portolan.functions._columns import ColumnLike, as_column


def zero_as_missing(number: ColumnLike, to: str = "int") -> Column:
    """Truncate a floating number to an integer type, reading 0 as "not recorded".

    Null, 0, NaN and values outside the target range give null; count the last with
    ``operators.profile.rejected_casts``.
    """
    return F.nullif(as_column(number), F.lit(0.0)).try_cast(to)


def to_number(text: ColumnLike, to: str = "double") -> Column:
    """Text to number; malformed text gives null."""
    return as_column(text).try_cast(to)


def null_to(value: ColumnLike, default: object) -> Column:
    return F.coalesce(as_column(value), F.lit(default))
