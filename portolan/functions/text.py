"""Text expressions: split-and-pick, coordinates with a hemisphere letter, place keys."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from portolan.functions._columns import ColumnLike, as_column

# The part types a caller may name.
_PART_TYPES = {"str": None, "string": None, "float": "double", "double": "double", "int": "int"}


def split_pick(
    text: ColumnLike, delimiter: str = "-", index: int = 0, part_type: str = "str"
) -> Column:
    """Part ``index`` (from 0) of text split at a literal delimiter, as the named type.

    Out of range, null text and parts that do not fit the type give null; an empty
    part stays an empty string.
    """
    if not delimiter:
        raise ValueError("delimiter must not be empty")
    if index < 0:
        raise ValueError("index counts from 0")
    if part_type not in _PART_TYPES:
        raise ValueError(f"part_type must be one of {sorted(_PART_TYPES)}, not {part_type!r}")
    part = F.get(F.split(as_column(text), re.escape(delimiter)), F.lit(index))
    target = _PART_TYPES[part_type]
    return part if target is None else part.try_cast(target)


def hemisphere_coordinate(text: ColumnLike) -> Column:
    """``57.05N`` to 57.05 and ``10.33W`` to -10.33.

    Text without a letter of N, E, S, W gives 0.0; null and malformed text give null.
    """
    c = as_column(text)
    positive = c.contains("N") | c.contains("E")
    negative = c.contains("S") | c.contains("W")
    return (
        F.when(positive, F.translate(c, "NE", "").try_cast("double"))
        .when(negative, -F.translate(c, "SW", "").try_cast("double"))
        .when(c.isNotNull(), F.lit(0.0))
    )


def trimmed(text: ColumnLike) -> Column:
    return F.trim(as_column(text))


def place_key(city: ColumnLike, state_code: ColumnLike) -> Column:
    """``CITY, ST``; null when either part is null."""
    return F.concat(F.upper(as_column(city)), F.lit(", "), as_column(state_code))
