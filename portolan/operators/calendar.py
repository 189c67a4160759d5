"""Calendar dimension from the two date columns of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.functions import calendar_columns


def distinct_dates(
    df: DataFrame, start: str, end: str, include_open: bool = False, name: str = "date_date"
) -> DataFrame:
    """Distinct dates of both columns in one scan.

    Rows without an end are left out, start included, unless ``include_open``.
    """
    has_end = F.col(end).isNotNull()
    if include_open:
        dates = F.when(has_end, F.array(start, end)).otherwise(F.array(start))
        return df.select(F.explode(dates).alias(name)).distinct()
    return df.filter(has_end).select(F.explode(F.array(start, end)).alias(name)).distinct()


def distinct_dates_sql(df: DataFrame, start: str, end: str, name: str = "date_date") -> DataFrame:
    """:func:`distinct_dates` as SQL text, with the table passed as a parameter."""
    return df.sparkSession.sql(
        f"""
        SELECT DISTINCT d AS `{name}`
        FROM {{rows}} LATERAL VIEW explode(array(`{start}`, `{end}`)) AS d
        WHERE `{end}` IS NOT NULL
        """,
        rows=df,
    )


def calendar_dimension(
    df: DataFrame, start: str, end: str, include_open: bool = False, name: str = "date_date"
) -> DataFrame:
    """:func:`distinct_dates` with day, week, month, year and weekday attributes."""
    dates = distinct_dates(df, start, end, include_open, name)
    return dates.select(name, *[c.alias(n) for n, c in calendar_columns(name).items()])
