"""Group aggregates, pivots with declared values or those found, and duplicate reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.functions._columns import ColumnLike, as_column
from portolan.functions.dates import MONTHS
from portolan.sources.scratch import store


def group_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).count()


def mixed_rollup(
    df: DataFrame,
    keys: Sequence[str],
    means: Mapping[str, ColumnLike] | None = None,
    sums: Mapping[str, ColumnLike] | None = None,
) -> DataFrame:
    """Means and sums per group, each ``{output name: column}``; nulls are ignored."""
    measures = [F.avg(as_column(c)).alias(n) for n, c in (means or {}).items()]
    measures += [F.sum(as_column(c)).alias(n) for n, c in (sums or {}).items()]
    return df.groupBy(*keys).agg(*measures)


def monthly_profile(
    df: DataFrame,
    key: str,
    date: ColumnLike,
    value: ColumnLike,
    companions: Mapping[str, ColumnLike] | None = None,
    prefix: str = "",
) -> DataFrame:
    """One row per key with the mean of ``value`` in each calendar month as a column.

    A month without rows gives null. ``companions`` (``{output name: column}``) are
    averaged per month as well, and the earliest month's average is kept. Months and
    companions come from one aggregation, so they need no join.
    """
    companions = companions or {}
    monthly = (
        df.groupBy(F.col(key), F.month(as_column(date)).alias("_month"))
        .agg(
            F.avg(as_column(value)).alias("_value"),
            *[F.avg(as_column(c)).alias(n) for n, c in companions.items()],
        )
    )
    return monthly.groupBy(key).agg(
        *[F.min_by(n, "_month").alias(n) for n in companions],
        *[
            F.max(F.when(F.col("_month") == number, F.col("_value"))).alias(prefix + name.lower())
            for number, name in enumerate(MONTHS, start=1)
        ],
    )


def category_pivot(
    df: DataFrame,
    keys: Sequence[str],
    category: str,
    names: Mapping[str, str],
    measure: Column,
) -> DataFrame:
    """Sum of ``measure`` per category as columns; ``names`` maps category to column.

    The categories are declared, so no job runs to find them, and one that is absent
    gives null.
    """
    pivoted = df.groupBy(*keys).pivot(category, list(names)).agg(F.sum(measure))
    return pivoted.select(*keys, *[F.col(f"`{c}`").alias(n) for c, n in names.items()])


def open_pivot(
    df: DataFrame,
    keys: Sequence[str],
    category: str,
    measure: Column,
    widest: int = 256,
    prefix: str = "",
) -> DataFrame:
    """Sum of ``measure`` per key and category, the categories found in the data.

    First ``measure`` is summed per key and category and stored, which is all that is read
    afterwards. Up to ``widest`` categories become columns, named by ``prefix`` and the
    category as text, in its order; null is the last, ``null``. More of them stay rows:
    ``keys``, category and total. Nothing is dropped either way. A key without rows of a
    category has null there; a name that two columns would share raises.
    """
    sums = store(
        df.select(*keys, F.col(category).cast("string").alias("category"), measure.alias("_measure"))
        .groupBy(*keys, "category").agg(F.sum("_measure").alias("total")),
        "pivot-sums",
    )
    found = [r["category"] for r in sums.select("category").distinct().limit(widest + 1).collect()]
    if len(found) > widest:
        return sums
    names = {c: f"{prefix}{'null' if c is None else c}" for c in sorted(found, key=lambda c: (c is None, c))}
    taken = [n.lower() for n in (*keys, *names.values())]
    if len(set(taken)) < len(taken):
        raise ValueError(f"categories {sorted(set(names.values()))} and keys {list(keys)} share a name; give a prefix")
    columns = [F.sum(F.when(F.col("category").eqNullSafe(F.lit(c)), F.col("total"))).alias(n) for c, n in names.items()]
    return sums.groupBy(*keys).agg(*columns) if columns else sums.select(*keys)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def top_duplicates(df: DataFrame, keys: Sequence[str], k: int = 10) -> DataFrame:
    """The ``k`` most repeated keys; equal counts are ordered by key."""
    return duplicate_keys(df, keys).orderBy(F.desc("count"), *keys).limit(k)


def year_pair_histogram(df: DataFrame, end: ColumnLike, start: ColumnLike) -> DataFrame:
    """Rows per (year of end, year of start)."""
    return df.groupBy(
        F.year(as_column(end)).alias("end_year"), F.year(as_column(start)).alias("start_year")
    ).count()
