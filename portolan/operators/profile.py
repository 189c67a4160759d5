"""Column profiles of a table, each in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Characters of a SHA-256 digest.
_DIGEST = 64


def _rows_from(totals: DataFrame, rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Turn the single row of ``totals`` into one row per mapping."""
    structs = [F.struct(*[c.alias(n) for n, c in row.items()]) for row in rows]
    return totals.select(F.inline(F.array(*structs)))


def table_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: type, rows, nulls and exact number of distinct values.

    Null counts as one distinct value. Values are counted as (column, text) pairs, which
    keeps the shuffled rows narrow however many columns there are: text longer than its
    digest is counted by its digest. Each task first counts its own pairs, so a frequent
    value is one row per task.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    pairs = [
        F.struct(F.lit(i).alias("i"), _as_text(f).alias("value")) for i, f in enumerate(fields)
    ]
    counted = df.select(F.inline(F.array(*pairs))).groupBy("i", "value").agg(F.count("*").alias("n"))
    totals = counted.groupBy("i").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n"))).alias("nulls"),
        F.count("*").alias("distinct_values"),
    )

    labels = df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields)],
        "i int, column string, type string",
    ).coalesce(1)
    # One row per column on both sides; an empty table has totals for none.
    joined = labels.join(F.broadcast(totals), "i", "left")
    return joined.drop("i").fillna(0)


def _as_text(field: T.StructField) -> Column:
    """Short text that differs for different values."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        text = F.to_json(c)
    elif isinstance(field.dataType, T.BinaryType):
        text = F.hex(c)
    elif isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return (c + F.lit(0.0)).cast("string")  # 0.0 and -0.0 are one value
    elif isinstance(field.dataType, T.StringType):
        text = c
    else:
        return c.cast("string")
    return F.when(F.octet_length(text) > _DIGEST, F.sha2(text.cast("binary"), 256)).otherwise(text)


def column_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, standard deviation, min and max per column, one row each.

    Min and max are text, as columns of several types share the result; mean and
    deviation of text columns are taken over the values that are numbers.
    """
    wanted = [f for f in df.schema.fields if columns is None or f.name in columns]
    totals, rows, columns = [], [], []
    for i, f in enumerate(wanted):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            n = c.try_cast("double")
        elif isinstance(f.dataType, T.NumericType):
            n = c.cast("double")
        else:
            n = F.lit(None).cast("double")
        columns += [c.alias(f"v{i}"), n.alias(f"n{i}")]  # a text is cast once, not once for each total
        c, n = F.col(f"v{i}"), F.col(f"n{i}")
        totals += [
            F.count(c).alias(f"c{i}"),
            F.avg(n).alias(f"m{i}"),
            F.stddev(n).alias(f"s{i}"),
            F.min(c).cast("string").alias(f"lo{i}"),
            F.max(c).cast("string").alias(f"hi{i}"),
        ]
        rows.append(
            {
                "column": F.lit(f.name),
                "count": F.col(f"c{i}"),
                "mean": F.col(f"m{i}"),
                "stddev": F.col(f"s{i}"),
                "min": F.col(f"lo{i}"),
                "max": F.col(f"hi{i}"),
            }
        )
    return _rows_from(df.select(*columns).agg(*totals), rows)


def uniqueness(df: DataFrame, column: str) -> DataFrame:
    """Rows, distinct values and their ratio in percent (null is one value)."""
    c = F.col(column)
    totals = df.agg(
        F.count("*").alias("rows"),
        (F.count_distinct(c) + (F.count_if(c.isNull()) > 0).cast("bigint")).alias("distinct_values"),
    )
    return totals.withColumn(
        "unique_percent", F.try_divide(F.col("distinct_values"), F.col("rows")) * 100
    )


def column_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))


def rejected_casts(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Per column, recorded values that do not fit the type they are to be cast to."""
    names = list(casts)
    totals = df.agg(
        *[
            F.count_if(F.col(n).isNotNull() & F.col(n).try_cast(casts[n]).isNull()).alias(f"r{i}")
            for i, n in enumerate(names)
        ]
    )
    return _rows_from(
        totals,
        [
            {"column": F.lit(n), "type": F.lit(casts[n]), "rejected": F.col(f"r{i}")}
            for i, n in enumerate(names)
        ],
    )
