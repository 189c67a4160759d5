"""Projection to a target layout and type-driven casts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portolan.functions import zero_as_missing


def project(df: DataFrame, layout: Mapping[str, Column | str]) -> DataFrame:
    """Select ``{output name: source column or expression}``, in that order."""
    return df.select(
        *[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in layout.items()]
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns and types of ``schema``; a value that does not fit raises."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _double_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]


def fill_zero(df: DataFrame) -> DataFrame:
    """Nulls of every double column become 0."""
    doubles = _double_columns(df)
    return df.fillna(0, subset=doubles) if doubles else df


def cast_doubles_zero_as_missing(
    df: DataFrame, types: Mapping[str, str] | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Every double column to an integer with 0 read as missing, in one projection.

    ``types`` overrides the target of single columns (``{"admnum": "bigint"}``); columns
    in ``keep`` are only cast, their zeros stay.
    """
    types = types or {}
    doubles = set(_double_columns(df))

    def convert(name: str) -> Column:
        if name not in doubles:
            return F.col(name)
        target = types.get(name, "int")
        if name in keep:
            return F.col(name).try_cast(target).alias(name)
        return zero_as_missing(F.col(name), target).alias(name)

    return df.select(*[convert(name) for name in df.columns])


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows, for looking at a table."""
    return df.limit(n)


def register_view(df: DataFrame, name: str) -> str:
    df.createOrReplaceTempView(name)
    return name
