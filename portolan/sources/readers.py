"""Parquet and delimited-text readers, and read-or-build."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from portolan.sources.fingerprints import fingerprint
from portolan.sources.folders import path_exists
from portolan.sources.versions import VersionedTable


def _require_columns(df: DataFrame, required: Sequence[str], path: str) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")


def read_parquet(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    required: Sequence[str] = (),
) -> DataFrame:
    """A Parquet folder; naming a schema avoids reading footers to find one."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    _require_columns(df, required, path)
    return df


def read_delimited(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    required: Sequence[str] = (),
    **options: object,
) -> DataFrame:
    """Delimited text with a header line; every column is a string.

    Columns are found by the header. The files of one folder must have the same header:
    one that differs raises when it is read, as its columns would be mistaken. Cast the
    columns with ``functions.to_number`` and ``functions.parse_date``. Files stay
    splittable.
    """
    df = spark.read.csv(path, sep=sep, header=True, inferSchema=False, enforceSchema=False, **options)
    _require_columns(df, required, path)
    return df


def materialize_if_missing(
    spark: SparkSession, path: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """The Parquet table at ``path``; built and stored there first if it is not yet.

    A folder without the ``_SUCCESS`` mark that Spark sets at the end of a write, as an
    interrupted one leaves it, counts as missing.
    """
    if not path_exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def refreshed_copy(
    spark: SparkSession, path: str, source: DataFrame, build: Callable[[DataFrame], DataFrame] = lambda df: df
) -> DataFrame:
    """The copy of ``build(source)`` at ``path``, made again if the source has changed.

    The copy's manifest holds what it was made from: the source's files with their lengths
    and times of change, its plan, and the columns that ``build`` gives. The old copy stays
    readable until the new one is whole. A copy that is up to date is read without a job.
    """
    table, built = VersionedTable(spark, path), build(source)
    made_from = fingerprint([built], path)
    current = table.manifest()
    if current is None or current.facts.get("fingerprint") != made_from:
        staged = table.stage()
        built.write.parquet(staged)
        table.commit(staged, fingerprint=made_from)
    return table.read(built.schema)
