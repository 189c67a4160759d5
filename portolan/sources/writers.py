"""Parquet sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    mode: str = "overwrite",
    only_present: bool = False,
    max_records_per_file: int = 0,
    rebalance: bool = True,
    cluster_by: Sequence[str] = (),
) -> None:
    """Parquet in ``column=value`` folders.

    Rows are rebalanced on the folder columns: a small folder gets one file, and Spark
    splits a large one over as many tasks as its size asks for, so one month may hold
    most of the table. With ``only_present`` an overwrite replaces just the folders that
    occur in ``df``, for rerunning one month. Without ``rebalance`` nothing is shuffled,
    for rows that already lie together by folder.

    With ``cluster_by`` each folder's rows lie in the order of these columns, and its files
    are ranges of them, so that readers skip files and row groups by their bounds. The
    ranges come from a sample of ``by`` and ``cluster_by`` together: a large folder has
    many, however small the others are.
    """
    if cluster_by:
        order = [*by, *cluster_by]
        placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    else:
        placed = df.hint("rebalance", *by) if rebalance else df
    writer = placed.write.mode(mode).partitionBy(*by)
    if only_present:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)
