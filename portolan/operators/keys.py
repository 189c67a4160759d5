"""Distinct rows, deterministic dedupe and dense surrogate keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portolan.operators.broadcasting import MAX_BROADCAST_BYTES
from portolan.operators.lookup import lookup_join
from portolan.sources.scratch import store


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first by ``order_by``, then by all remaining columns.

    Rows that tie are identical, so the survivor does not depend on partitioning.
    Spark trims each key to one row before the shuffle (WindowGroupLimit), so a key
    that holds much of the table does not reach one task whole. The hash of the key
    leads the sort, where it settles most comparisons without reading the key itself.
    """
    first = list(order_by or [])
    rest = [c for c in df.columns if c not in set(keys) | set(first)]
    order = [F.col(c) for c in first + rest] or [F.lit(1)]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def dense_surrogate_key(df: DataFrame, order_by: Sequence[str], name: str = "id") -> DataFrame:
    """Number rows 1..n in the global order of ``order_by``, which must identify a row.

    Equal to ``row_number() over (order by ...)`` without moving all rows to one task:
    the rows are range-sorted, each notes its partition and its place in it, and the
    sizes of the partitions before it are added. The sorted rows are written to the
    session's checkpoint folder first, so the places are stored facts that a lost
    executor cannot change. Only the table of partition sizes, one row per partition,
    is summed in one task and broadcast; it is stored too, so that the rows' readers do not
    count them again.
    """
    # monotonically_increasing_id: partition number in the upper 31 bits, row below.
    sorted_rows = df.orderBy(*order_by).withColumn("_place", F.monotonically_increasing_id())
    placed = store(sorted_rows, "sorted-keys").select(
        *df.columns,
        F.shiftright("_place", 33).alias("_part"),
        F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"),
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part").agg(F.count("*").alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    )
    return placed.join(F.broadcast(store(offsets, "key-offsets")), "_part").select(
        *df.columns, (F.col("_before") + F.col("_row") + 1).alias(name)
    )


def attach_surrogate_key(
    facts: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str],
    key: str,
    keep_unmatched: bool = False,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Add the dimension's ``key`` to facts; ``on`` maps fact columns to dimension columns.

    By default facts with a null or unknown natural key are dropped; with
    ``keep_unmatched`` they stay with a null key.
    """
    lookup = dimension.select(*[F.col(d).alias(f) for f, d in on.items()], key)
    how = "left" if keep_unmatched else "inner"
    return lookup_join(facts, lookup, list(on), how, max_broadcast_bytes)
