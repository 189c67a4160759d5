"""Gapless numbering inside groups of which one may hold most of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 100_000


def number_within(
    df: DataFrame,
    key: str,
    identity: Sequence[str],
    counts: Mapping[int, int],
    name: str = "rank",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Number the rows of each ``key`` from 0 without gaps.

    ``key`` holds small non-negative integers and ``counts`` has the rows of each; both are
    known to be few (shards, lengths up to a capacity). Every key is cut by the hash of
    ``identity`` into buckets of about ``rows_per_bucket`` rows, rows are numbered in their
    bucket, and the sizes of the buckets before it are added. No task sorts more than its
    buckets, whatever share of the rows one key has. Rows alike in ``identity`` may trade
    places. ``df`` is read twice and should be stored.
    """
    if not counts:
        return df.withColumn(name, F.lit(0).cast("long"))
    buckets = [max(1, -(-counts.get(k, 0) // rows_per_bucket)) for k in range(max(counts) + 1)]
    bucket = F.pmod(F.xxhash64(*identity), F.element_at(F.lit(buckets), F.col(key).cast("int") + 1))
    dealt = df.withColumn("_bucket", bucket)
    place = Window.partitionBy(key, "_bucket").orderBy(*identity)
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy(key, "_bucket").agg(F.count("*").alias("_size"))
        .select(key, "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    )
    return (
        dealt.withColumn("_row", F.row_number().over(place))
        .join(offsets, [key, "_bucket"])
        .select(*df.columns, (F.col("_before") + F.col("_row") - 1).cast("long").alias(name))
    )
