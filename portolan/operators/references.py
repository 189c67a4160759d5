"""Key references: values of a fact table that a dimension lacks."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.operators.broadcasting import MAX_BROADCAST_BYTES, fits_broadcast
from portolan.operators.lookup import lookup_join

# Bits of a Bloom filter per value, the most it may have (2 MB), and its hash functions.
BITS_PER_VALUE, MOST_BITS, HASHES = 12, 1 << 24, 5


def _bit(column: str, seed: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.col(column)), F.lit(bits))


def bloom_filter(values: DataFrame, column: str, count: int) -> tuple[DataFrame, int] | None:
    """A one-row table with the words of a Bloom filter of ``column``, and its bits.

    None if so many values would fill the largest filter. The bits are set in groups of 64
    by an aggregation; only the words, ``MOST_BITS`` / 64 at most, meet in one row.
    """
    bits = max(1024, 1 << (count * BITS_PER_VALUE - 1).bit_length())
    if bits > MOST_BITS:
        return None
    places = F.explode(F.array(*[_bit(column, seed, bits) for seed in range(HASHES)])).alias("p")
    set_words = values.select(places).groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 63 AS int))")).alias("word")
    )
    all_words = values.sparkSession.range(bits >> 6).select(F.col("id").alias("w"))
    dense = all_words.join(set_words, "w", "left").select(F.struct("w", F.coalesce("word", F.lit(0).cast("long")).alias("word")).alias("x"))
    words = F.transform(F.array_sort(F.collect_list("x")), lambda x: x["word"])
    return dense.agg(words.alias("words")), bits


def possibly_in(df: DataFrame, column: str, bloom: DataFrame, bits: int) -> DataFrame:
    """Rows of ``df`` whose ``column`` may be among the filter's values; none of those is lost."""
    words = bloom.scalar()
    tests = []
    for seed in range(HASHES):
        p = _bit(column, seed, bits)
        word = F.get(F.col("_words"), F.shiftright(p, 6).cast("int"))
        tests.append(F.getbit(word, p.bitwiseAND(F.lit(63)).cast("int")) == 1)
    held = df.withColumn("_words", words)
    return held.filter(reduce(Column.__and__, tests)).select(*df.columns)


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value as text, rows) of several columns in one scan; nulls are no values."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    each = df.select(F.inline(F.array(*pairs))).filter("value IS NOT NULL")
    return each.groupBy("column", "value").agg(F.count("*").alias("rows"))


def orphans(
    values: DataFrame, dimension: DataFrame, key: str, max_broadcast_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Rows of ``values`` (value, rows) that are no ``key`` of the dimension.

    A small dimension is broadcast. The keys of a large one first pass a Bloom filter of
    the values, so that a shuffle moves just those which may matter; the join after it is
    exact.
    """
    keys = dimension.select(F.col(key).cast(values.schema["value"].dataType).alias("value")).filter("value IS NOT NULL")
    if not fits_broadcast(keys, max_broadcast_bytes):
        made = bloom_filter(values, "value", values.count())
        if made is not None:
            keys = possibly_in(keys, "value", *made)
    return lookup_join(values, keys, ["value"], "left_anti", max_broadcast_bytes)


def reference_report(
    fact: DataFrame,
    references: Mapping[str, tuple[DataFrame, str]],
    table: str,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """(table, column, orphan_values, orphan_rows) for each reference of a fact table.

    ``references`` maps a column to (dimension, key). The fact table is scanned once for
    the values of all columns; each column's values, not its rows, meet the dimension. A
    null refers to nothing and is no orphan.
    """
    counted = value_counts(fact, list(references)).cache()
    parts = []
    for column, (dimension, key) in references.items():
        lost = orphans(counted.filter(F.col("column") == column).select("value", "rows"), dimension, key, max_broadcast_bytes)
        parts.append(
            lost.agg(F.count("*").alias("orphan_values"), F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows"))
            .select(F.lit(table).alias("table"), F.lit(column).alias("column"), "orphan_values", "orphan_rows")
        )
    return reduce(DataFrame.unionByName, parts)
