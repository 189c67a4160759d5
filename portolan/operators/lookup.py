"""Joins of a large table to a lookup, and reports built on them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portolan.functions._columns import ColumnLike, as_column
from portolan.operators.broadcasting import MAX_BROADCAST_BYTES, fits_broadcast

# A key with at least one row in HOT_KEYS is salted in a join, so that each of its salts
# has about one row in HOT_KEYS; rows with a null key are spread over NULL_SALTS.
HOT_KEYS, NULL_SALTS = 5_000, 1_024
_SALT = "_salt_of_key"
# Keys are sketched in this many groups, so that as many tasks merge the sketches.
_SKETCH_GROUPS = 64
_COUNTERS_PER_GROUP = 4 * HOT_KEYS // _SKETCH_GROUPS


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Join ``facts`` to a ``lookup`` that is unique on ``on``.

    ``how`` is inner, left, left_semi or left_anti. A lookup measured to be small
    is broadcast, and ``facts`` is not shuffled. For a larger one the frequent keys of
    ``facts`` are found first, by a scan of the key columns; their rows are salted, and
    just their lookup rows are replicated, once for each salt. Rows with a null key, which
    match nothing but stay in a left join, are spread too. The join reads ``facts`` once.
    It stays exact where the lookup repeats a key. Filter ``facts`` before: the salt, which
    depends on the task, keeps later filters from the scan.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    on = list(on)
    for c in on:
        if facts.schema[c].dataType != lookup.schema[c].dataType:
            raise TypeError(f"key {c!r} has different types on the two sides")
    if fits_broadcast(lookup, max_broadcast_bytes):
        return facts.join(F.broadcast(lookup), on, how)

    salts = _salts(frequent_key_shares(facts, on))
    keeps_unmatched = how in ("left", "left_anti")
    if not salts and not keeps_unmatched:
        return facts.join(lookup, on, how)
    of_key = F.lit(1)
    for n, hashes in salts.items():
        of_key = F.when(_hash_among(on, hashes), n).otherwise(of_key)
    of_fact = F.when(any_null(on), NULL_SALTS).otherwise(of_key) if keeps_unmatched else of_key
    # The row and its partition give the salt, so that a task run again gives the same one,
    # and rows that are alike still spread.
    row = F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns if not _has_map(facts.schema[c].dataType)])
    salted = facts.withColumn(_SALT, F.pmod(row + F.spark_partition_id(), of_fact).cast("int"))
    copies = lookup.withColumn(_SALT, F.explode(F.sequence(F.lit(0), of_key.cast("int") - 1)))
    return salted.join(copies, [*on, _SALT], how).drop(_SALT)


def _has_map(kind: T.DataType) -> bool:
    return "map<" in kind.simpleString()


def _salts(shares: dict[int, float]) -> dict[int, list[int]]:
    """Numbers of salts, powers of two, and the keys (by hash) that get as many."""
    salts: dict[int, list[int]] = {}
    for h, share in shares.items():
        salts.setdefault(1 << int(share * HOT_KEYS).bit_length(), []).append(h)
    return salts


def frequent_key_hashes(df: DataFrame, on: Sequence[str]) -> list[int]:
    """``xxhash64`` of the keys that hold at least one row in HOT_KEYS."""
    return list(frequent_key_shares(df, on))


def frequent_key_shares(df: DataFrame, on: Sequence[str]) -> dict[int, float]:
    """Shares of the rows with a whole key that the frequent keys hold, by ``xxhash64``.

    A frequent key holds at least one row in HOT_KEYS. One scan of the key columns; a task
    sends sketches of fixed size, not its keys.
    """
    sketched = (
        df.na.drop(subset=list(on))
        .select(F.xxhash64(*on).alias("h"))
        .groupBy(F.pmod("h", F.lit(_SKETCH_GROUPS)).alias("sketch_group"))
        .agg(
            F.call_function(
                "approx_top_k",
                F.col("h"),
                F.lit(_COUNTERS_PER_GROUP // 2),
                F.lit(_COUNTERS_PER_GROUP),
            ).alias("top"),
            F.count("*").alias("rows"),
        )
        .collect()
    )
    rows = sum(g["rows"] for g in sketched)
    return {k["item"]: k["count"] / rows for g in sketched for k in g["top"] if k["count"] * HOT_KEYS >= rows}


def _hash_among(on: Sequence[str], hashes: Sequence[int]) -> Column:
    if not hashes:
        return F.lit(False)
    # As text: one call for the whole list, where isin() makes one per value.
    key = ", ".join(f"`{c}`" for c in on)
    return F.expr(f"xxhash64({key}) IN ({', '.join(f'{h}L' for h in hashes)})")


def any_null(columns: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(c).isNull() for c in columns])


def valid_or_other(code: ColumnLike, valid: Sequence[str], other: str = "99") -> Column:
    """The code if it is on a short list, else ``other``; null counts as not listed."""
    c = as_column(code)
    return F.when(c.isin(list(valid)), c).otherwise(F.lit(other))


def valid_or_other_lookup(
    df: DataFrame, column: str, valid: DataFrame, other: str = "99"
) -> DataFrame:
    """As :func:`valid_or_other` with the list as a one-column table of unique codes."""
    listed = valid.select(F.col(valid.columns[0]).alias(column), F.lit(True).alias("_listed"))
    joined = lookup_join(df, listed, [column], "left")
    return joined.select(
        *[
            F.when(F.col("_listed"), F.col(c)).otherwise(F.lit(other)).alias(c)
            if c == column
            else F.col(c)
            for c in df.columns
        ]
    )


def match_rate(
    rows: DataFrame,
    key: Column,
    lookup: DataFrame,
    name: str,
    code: str,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Rows per matched ``code`` when ``key`` is left-joined to ``lookup[name]``.

    A name listed under several codes counts for each; the null code holds the rows
    without a match. Rows are counted per key before the join, so a frequent key is one
    row by the time it is joined; a long lookup is joined to those counts, as one of
    its names may be frequent.
    """
    keyed = rows.select(key.alias(name)).groupBy(name).agg(F.count("*").alias("_rows"))
    listed = lookup.select(name, code)
    if fits_broadcast(listed, max_broadcast_bytes):
        counted = keyed.join(F.broadcast(listed), name, "left")
    else:
        matched = lookup_join(listed, keyed, [name], "inner", max_broadcast_bytes)
        unmatched = keyed.join(listed.select(name).distinct(), name, "left_anti")
        no_code = F.lit(None).cast(lookup.schema[code].dataType).alias(code)
        counted = matched.unionByName(unmatched.select(name, "_rows", no_code))
    return counted.groupBy(code).agg(F.sum("_rows").alias("count"))
