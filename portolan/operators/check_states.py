"""Checks as stored states of partitions, merged without reading the tables again."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portolan.operators.quality import REPORTED, Expectations

_COUNTS = ("rows", "violations")


def _digest(key: Sequence[str], seed: int) -> Column:
    parts = [x for c in key for x in (F.col(c), F.col(c).isNull())]
    return F.xxhash64(F.lit(seed), *parts)


def check_state(df: DataFrame, expected: Expectations, by: Sequence[str]) -> DataFrame:
    """One row per partition and check: ``by``, check, column, rows, violations.

    ``rows`` counts the partition's rows; violations are nulls of a column that must have
    none, and 1 for a wrong or missing type. Keys are in :func:`key_state`.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    checks = [("has_rows", "*", F.lit(0).cast("bigint"))]
    for name in expected.not_null:
        absent = F.count("*") if name not in present else F.count_if(F.col(name).isNull())
        checks.append(("not_null", name, absent))
    for name, kind in expected.types.items():
        checks.append(("type", name, F.lit(int(present.get(name) != kind)).cast("bigint")))
    rows = [
        F.struct(F.lit(check).alias("check"), F.lit(column).alias("column"), F.col("rows"), F.col(f"v{i}").alias("violations"))
        for i, (check, column, _) in enumerate(checks)
    ]
    totals = df.groupBy(*by).agg(F.count("*").alias("rows"), *[v.alias(f"v{i}") for i, (_, _, v) in enumerate(checks)])
    return totals.select(*by, F.inline(F.array(*rows)))


def key_state(df: DataFrame, expected: Expectations, by: Sequence[str]) -> DataFrame:
    """One row per partition and distinct key: ``by``, check, column, two digests, rows.

    128 bits stand for a key, whatever its columns; null is one value of a column. A key
    with a column that ``df`` lacks has no states and fails in :func:`merged_report`.
    """
    parts = []
    for check, keys in (("unique", expected.unique), (REPORTED, expected.reported_unique)):
        for key in keys:
            if all(c in df.columns for c in key):
                parts.append(
                    df.groupBy(*by, _digest(key, 1).alias("h1"), _digest(key, 2).alias("h2")).agg(F.count("*").alias("rows"))
                    .select(*by, F.lit(check).alias("check"), F.lit(",".join(key)).alias("column"), "h1", "h2", "rows")
                )
    return reduce(DataFrame.unionByName, parts)


def replaced(states: DataFrame, new: DataFrame, by: Sequence[str]) -> DataFrame:
    """Stored states with those of the partitions in ``new`` in place of the old ones."""
    months = new.select(*by).distinct()
    return states.join(F.broadcast(months), list(by), "left_anti").unionByName(new)


def merged_report(counts: DataFrame, keys: DataFrame, table: str, expected: Expectations) -> DataFrame:
    """The report of ``run_checks`` over all partitions, from their states alone.

    A key that two partitions share counts as repeated, just as one that repeats within a
    partition does.
    """
    summed = counts.groupBy("check", "column").agg(F.sum("rows").alias("n"), F.max("violations").alias("most"), F.sum("violations").alias("sum"))
    observed = F.when(F.col("check") == "has_rows", F.col("n")).when(F.col("check") == "type", F.col("most")).otherwise(F.col("sum"))
    passed = F.when(F.col("check") == "has_rows", F.col("n") > 0).otherwise(observed == 0)
    simple = summed.select("check", "column", passed.alias("passed"), observed.cast("bigint").alias("observed"))

    per_key = keys.groupBy("check", "column", "h1", "h2").agg(F.sum("rows").alias("rows"))
    surplus = per_key.groupBy("check", "column").agg((F.sum("rows") - F.count("*")).alias("observed"))
    unique = surplus.select("check", "column", (F.col("observed") == 0).alias("passed"), F.col("observed").cast("bigint").alias("observed"))
    found = simple.unionByName(unique)

    wanted = [("has_rows", "*")] + [("unique", ",".join(k)) for k in expected.unique]
    wanted += [(REPORTED, ",".join(k)) for k in expected.reported_unique]
    wanted += [("not_null", c) for c in expected.not_null] + [("type", c) for c in expected.types]
    listed = counts.sparkSession.createDataFrame(wanted, "check string, `column` string")
    # A check without states fails: no partition, or a key that the table lacks.
    nothing = F.when(F.col("check") == "has_rows", F.lit(0).cast("bigint"))
    return F.broadcast(listed).join(found, ["check", "column"], "left").select(
        F.lit(table).alias("table"), "check", "column",
        F.coalesce("passed", F.lit(False)).alias("passed"), F.coalesce("observed", nothing).alias("observed"),
    )
