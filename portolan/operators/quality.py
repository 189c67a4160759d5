"""Quality gates. A table's checks are one aggregation and come back as rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The check that is reported without failing a table.
REPORTED = "reported_unique"


class QualityError(ValueError):
    """A table does not meet its expectations."""


@dataclass(frozen=True)
class Expectations:
    """What a table must satisfy; an empty table always fails.

    ``unique`` holds keys, each one or more columns; null is one value of a key. Keys in
    ``reported_unique`` are counted alike, but repeats of them do not fail the table.
    """

    unique: tuple[tuple[str, ...], ...] = ()
    reported_unique: tuple[tuple[str, ...], ...] = ()
    not_null: tuple[str, ...] = ()
    types: Mapping[str, T.DataType] = field(default_factory=dict)


def run_checks(df: DataFrame, table: str, expected: Expectations) -> DataFrame:
    """``(table, check, column, passed, observed)``, one row per expectation.

    ``observed`` counts the rows that violate it: surplus rows of a key, nulls, 1 for a
    wrong or missing type. For the row check it is the number of rows.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    totals = [F.count("*").alias("rows")]
    checks = [("has_rows", "*", F.col("rows") > 0, F.col("rows"))]

    keys = [("unique", k) for k in expected.unique]
    keys += [(REPORTED, k) for k in expected.reported_unique]
    for i, (check, key) in enumerate(keys):
        label = ",".join(key)
        if any(c not in present for c in key):
            checks.append((check, label, F.lit(False), F.lit(None).cast("bigint")))
            continue
        totals.append(_distinct_keys(key).alias(f"u{i}"))
        surplus = F.col("rows") - F.col(f"u{i}")
        checks.append((check, label, surplus == 0, surplus))
    for i, name in enumerate(expected.not_null):
        if name not in present:
            checks.append(("not_null", name, F.lit(False), F.lit(None).cast("bigint")))
            continue
        totals.append(F.count_if(F.col(name).isNull()).alias(f"n{i}"))
        checks.append(("not_null", name, F.col(f"n{i}") == 0, F.col(f"n{i}")))
    for name, data_type in expected.types.items():
        ok = present.get(name) == data_type
        checks.append(("type", name, F.lit(ok), F.lit(0 if ok else 1)))

    rows = [
        F.struct(
            F.lit(table).alias("table"),
            F.lit(check).alias("check"),
            F.lit(column).alias("column"),
            passed.alias("passed"),
            observed.cast("bigint").alias("observed"),
        )
        for check, column, passed, observed in checks
    ]
    return df.agg(*totals).select(F.inline(F.array(*rows)))


def _distinct_keys(key: Sequence[str]) -> Column:
    if len(key) == 1:
        c = F.col(key[0])
        return F.count_distinct(c) + (F.count_if(c.isNull()) > 0).cast("bigint")
    return F.count_distinct(F.struct(*key))


def run_suite(tables: Mapping[str, tuple[DataFrame, Expectations]]) -> DataFrame:
    """The checks of several tables as one report."""
    return reduce(
        DataFrame.unionByName, [run_checks(df, t, expected) for t, (df, expected) in tables.items()]
    )


def enforce(report: DataFrame) -> list:
    """Run a report (one row per check) and raise if any check failed."""
    rows = report.collect()
    failed = [r for r in rows if not r["passed"] and r["check"] != REPORTED]
    if failed:
        shown = "; ".join(
            f"{r['table']}.{r['column']} {r['check']} (observed {r['observed']})"
            for r in failed
        )
        raise QualityError(f"{len(failed)} of {len(rows)} checks failed: {shown}")
    return rows


def require_unique(df: DataFrame, table: str, key: str | Sequence[str]) -> None:
    columns = (key,) if isinstance(key, str) else tuple(key)
    _require(df, table, Expectations(unique=(columns,)), "unique")


def require_not_null(df: DataFrame, table: str, column: str) -> None:
    _require(df, table, Expectations(not_null=(column,)), "not_null")


def require_type(df: DataFrame, table: str, column: str, data_type: T.DataType) -> None:
    """The column exists with this type; decided on the schema, no job runs."""
    found = {f.name: f.dataType for f in df.schema.fields}.get(column)
    if found != data_type:
        raise QualityError(f"{table}.{column} is {found}, expected {data_type}")


def require_rows(df: DataFrame, table: str) -> None:
    if df.isEmpty():
        raise QualityError(f"{table} has no rows")


def _require(df: DataFrame, table: str, expected: Expectations, check: str) -> None:
    enforce(run_checks(df, table, expected).filter(F.col("check") == check))


def match_counts(source: DataFrame, written: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Row counts of a table and of its copy, in total or per value of ``by``."""
    def counted(df: DataFrame, mine: str, other: str) -> DataFrame:
        return df.groupBy(*by).agg(F.count("*").alias(mine), F.lit(0).cast("bigint").alias(other))

    both = counted(source, "source_rows", "written_rows").unionByName(
        counted(written, "written_rows", "source_rows")
    )
    return (
        both.groupBy(*by)
        .agg(F.sum("source_rows").alias("source_rows"), F.sum("written_rows").alias("written_rows"))
        .withColumn("matched", F.col("source_rows") == F.col("written_rows"))
    )


def require_same_count(source: DataFrame, written: DataFrame, table: str) -> None:
    row = match_counts(source, written).first()
    if not row["matched"]:
        raise QualityError(
            f"{table}: {row['source_rows']} rows at the source, {row['written_rows']} written"
        )
