from __future__ import annotations

import pytest
from pyspark.sql import types as T

from portolan.operators import (
    Expectations,
    QualityError,
    enforce,
    match_counts,
    require_not_null,
    require_rows,
    require_same_count,
    require_type,
    require_unique,
    run_checks,
    run_suite,
)


def report(df, **expected):
    rows = run_checks(df, "t", Expectations(**expected)).collect()
    return {(r["check"], r["column"]): (r["passed"], r["observed"]) for r in rows}


def test_unique_keys(spark):
    good = spark.createDataFrame([(1, "a"), (2, "a"), (None, "b")], "k int, s string")
    assert report(good, unique=(("k",), ("k", "s"), ("s",))) == {
        ("has_rows", "*"): (True, 3),
        ("unique", "k"): (True, 0),
        ("unique", "k,s"): (True, 0),
        ("unique", "s"): (False, 1),
    }
    nulls = spark.createDataFrame([(None,), (None,), (1,)], "k int")
    assert report(nulls, unique=(("k",),))["unique", "k"] == (False, 1)


def test_nulls_types_and_absent_columns(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k int, s string")
    got = report(
        df,
        unique=(("gone",),),
        not_null=("k", "s", "gone"),
        types={"k": T.IntegerType(), "s": T.DateType(), "gone": T.DateType()},
    )
    assert got == {
        ("has_rows", "*"): (True, 2),
        ("unique", "gone"): (False, None),
        ("not_null", "k"): (False, 1),
        ("not_null", "s"): (True, 0),
        ("not_null", "gone"): (False, None),
        ("type", "k"): (True, 0),
        ("type", "s"): (False, 1),
        ("type", "gone"): (False, 1),
    }


def test_empty_table_fails(spark):
    empty = spark.createDataFrame([], "k int")
    assert report(empty, unique=(("k",),), not_null=("k",)) == {
        ("has_rows", "*"): (False, 0),
        ("unique", "k"): (True, 0),
        ("not_null", "k"): (True, 0),
    }


def test_one_aggregation_per_table(small, plan):
    df = run_checks(
        small("orders"),
        "orders",
        Expectations(unique=(("o_orderkey",),), not_null=("o_orderkey", "o_custkey")),
    )
    text = plan(df)
    assert text.count("FileScan") == 1
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text


def test_enforce(spark, small):
    lines, orders = small("lineitem"), small("orders")
    suite = {
        "lineitem": (lines, Expectations(unique=(("l_orderkey", "l_linenumber"),))),
        "orders": (orders, Expectations(unique=(("o_orderkey",),))),
    }
    with pytest.raises(QualityError, match="1 of 4 checks failed: lineitem.l_orderkey,l_linenumber"):
        enforce(run_suite(suite))
    assert len(enforce(run_suite({"orders": suite["orders"]}))) == 2


def test_reported_keys_do_not_fail(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a")], "k int, s string")
    expected = {"unique": (("k",),), "reported_unique": (("s",),)}
    assert report(df, **expected)["reported_unique", "s"] == (False, 1)
    assert len(enforce(run_checks(df, "t", Expectations(**expected)))) == 3


def test_single_gates(spark):
    df = spark.createDataFrame([(1, "a"), (1, None)], "k int, s string")
    require_not_null(df, "t", "k")
    require_type(df, "t", "k", T.IntegerType())
    require_rows(df, "t")
    require_unique(df, "t", ("k", "s"))
    for gate in (
        lambda: require_unique(df, "t", "k"),
        lambda: require_not_null(df, "t", "s"),
        lambda: require_type(df, "t", "k", T.LongType()),
        lambda: require_type(df, "t", "gone", T.LongType()),
        lambda: require_rows(df.limit(0), "t"),
        lambda: require_same_count(df, df.limit(1), "t"),
    ):
        with pytest.raises(QualityError):
            gate()


def test_match_counts(spark):
    source = spark.createDataFrame([(1,), (1,), (2,), (None,)], "m int")
    written = spark.createDataFrame([(1,), (1,), (3,), (None,)], "m int")
    assert tuple(match_counts(source, written).first()) == (4, 4, True)
    by = {r["m"]: (r["source_rows"], r["written_rows"], r["matched"]) for r in match_counts(source, written, ["m"]).collect()}
    assert by == {1: (2, 2, True), 2: (1, 0, False), 3: (0, 1, False), None: (1, 1, True)}
    nothing = source.limit(0)
    assert tuple(match_counts(nothing, nothing).first()) == (0, 0, True)
