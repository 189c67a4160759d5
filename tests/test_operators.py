from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portolan.operators import (
    attach_surrogate_key,
    calendar_dimension,
    cast_doubles_zero_as_missing,
    category_pivot,
    conform,
    dedupe,
    dense_surrogate_key,
    distinct_dates,
    distinct_dates_sql,
    exclude_values,
    fill_zero,
    lookup_join,
    match_rate,
    monthly_profile,
    open_or_ordered,
    open_or_within_year,
    preview,
    recorded_and_not,
    rejected_casts,
    serial_open_or_within_year,
    since,
    table_profile,
    top_duplicates,
    uniqueness,
    valid_or_other,
    valid_or_other_lookup,
)
from portolan.operators.broadcasting import fits_broadcast
from portolan.operators.lookup import frequent_key_hashes


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def same_rows(a, b):
    b = b.select(a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


# --- layout -----------------------------------------------------------------------------


def test_cast_doubles(spark):
    df = spark.createDataFrame(
        [(0.0, 1.9, 9e10, 0.0, "a")], "a double, b double, adm double, keep double, t string"
    )
    out = cast_doubles_zero_as_missing(df, {"adm": "bigint"}, keep=("keep",))
    assert dict(out.dtypes) == {"a": "int", "b": "int", "adm": "bigint", "keep": "int", "t": "string"}
    assert rows(out) == [(None, 1, 90_000_000_000, 0, "a")]


def test_fill_zero_only_touches_doubles(spark):
    df = spark.createDataFrame([(None, None)], "a double, b int")
    assert rows(fill_zero(df)) == [(0.0, None)]
    ints = df.select("b")
    assert rows(fill_zero(ints)) == [(None,)]


def test_conform_raises_on_misfit(spark):
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(df, T.StructType([T.StructField("a", T.IntegerType())])).collect()


def test_preview(small):
    assert preview(small("orders")).count() == 5


# --- filters ----------------------------------------------------------------------------


def test_stay_filters(spark):
    day = dt.date
    df = spark.createDataFrame(
        [
            ("before", day(2016, 5, 2), day(2016, 5, 1)),
            ("same", day(2016, 5, 1), day(2016, 5, 1)),
            ("open", day(2016, 5, 1), None),
            ("other year", day(2016, 5, 1), day(2017, 1, 1)),
            ("last day", day(2016, 5, 1), day(2016, 12, 31)),
            ("no start", None, day(2016, 6, 1)),
        ],
        "n string, a date, b date",
    )
    year = df.filter(open_or_within_year("b", 2016))
    assert rows(year, "n") == [("before",), ("last day",), ("no start",), ("open",), ("same",)]
    ordered = df.filter(open_or_ordered("a", "b"))
    assert rows(ordered, "n") == [("last day",), ("open",), ("other year",), ("same",)]
    assert rows(df.filter(since("b", day(2016, 12, 31))), "n") == [("last day",), ("other year",)]


def test_serial_filter_agrees_with_date_filter(spark):
    from portolan.functions import serial_day_to_date

    df = spark.range(20000, 21500).select(F.col("id").cast("double").alias("s"))
    extra = spark.createDataFrame([(None,), (0.0,), (-3.0,), (20453.9,), (20819.9,), (float("nan"),), (1e12,)], "s double")
    df = df.unionByName(extra)
    raw = df.filter(serial_open_or_within_year("s", 2016))
    parsed = df.filter(open_or_within_year(serial_day_to_date("s"), 2016))
    assert same_rows(raw, parsed)
    assert raw.count() == 366 + 6


def test_range_filters_reach_the_scan(spark, tmp_path, plan):
    path = str(tmp_path / "t")
    spark.range(10).select(
        F.col("id").cast("double").alias("s"), F.current_date().alias("d")
    ).write.parquet(path)
    df = spark.read.parquet(path)
    for condition, column in (
        (serial_open_or_within_year("s", 2016), "s"),
        (open_or_within_year("d", 2016), "d"),
    ):
        pushed = plan(df.filter(condition)).split("PushedFilters: [")[1]
        assert f"GreaterThanOrEqual({column}" in pushed and f"LessThan({column}" in pushed


def test_exclude_and_unwanted(spark):
    df = spark.createDataFrame(
        [("AAA", "small"), ("0", "small"), ("BBB", "closed"), ("CCC", None), (None, "small"), ("MRE", "big")],
        "code string, type string",
    )
    usable = recorded_and_not(df, {"code": "0", "type": "closed"})
    assert rows(usable) == [("AAA", "small"), ("MRE", "big")]
    assert rows(exclude_values(usable, "code", ["MRE"])) == [("AAA", "small")]
    listed = spark.createDataFrame([("MRE",), ("MRE",), (None,)], "anything string")
    assert rows(exclude_values(df, "code", listed), "code") == [("0",), ("AAA",), ("BBB",), ("CCC",)]
    assert rows(exclude_values(usable, "code", ["MRE", *map(str, range(5000))])) == [("AAA", "small")]


def test_frequent_keys_are_salted_in_one_scan(spark, plan, tmp_path):
    """Facts are read once, and a lookup that repeats the frequent key widely stays exact."""
    n = F.col("id")
    spark.range(60_000).select(F.when(n % 3 == 0, 1).when(n % 7 != 0, n).alias("k"), n.alias("row")).write.parquet(str(tmp_path / "f"))
    facts = spark.read.parquet(str(tmp_path / "f"))
    wide = spark.range(2_000).select((n * 0 + 1).alias("k"), n.alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(facts, wide, ["k"], max_broadcast_bytes=0)
        assert "Broadcast" not in plan(joined) and joined.count() == 20_001 * 2_000
        for how in ("inner", "left", "left_semi", "left_anti"):
            shown = plan(lookup_join(facts, wide.limit(3), ["k"], how, max_broadcast_bytes=0))
            assert shown.count("FileScan") == 1 and "Union" not in shown
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salts_spread_a_frequent_key(spark):
    """Rows of one key, alike in all columns, reach many tasks; so do rows without a key."""
    from portolan.operators.lookup import _SALT

    facts = spark.range(0, 40_000, 1, 8).select(F.when(F.col("id") % 2 == 0, 7).cast("bigint").alias("k"))
    lookup = spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    joined = lookup_join(facts, lookup, ["k"], "left", max_broadcast_bytes=0)
    assert joined.count() == 40_000 and joined.filter("v = 1").count() == 20_000
    text = joined._jdf.queryExecution().optimizedPlan().toString()
    assert _SALT in text and _SALT not in joined.columns


# --- keys -------------------------------------------------------------------------------


def test_dense_key_equals_global_row_number(spark, small):
    lines = small("lineitem")
    for order in (["l_partkey", "l_suppkey"], ["l_suppkey", "l_partkey"]):
        pairs = lines.select(*order).distinct()
        expected = pairs.withColumn("id", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
        assert same_rows(dense_surrogate_key(pairs, order), expected)
        assert same_rows(dense_surrogate_key(pairs.repartition(3), order), expected)
        assert same_rows(dense_surrogate_key(pairs.repartition(1), order), expected)


def test_dense_key_with_one_leading_value(spark):
    df = spark.range(5000).select(F.lit("AA").alias("a"), F.col("id").alias("b"))
    out = dense_surrogate_key(df.repartition(7), ["a", "b"])
    assert out.filter("id <> b + 1").isEmpty() and out.count() == 5000


def test_dense_key_of_nothing(spark):
    df = spark.createDataFrame([], "a string, b string")
    assert rows(dense_surrogate_key(df, ["a", "b"])) == []


def test_dense_key_moves_only_partition_sizes_to_one_task(small, plan):
    pairs = small("lineitem").select("l_partkey", "l_suppkey").distinct()
    text = plan(dense_surrogate_key(pairs, ["l_partkey", "l_suppkey"]))
    main, offsets = text.split("BroadcastExchange", 1)
    assert "SinglePartition" not in main and "Exchange" not in main.replace("AdaptiveSparkPlan", "")
    assert "l_partkey" not in offsets.split("SinglePartition")[0]


def test_dedupe_is_deterministic(spark):
    df = spark.createDataFrame(
        [("k", 2, "b"), ("k", 1, "z"), ("k", 1, "a"), (None, 5, "n"), (None, 4, "n"), ("j", None, None)],
        "k string, v int, w string",
    )
    expected = [("j", None, None), ("k", 1, "a"), (None, 4, "n")]
    for parts in (1, 2, 7):
        assert rows(dedupe(df.repartition(parts), ["k"])) == expected
    assert rows(dedupe(df, ["k"], ["w"])) == expected
    assert rows(dedupe(df.select("k"), ["k"])) == [("j",), ("k",), (None,)]


def test_dedupe_trims_before_the_shuffle(small, plan):
    text = plan(dedupe(small("lineitem"), ["l_returnflag"]))
    assert "WindowGroupLimit" in text.split("Exchange hashpartitioning")[1]


def test_attach_key(spark):
    facts = spark.createDataFrame(
        [(1, "AA", "1"), (2, None, "1"), (3, "AA", None), (4, "ZZ", "9")], "id int, al string, no string"
    )
    dim = spark.createDataFrame([("AA", "1", 7)], "code string, number string, flight_id int")
    on = {"al": "code", "no": "number"}
    assert rows(attach_surrogate_key(facts, dim, on, "flight_id"), "id", "flight_id") == [(1, 7)]
    kept = attach_surrogate_key(facts, dim, on, "flight_id", keep_unmatched=True)
    assert rows(kept, "id", "flight_id") == [(1, 7), (2, None), (3, None), (4, None)]


# --- lookups ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, a tenth without a key, some keys not listed."""
    n = F.col("id")
    facts = spark.range(60_000).select(
        n.alias("row"),
        F.when(n % 3 == 0, F.lit(5)).when(n % 10 != 1, n % 5000).cast("bigint").alias("k"),
        F.when(n % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (n % 50).cast("string"))).alias("m"),
    )
    lookup = spark.range(3, 4000).select(
        F.col("id").alias("k"),
        F.when(F.col("id") == 5, "hot").otherwise(
            F.concat(F.lit("c"), (F.col("id") % 50).cast("string"))
        ).alias("m"),
        (F.col("id") * 2).alias("v"),
    )
    return facts, lookup


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("on", [["k"], ["k", "m"]])
def test_lookup_join_beyond_the_bound(skewed, how, on):
    facts, lookup = skewed
    if on == ["k"]:
        lookup = lookup.drop("m")
    expected = facts.join(lookup, on, how)
    split = lookup_join(facts, lookup, on, how, max_broadcast_bytes=10)
    assert expected.count() > 0
    assert same_rows(expected, split)
    assert same_rows(expected, lookup_join(facts, lookup, on, how))


def test_size_of_a_lookup(spark):
    ids = spark.range(100)
    assert fits_broadcast(ids, 2400) and not fits_broadcast(ids, 2399)
    text = ids.select(F.repeat(F.lit("x"), 50).alias("t"), F.array("id").alias("a"))
    assert fits_broadcast(text, 10_000) and not fits_broadcast(text, 8000)


def test_only_frequent_keys_are_split_off(spark, skewed):
    facts, _ = skewed
    hot = spark.range(1).select(F.xxhash64(F.lit(5).cast("bigint"))).first()[0]
    assert hot in frequent_key_hashes(facts, ["k"])
    # Keys of 1 in 2, 1 in 20 and 1 in 1,000 rows over a long tail of single rows.
    n = F.col("id")
    mixed = spark.range(200_000).select(
        F.when(n % 2 == 0, F.lit(-1)).when(n % 20 == 1, F.lit(-2)).when(n % 1000 == 3, F.lit(-3))
        .otherwise(n).cast("bigint").alias("k")
    )
    hashes = spark.createDataFrame([(-1,), (-2,), (-3,)], "k bigint").select(F.xxhash64("k"))
    assert sorted(frequent_key_hashes(mixed, ["k"])) == sorted(r[0] for r in hashes.collect())
    even = spark.range(100_000).select(F.col("id").alias("k"))
    assert frequent_key_hashes(even, ["k"]) == []


def test_lookup_join_needs_equal_key_types(spark):
    facts = spark.createDataFrame([(1,)], "k int")
    lookup = spark.createDataFrame([(1, 2)], "k bigint, v int")
    with pytest.raises(TypeError):
        lookup_join(facts, lookup, ["k"])
    with pytest.raises(ValueError):
        lookup_join(facts, lookup, ["k"], "full")


def test_valid_or_other(spark):
    df = spark.createDataFrame([("CA",), ("XX",), (None,)], "s string")
    inline = df.select("s", valid_or_other("s", ["CA", "NY"]).alias("v"))
    assert rows(inline) == [("CA", "CA"), ("XX", "99"), (None, "99")]
    listed = spark.createDataFrame([("CA",), ("NY",)], "code string")
    assert rows(valid_or_other_lookup(df, "s", listed)) == [("99",), ("99",), ("CA",)]


@pytest.mark.parametrize("bound", [1000, 0])
def test_match_rate(spark, bound):
    cities = spark.createDataFrame([("A",), ("A",), ("B",), ("C",), (None,)], "c string")
    ports = spark.createDataFrame([("p1", "A"), ("p2", "A"), ("p3", "B"), ("p4", "D")], "code string, name string")
    got = match_rate(cities, F.col("c"), ports, "name", "code", bound)
    assert rows(got) == [("p1", 2), ("p2", 2), ("p3", 1), (None, 2)]
    matched = match_rate(cities.filter("c = 'A'"), F.col("c"), ports, "name", "code", bound)
    assert rows(matched) == [("p1", 2), ("p2", 2)]


# --- rollups ----------------------------------------------------------------------------


def test_calendar(spark):
    day = dt.date
    df = spark.createDataFrame(
        [(day(2016, 1, 1), day(2016, 1, 2)), (day(2016, 1, 2), None), (day(2016, 3, 9), None)], "a date, b date"
    )
    closed = [(day(2016, 1, 1),), (day(2016, 1, 2),)]
    assert rows(distinct_dates(df, "a", "b")) == closed
    assert rows(distinct_dates_sql(df, "a", "b")) == closed
    assert rows(distinct_dates(df, "a", "b", include_open=True)) == closed + [(day(2016, 3, 9),)]
    assert calendar_dimension(df, "a", "b").count() == 2


def test_calendar_scans_once(small, plan):
    lines = small("lineitem").select("l_shipdate", F.col("l_shipdate").alias("end"))
    assert plan(distinct_dates(lines, "l_shipdate", "end")).count("FileScan") == 1


def test_monthly_profile(spark):
    day = dt.date
    df = spark.createDataFrame(
        [
            ("X", day(2001, 2, 1), 4.0, 10.0),
            ("X", day(2002, 2, 1), 6.0, 20.0),
            ("X", day(2001, 7, 1), None, 99.0),
            ("Y", day(2001, 12, 1), 1.0, 5.0),
        ],
        "c string, d date, t double, lat double",
    )
    out = monthly_profile(df, "c", "d", "t", {"lat": "lat"}, prefix="temp_")
    assert len(out.columns) == 14
    got = rows(out, "c", "lat", "temp_february", "temp_july", "temp_december", "temp_march")
    assert got == [("X", 15.0, 5.0, None, None, None), ("Y", 5.0, None, None, 1.0, None)]


def test_category_pivot(spark):
    df = spark.createDataFrame([("s", "a b", 1), ("s", "a b", 2), ("t", "zz", 3)], "k string, c string, v int")
    out = category_pivot(df, ["k"], "c", {"a b": "ab", "never": "n"}, F.col("v"))
    assert rows(out) == [("s", 3, None), ("t", None, None)]


def test_top_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (2,), (3,), (0,), (0,), (0,)], "k int")
    assert [tuple(r) for r in top_duplicates(df, ["k"], 2).collect()] == [(0, 3), (1, 2)]


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, None)], "k int, s string")
    assert rows(table_profile(df)) == [("k", "int", 3, 0, 2), ("s", "string", 3, 2, 2)]
    assert rows(table_profile(df.limit(0))) == [("k", "int", 0, 0, 0), ("s", "string", 0, 0, 0)]
    nested = df.selectExpr("array(s, s) AS a", "cast(s AS binary) AS b")
    assert rows(table_profile(nested), "nulls", "distinct_values") == [(0, 2), (2, 2)]
    assert rows(uniqueness(df, "k")) == [(3, 2, pytest.approx(200 / 3))]
    assert rows(uniqueness(df.limit(0), "k")) == [(0, 0, None)]
    casts = spark.createDataFrame([("1",), ("x",), (None,)], "t string")
    assert rows(rejected_casts(casts, {"t": "int"})) == [("t", "int", 1)]


def test_key_offsets_are_stored(spark, plan):
    keyed = dense_surrogate_key(spark.range(100).repartition(5), ["id"], "n")
    assert "Window" not in plan(keyed) and "Aggregate" not in plan(keyed)
    assert keyed.filter("n <> id + 1").count() == 0
