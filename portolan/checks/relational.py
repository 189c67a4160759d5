"""Filters, joins, aggregates, keys and gates on the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portolan.checks.registry import query, table
from portolan.functions.dates import MONTHS
from portolan.functions import place_key, season_of_month, split_pick, to_number, trimmed
from portolan.operators import (
    Expectations,
    attach_surrogate_key,
    calendar_dimension,
    column_range,
    column_summary,
    dedupe,
    dense_surrogate_key,
    distinct_dates_sql,
    distinct_rows,
    duplicate_keys,
    exclude_values,
    group_count,
    lookup_join,
    match_counts,
    match_rate,
    mixed_rollup,
    monthly_profile,
    open_or_ordered,
    open_or_within_year,
    recorded_and_not,
    register_view,
    run_suite,
    since,
    table_profile,
    top_duplicates,
    uniqueness,
    valid_or_other,
    valid_or_other_lookup,
    year_pair_histogram,
)
from portolan.sources import (
    materialize_if_missing,
    new_scratch_path,
    read_code_list,
    read_delimited,
    write_partitioned,
)


@query(
    """
    SELECT p_partkey, p_name, CAST(p_size AS DOUBLE) AS p_size, p_retailprice FROM part
    """
)
def csv_semicolon_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_scratch_path(spark, "parts-csv")
    columns = ["p_partkey", "p_name", "p_size", "p_retailprice"]
    parts = table(spark, folder, "part").select(*columns)
    parts.write.csv(path, sep=";", header=True)
    text = read_delimited(spark, path, sep=";", required=columns)
    return text.select(
        to_number("p_partkey", "bigint").alias("p_partkey"),
        "p_name",
        to_number("p_size").alias("p_size"),
        to_number("p_retailprice").alias("p_retailprice"),
    )


@query(
    """
    SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS code, label
    FROM orders LEFT JOIN (
        SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS list_code,
               substr(o_orderpriority, 3) AS label
        FROM orders WHERE substr(o_orderpriority, 1, 1) <> '3') AS list
      ON CAST(substr(o_orderpriority, 1, 1) AS INTEGER) = list_code
    """
)
def code_list_lookup(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        split_pick("o_orderpriority", "-", 0, "int").alias("code"),
        split_pick("o_orderpriority", "-", 1).alias("label"),
    )
    listed = distinct_rows(orders.filter("code <> 3"), ["code", "label"])
    return lookup_join(orders.drop("label"), listed, ["code"], "left")


def _part_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    pairs = distinct_rows(lines, ["l_partkey", "l_suppkey"]).na.drop()
    return dense_surrogate_key(pairs, ["l_partkey", "l_suppkey"], "pair_id")


@query(
    """
    SELECT l_partkey, l_suppkey, row_number() OVER (ORDER BY l_partkey, l_suppkey) AS pair_id
    FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)
    """
)
def surrogate_key_dim(spark: SparkSession, folder: str) -> DataFrame:
    return _part_suppliers(spark, folder)


_PAIR_FACTS = """
    WITH pairs AS (
        SELECT l_partkey, l_suppkey, row_number() OVER (ORDER BY l_partkey, l_suppkey) AS pair_id
        FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)),
    facts AS (
        SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity,
               CASE WHEN l_returnflag <> 'R' THEN l_partkey END AS l_partkey
        FROM lineitem)
    SELECT f.l_orderkey, f.l_linenumber, f.l_suppkey, f.l_partkey, f.l_quantity, p.pair_id
    FROM facts f {how} JOIN pairs p ON f.l_partkey = p.l_partkey AND f.l_suppkey = p.l_suppkey
"""


def _pair_facts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_quantity",
        F.when(F.col("l_returnflag") != "R", F.col("l_partkey")).alias("l_partkey"),
    )


_PAIR_KEY = {"l_partkey": "l_partkey", "l_suppkey": "l_suppkey"}


@query(_PAIR_FACTS.format(how="INNER"), name="attach_surrogate_key")
def attach_key(spark: SparkSession, folder: str) -> DataFrame:
    pairs = _part_suppliers(spark, folder)
    return attach_surrogate_key(_pair_facts(spark, folder), pairs, _PAIR_KEY, "pair_id")


@query(_PAIR_FACTS.format(how="LEFT"), name="attach_surrogate_key_keep_unmatched")
def attach_key_keep_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    pairs = _part_suppliers(spark, folder)
    return attach_surrogate_key(
        _pair_facts(spark, folder), pairs, _PAIR_KEY, "pair_id", keep_unmatched=True
    )


@query(_PAIR_FACTS.format(how="LEFT"), name="attach_surrogate_key_large_dimension")
def attach_key_large_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """The join as it runs when the dimension is beyond the broadcast bound."""
    pairs = _part_suppliers(spark, folder)
    return attach_surrogate_key(
        _pair_facts(spark, folder),
        pairs,
        _PAIR_KEY,
        "pair_id",
        keep_unmatched=True,
        max_broadcast_bytes=0,
    )


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'O' THEN strftime(o_orderdate, '%Y-%m-%d') END AS ended
    FROM orders WHERE o_orderstatus = 'O' OR year(o_orderdate) = 1998
    """
)
def year_or_open_filter(spark: SparkSession, folder: str) -> DataFrame:
    ended = F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate").cast("date"))
    orders = table(spark, folder, "orders").select("o_orderkey", ended.alias("ended"))
    kept = orders.filter(open_or_within_year("ended", 1998))
    return kept.withColumn("ended", F.col("ended").cast("string"))


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN l_linestatus <> 'O' THEN date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) END AS days
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_linestatus = 'O'
       OR date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) >= 0
    """
)
def interval_sanity_filter(spark: SparkSession, folder: str) -> DataFrame:
    started = F.col("o_orderdate").cast("date")
    ended = F.when(F.col("l_linestatus") != "O", F.col("l_shipdate").cast("date"))
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"
    )
    return (
        lines.join(orders, "l_orderkey")
        .filter(open_or_ordered(started, ended))
        .select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            F.datediff(ended, started).cast("bigint").alias("days"),
        )
    )


@query(
    """
    SELECT CAST(d AS VARCHAR) AS date_date, CAST(day(d) AS INTEGER) AS day,
           CAST(weekofyear(d) AS INTEGER) AS week, CAST(month(d) AS INTEGER) AS month,
           strftime(d, '%B') AS month_name, CAST(year(d) AS INTEGER) AS year,
           CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, strftime(d, '%a') AS day_of_week_name
    FROM (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE l_linestatus = 'F'
          UNION
          SELECT CAST(l_shipdate AS DATE) - CAST(l_quantity AS INTEGER) FROM lineitem WHERE l_linestatus = 'F')
    """
)
def calendar_dim(spark: SparkSession, folder: str) -> DataFrame:
    shipped = F.col("l_shipdate").cast("date")
    stays = table(spark, folder, "lineitem").select(
        F.date_sub(shipped, F.col("l_quantity").cast("int")).alias("started"),
        F.when(F.col("l_linestatus") == "F", shipped).alias("ended"),
    )
    calendar = calendar_dimension(stays, "started", "ended")
    return calendar.withColumn("date_date", F.col("date_date").cast("string"))


@query(
    """
    SELECT DISTINCT CAST(d AS VARCHAR) AS date_date
    FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderstatus <> 'O'
          UNION ALL
          SELECT CAST(o_orderdate AS DATE) + 30 FROM orders WHERE o_orderstatus <> 'O')
    """
)
def sql_view_union(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    stays = table(spark, folder, "orders").select(
        day.alias("started"),
        F.when(F.col("o_orderstatus") != "O", F.date_add(day, 30)).alias("ended"),
    )
    view = register_view(distinct_dates_sql(stays, "started", "ended"), "stay_dates")
    return spark.sql(f"SELECT CAST(date_date AS STRING) AS date_date FROM {view}")


_MONTHS = [name.lower() for name in MONTHS]


@query(
    f"""
    WITH monthly AS (
        SELECT upper(n_name) AS nation, month(o_orderdate) AS m, avg(round(o_totalprice * 100)) AS cents,
               avg(CAST(o_custkey AS DOUBLE)) AS cust
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        WHERE o_orderdate >= DATE '1996-01-01' GROUP BY 1, 2)
    SELECT nation, arg_min(cust, m) AS first_customer,
           {", ".join(f"max(CASE WHEN m = {i} THEN cents END) AS cents_{name}"
                      for i, name in enumerate(_MONTHS, 1))}
    FROM monthly GROUP BY nation
    """
)
def monthly_profile_pivot(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").filter(since("o_orderdate", dt.date(1996, 1, 1)))
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")
    )
    nations = table(spark, folder, "nation").select("n_nationkey", F.upper("n_name").alias("nation"))
    located = lookup_join(
        lookup_join(orders, customers, ["o_custkey"]), nations, ["n_nationkey"]
    )
    # Whole cents, so that sums are exact and means do not depend on the order of rows.
    return monthly_profile(
        located,
        "nation",
        "o_orderdate",
        F.round(F.col("o_totalprice") * 100),
        {"first_customer": F.col("o_custkey").cast("double")},
        prefix="cents_",
    )


@query(
    """
    SELECT p_brand, avg(CAST(p_size AS DOUBLE)) AS mean_size, CAST(sum(p_partkey) AS BIGINT) AS part_keys
    FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, p_type
                                       ORDER BY p_partkey, p_name, p_size, p_retailprice) AS r FROM part)
    WHERE r = 1 GROUP BY p_brand
    """
)
def dedupe_mixed_agg(spark: SparkSession, folder: str) -> DataFrame:
    parts = dedupe(table(spark, folder, "part"), ["p_brand", "p_type"])
    rollup = mixed_rollup(
        parts, ["p_brand"], means={"mean_size": "p_size"}, sums={"part_keys": "p_partkey"}
    )
    return rollup


@query(
    """
    SELECT l_suppkey, sum(l_quantity) AS quantity, CAST(sum(l_linenumber) AS BIGINT) AS line_numbers,
           sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS accepted,
           sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS not_returned,
           sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS returned
    FROM lineitem GROUP BY l_suppkey
    """
)
def category_pivot_sum(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    names = {"A": "accepted", "N": "not_returned", "R": "returned"}
    by_flag = {name: F.when(F.col("l_returnflag") == flag, F.col("l_quantity")) for flag, name in names.items()}
    return mixed_rollup(
        lines, ["l_suppkey"], sums={"quantity": "l_quantity", "line_numbers": "l_linenumber", **by_flag}
    )


@query(
    """
    SELECT p_partkey, brand, p_type
    FROM (SELECT p_partkey, p_type, CASE WHEN p_size <> 7 THEN split_part(p_brand, '#', 2) END AS brand FROM part)
    WHERE brand <> '1' AND p_type <> 'PROMO' AND brand NOT IN ('3', '5', '8', '13')
    """
)
def exclude_list_filter(spark: SparkSession, folder: str) -> DataFrame:
    brand = F.when(F.col("p_size") != 7, split_pick("p_brand", "#", 1)).alias("brand")
    parts = table(spark, folder, "part").select("p_partkey", brand, "p_type")
    usable = recorded_and_not(parts, {"brand": "1", "p_type": "PROMO"})
    return exclude_values(usable, "brand", ["3", "5", "8", "13"])


@query(
    """
    SELECT l_orderkey, l_linenumber, l_suppkey
    FROM (SELECT l_orderkey, l_linenumber,
                 CASE WHEN l_returnflag <> 'R' THEN l_suppkey END AS l_suppkey FROM lineitem)
    WHERE l_suppkey IS NOT NULL
      AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)
    """
)
def exclude_table_filter(spark: SparkSession, folder: str) -> DataFrame:
    listed = table(spark, folder, "supplier").filter("s_acctbal < 0").select("s_suppkey")
    supplier = F.when(F.col("l_returnflag") != "R", F.col("l_suppkey")).alias("l_suppkey")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", supplier)
    return exclude_values(lines, "l_suppkey", listed).select(
        "l_orderkey", "l_linenumber", "l_suppkey"
    )


@query(
    """
    SELECT s_suppkey AS code, CAST(sum(n) AS BIGINT) AS count
    FROM (SELECT concat(upper(split_part(c_mktsegment, 'I', 1)), ', ', c_custkey % 50) AS port_name, count(*) AS n
          FROM customer GROUP BY 1) c
    LEFT JOIN (SELECT s_suppkey, concat(CASE WHEN s_nationkey < 12 THEN 'BU' ELSE 'AUTOMOB' END, ', ', s_suppkey % 60) AS port_name
               FROM supplier) s USING (port_name)
    GROUP BY s_suppkey
    """
)
def text_key_match_rate(spark: SparkSession, folder: str) -> DataFrame:
    cities = table(spark, folder, "customer").select(
        F.lower(split_pick("c_mktsegment", "I", 0)).alias("city"),
        (F.col("c_custkey") % 50).cast("string").alias("state"),
    )
    word = F.when(F.col("s_nationkey") < 12, "  BU, ").otherwise("AUTOMOB, ")
    padded = F.concat(word, (F.col("s_suppkey") % 60).cast("string"), F.lit("   "))
    ports = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("code"), trimmed(padded).alias("port_name")
    )
    return match_rate(cities, place_key("city", "state"), ports, "port_name", "code")


@query(
    """
    SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY 3 DESC, 1, 2 LIMIT 10
    """
)
def duplicate_key_topk(spark: SparkSession, folder: str) -> DataFrame:
    return top_duplicates(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], 10)


@query(
    """
    SELECT l_partkey, count(*) AS count FROM lineitem
    GROUP BY 1 HAVING count(*) > 1 ORDER BY 1 LIMIT 50
    """
)
def duplicate_key_first(spark: SparkSession, folder: str) -> DataFrame:
    repeated = duplicate_keys(table(spark, folder, "lineitem"), ["l_partkey"])
    return repeated.orderBy("l_partkey").limit(50)


@query(
    """
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') ORDER BY o_orderkey
    """
)
def listed_rows_sorted(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return (
        orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
        .orderBy("o_orderkey")
        .select("o_orderkey", "o_orderstatus", "o_orderpriority")
    )


@query(
    """
    SELECT CAST(year(l_shipdate) AS INTEGER) AS end_year, CAST(year(o_orderdate) AS INTEGER) AS start_year,
           count(*) AS count
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2
    """,
    name="year_pair_histogram",
)
def year_pair_counts(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"
    )
    joined = lines.join(orders, "l_orderkey")
    return year_pair_histogram(joined, "l_shipdate", "o_orderdate")


@query("SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def group_row_count(spark: SparkSession, folder: str) -> DataFrame:
    return group_count(table(spark, folder, "events"), ["event_type"])


@query(
    """
    SELECT count(*) AS "rows", count(DISTINCT o_custkey) AS distinct_values,
           count(DISTINCT o_custkey) / count(*) * 100 AS unique_percent
    FROM orders
    """
)
def key_uniqueness(spark: SparkSession, folder: str) -> DataFrame:
    return uniqueness(table(spark, folder, "orders"), "o_custkey")


@query("SELECT min(o_totalprice) AS min_value, max(o_totalprice) AS max_value FROM orders")
def value_range(spark: SparkSession, folder: str) -> DataFrame:
    return column_range(table(spark, folder, "orders"), "o_totalprice")


_PROFILED = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "open_priority": "string",
}


@query(
    "WITH o AS (SELECT * EXCLUDE (o_orderpriority), CASE WHEN o_orderstatus = 'O'"
    " THEN o_orderpriority END AS open_priority FROM orders) "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{t}' AS "type", count(*) AS "rows", count(*) - count({c}) AS nulls,
            count(DISTINCT {c}) + CASE WHEN count(*) > count({c}) THEN 1 ELSE 0 END AS distinct_values FROM o"""
        for c, t in _PROFILED.items()
    ),
    name="table_profile",
)
def profile_of_table(spark: SparkSession, folder: str) -> DataFrame:
    open_priority = F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority"))
    orders = table(spark, folder, "orders").withColumn("open_priority", open_priority)
    return table_profile(orders.drop("o_orderpriority"))


@query(
    """
    SELECT 'l_quantity' AS "column", count(l_quantity) AS count, round(avg(l_quantity), 6) AS mean,
           round(stddev_samp(l_quantity), 6) AS stddev, CAST(min(l_quantity) AS VARCHAR) AS min,
           CAST(max(l_quantity) AS VARCHAR) AS max FROM lineitem
    UNION ALL
    SELECT 'l_linenumber', count(l_linenumber), round(avg(l_linenumber), 6),
           round(stddev_samp(l_linenumber), 6), CAST(min(l_linenumber) AS VARCHAR),
           CAST(max(l_linenumber) AS VARCHAR) FROM lineitem
    UNION ALL
    SELECT 'l_returnflag', count(l_returnflag), NULL, NULL, min(l_returnflag), max(l_returnflag) FROM lineitem
    """
)
def summary_statistics(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_quantity", "l_linenumber", "l_returnflag")
    summary = column_summary(lines)
    return summary.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@query(
    """
    WITH l AS (SELECT *, CASE WHEN l_returnflag <> 'R' THEN l_partkey END AS part FROM lineitem)
    SELECT 'lineitem' AS "table", 'has_rows' AS "check", '*' AS "column", count(*) > 0 AS passed, count(*) AS observed FROM l
    UNION ALL SELECT 'lineitem', 'unique', 'l_orderkey,l_linenumber',
        count(*) = count(DISTINCT (l_orderkey, l_linenumber)), count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM l
    UNION ALL SELECT 'lineitem', 'not_null', 'part', count(*) = count(part), count(*) - count(part) FROM l
    UNION ALL SELECT 'lineitem', 'not_null', 'l_suppkey', count(*) = count(l_suppkey), count(*) - count(l_suppkey) FROM l
    UNION ALL SELECT 'orders', 'has_rows', '*', count(*) > 0, count(*) FROM orders
    UNION ALL SELECT 'orders', 'unique', 'o_orderkey', count(*) = count(DISTINCT o_orderkey), count(*) - count(DISTINCT o_orderkey) FROM orders
    UNION ALL SELECT 'orders', 'type', 'o_orderdate', false, 1
    UNION ALL SELECT 'orders', 'type', 'o_totalprice', true, 0
    UNION ALL SELECT 'orders', 'type', 'o_absent', false, 1
    UNION ALL SELECT 'customer', 'has_rows', '*', count(*) > 0, count(*) FROM customer
    UNION ALL SELECT 'customer', 'unique', 'c_nationkey', count(*) = count(DISTINCT c_nationkey), count(*) - count(DISTINCT c_nationkey) FROM customer
    """
)
def quality_suite(spark: SparkSession, folder: str) -> DataFrame:
    part = F.when(F.col("l_returnflag") != "R", F.col("l_partkey"))
    lines = table(spark, folder, "lineitem").withColumn("part", part)
    return run_suite(
        {
            "lineitem": (
                lines,
                Expectations(
                    unique=(("l_orderkey", "l_linenumber"),), not_null=("part", "l_suppkey")
                ),
            ),
            "orders": (
                table(spark, folder, "orders"),
                Expectations(
                    unique=(("o_orderkey",),),
                    types={
                        "o_orderdate": T.DateType(),
                        "o_totalprice": T.DoubleType(),
                        "o_absent": T.DoubleType(),
                    },
                ),
            ),
            "customer": (
                table(spark, folder, "customer"),
                Expectations(unique=(("c_nationkey",),)),
            ),
        }
    )


@query(
    """
    SELECT CAST(year(l_shipdate) AS INTEGER) AS date_year, CAST(month(l_shipdate) AS INTEGER) AS date_month,
           count(*) AS source_rows, count(*) AS written_rows, true AS matched
    FROM lineitem GROUP BY 1, 2
    """
)
def source_output_match(spark: SparkSession, folder: str) -> DataFrame:
    path = new_scratch_path(spark, "lines-by-month")
    by = ["date_year", "date_month"]
    lines = table(spark, folder, "lineitem").withColumns(
        {"date_year": F.year("l_shipdate"), "date_month": F.month("l_shipdate")}
    )
    write_partitioned(lines, path, by)
    return match_counts(lines, spark.read.parquet(path), by)


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def convert_once(spark: SparkSession, folder: str) -> DataFrame:
    path = new_scratch_path(spark, "customers")
    wanted = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    materialize_if_missing(spark, path, lambda: wanted)
    return materialize_if_missing(spark, path, lambda: wanted.limit(0))


@query(
    """
    SELECT c_custkey,
           CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_mktsegment ELSE '99' END AS segment,
           CASE WHEN n_nationkey IS NOT NULL AND c_acctbal >= 0 THEN 'N' || n_nationkey ELSE '99' END AS nation
    FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON c_nationkey = n_nationkey
    """
)
def valid_code_or_other(spark: SparkSession, folder: str) -> DataFrame:
    code = F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))
    customers = table(spark, folder, "customer").select(
        "c_custkey",
        valid_or_other("c_mktsegment", ["BUILDING", "MACHINERY"]).alias("segment"),
        F.when(F.col("c_acctbal") >= 0, code).alias("nation"),
    )
    listed = table(spark, folder, "nation").filter("n_regionkey < 3").select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))
    )
    return valid_or_other_lookup(customers, "nation", listed)


@query(
    """
    SELECT r_name, n_name, o_orderpriority,
           CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter' WHEN month(o_orderdate) <= 5 THEN 'spring'
                WHEN month(o_orderdate) <= 8 THEN 'summer' ELSE 'autumn' END AS season,
           count(*) AS line_count,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(12, 2)) * (1 - CAST(l_discount AS DECIMAL(4, 2)))) AS DOUBLE) AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY 1, 2, 3, 4
    """
)
def star_join_analysis(spark: SparkSession, folder: str) -> DataFrame:
    """Lines are summed per order, then per customer, before each join.

    Prices are summed exactly: as whole ten-thousandths, then per nation as decimals.
    """
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    percent_kept = F.lit(100) - F.round(F.col("l_discount") * 100).cast("bigint")
    per_order = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(cents * percent_kept).alias("revenue"), F.count("*").alias("line_count")
    )
    totals = [F.sum("revenue").alias("revenue"), F.sum("line_count").alias("line_count")]
    per_customer = (
        table(spark, folder, "orders")
        .join(per_order, "o_orderkey")
        .groupBy(
            F.col("o_custkey").alias("c_custkey"),
            "o_orderpriority",
            season_of_month(F.month("o_orderdate")).alias("season"),
        )
        .agg(*totals)
    )
    per_nation = (
        per_customer.join(table(spark, folder, "customer"), "c_custkey")
        .withColumn("revenue", F.col("revenue").cast("decimal(28,0)"))
        .groupBy(F.col("c_nationkey").alias("n_nationkey"), "o_orderpriority", "season")
        .agg(*totals)
    )
    return (
        per_nation.join(table(spark, folder, "nation"), "n_nationkey")
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name", "n_name", "o_orderpriority", "season")
        .agg(
            F.sum("line_count").alias("line_count"),
            (F.sum("revenue") / 10000).cast("double").alias("revenue"),
        )
    )


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def csv_folder_of_files(spark: SparkSession, folder: str) -> DataFrame:
    """Several files with one header each, read as one table."""
    path = new_scratch_path(spark, "orders-csv")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    orders.repartition(4).write.csv(path, header=True)
    return read_delimited(spark, path, required=["o_totalprice"]).select(
        to_number("o_orderkey", "bigint").alias("o_orderkey"), "o_orderstatus", to_number("o_totalprice").alias("o_totalprice")
    )


@query("SELECT CAST(n_nationkey AS INTEGER) AS code, n_name || ' ' AS name FROM nation")
def code_list_from_text(spark: SparkSession, folder: str) -> DataFrame:
    path = new_scratch_path(spark, "nation-list")
    padded = F.concat("n_name", F.lit(" ")).alias("label")
    table(spark, folder, "nation").select(F.col("n_nationkey").alias("value"), padded).write.csv(
        path, header=True, ignoreTrailingWhiteSpace=False
    )
    return read_code_list(spark, path, "code", "name", "int")


@query(
    """
    WITH t AS (
        SELECT CASE p_partkey % 7 WHEN 0 THEN chr(9) || '12' WHEN 1 THEN 'word' WHEN 2 THEN '+3.5' WHEN 3 THEN '-2'
                                  WHEN 4 THEN '.25' WHEN 5 THEN '1e3' END AS text,
               CASE p_partkey % 7 WHEN 0 THEN 12 WHEN 2 THEN 3.5 WHEN 3 THEN -2 WHEN 4 THEN 0.25 WHEN 5 THEN 1000 END AS number
        FROM part)
    SELECT count(text) AS count, CAST(avg(CAST(number AS DOUBLE)) AS DOUBLE) AS mean, min(text) AS min, max(text) AS max FROM t
    """
)
def summary_of_text_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers among text, in every spelling that a cast takes."""
    spelt = F.element_at(F.array(*[F.lit(v) for v in ("\t12", "word", "+3.5", "-2", ".25", "1e3", None)]), (F.col("p_partkey") % 7 + 1).cast("int"))
    return column_summary(table(spark, folder, "part").select(spelt.alias("text"))).select("count", "mean", "min", "max")


@query(
    """
    SELECT l_orderkey, l_linenumber, p_brand
    FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_partkey END AS k FROM lineitem)
    LEFT JOIN part ON p_partkey = k
    """
)
def lookup_join_frequent_key(spark: SparkSession, folder: str) -> DataFrame:
    """A lookup beyond the broadcast bound, with a third of the facts on one key."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("l_partkey").cast("bigint")).alias("k"),
    )
    parts = table(spark, folder, "part").select(F.col("p_partkey").cast("bigint").alias("k"), "p_brand")
    return lookup_join(lines, parts, ["k"], "left", max_broadcast_bytes=0).drop("k")
