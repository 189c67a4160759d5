"""Column functions on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.checks.registry import query, table
from portolan.functions import (
    hemisphere_coordinate,
    null_to,
    parse_date,
    sentinel_date,
    serial_day_to_date,
    serial_day_to_timestamp,
    split_pick,
    to_number,
)
from portolan.functions.dates import date_to_serial_day
from portolan.operators import cast_doubles_zero_as_missing, fill_zero, project, rejected_casts


@query(
    """
    SELECT n_nationkey AS cit_res_code, n_name AS cit_res_name, n_regionkey AS area_code
    FROM nation
    """
)
def scan_project_rename(spark: SparkSession, folder: str) -> DataFrame:
    return project(
        table(spark, folder, "nation"),
        {"cit_res_code": "n_nationkey", "cit_res_name": "n_name", "area_code": "n_regionkey"},
    )


@query(
    """
    SELECT o_orderkey,
           CAST(CASE WHEN o_orderkey % 10 > 1
                     THEN DATE '1960-01-01' + CAST(date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) AS INTEGER)
                END AS VARCHAR) AS day,
           CASE WHEN o_orderkey % 10 > 1
                THEN strftime(CAST(o_orderdate AS DATE) + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S')
           END AS moment,
           CAST(CASE WHEN o_orderkey % 10 = 1 THEN 0.0
                     WHEN o_orderkey % 10 = 0 THEN -1.0
                     ELSE date_diff('day', DATE '1960-01-01', CAST(o_orderdate AS DATE)) + 0.25
                END AS DOUBLE) AS serial_or_zero
    FROM orders
    """,
    name="serial_day_to_date",
)
def serial_day_conversion(spark: SparkSession, folder: str) -> DataFrame:
    digit = F.col("o_orderkey") % 10
    serial = (
        F.when(digit > 1, date_to_serial_day("o_orderdate") + 0.25).when(digit == 0, F.lit(-1.0))
    )
    return table(spark, folder, "orders").select(
        "o_orderkey",
        serial_day_to_date(serial).cast("string").alias("day"),
        F.date_format(serial_day_to_timestamp(serial), "yyyy-MM-dd HH:mm:ss").alias("moment"),
        null_to(serial, 0.0).alias("serial_or_zero"),
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CAST(trunc(NULLIF(l_quantity, 0)) AS INTEGER) AS l_quantity,
           CAST(trunc(NULLIF(l_extendedprice, 0)) AS BIGINT) AS l_extendedprice,
           CAST(trunc(NULLIF(l_discount, 0)) AS INTEGER) AS l_discount,
           CAST(trunc(l_tax) AS INTEGER) AS l_tax
    FROM lineitem
    """
)
def zero_to_null_int(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").drop("l_returnflag", "l_linestatus", "l_shipdate")
    return cast_doubles_zero_as_missing(rows, {"l_extendedprice": "bigint"}, keep=("l_tax",))


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN l_returnflag = 'R' THEN 0.0 ELSE l_quantity END AS quantity,
           CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_linestatus END AS status
    FROM lineitem
    """
)
def fill_null_zero(spark: SparkSession, folder: str) -> DataFrame:
    returned = F.col("l_returnflag") == "R"
    return fill_zero(
        table(spark, folder, "lineitem").select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            F.when(~returned, F.col("l_quantity")).alias("quantity"),
            F.when(~returned, F.col("l_linestatus")).alias("status"),
        )
    )


@query(
    """
    SELECT p_partkey, split_part(p_brand, '#', 1) AS brand_word,
           CAST(split_part(p_brand, '#', 2) AS INTEGER) AS brand_number,
           CAST(split_part(p_brand, '#', 2) AS DOUBLE) AS brand_value,
           CAST(NULL AS VARCHAR) AS out_of_range
    FROM part
    """
)
def split_pick_typed(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        "p_partkey",
        split_pick("p_brand", "#", 0).alias("brand_word"),
        split_pick("p_brand", "#", 1, "int").alias("brand_number"),
        split_pick("p_brand", "#", 1, "float").alias("brand_value"),
        split_pick("p_brand", "#", 2).alias("out_of_range"),
    )


@query(
    """
    SELECT c_custkey,
           CAST(CASE WHEN c_custkey % 7 = 0 THEN 0.0
                     WHEN c_custkey % 11 = 0 THEN NULL
                     WHEN c_acctbal < 0 THEN -(c_custkey % 90 + 0.25) ELSE c_custkey % 90 + 0.25
                END AS DOUBLE) AS latitude
    FROM customer
    """,
    name="hemisphere_coordinate",
)
def hemisphere_coordinates(spark: SparkSession, folder: str) -> DataFrame:
    number = F.concat((F.col("c_custkey") % 90).cast("string"), F.lit(".25"))
    text = (
        F.when(F.col("c_custkey") % 7 == 0, number)
        .when(F.col("c_custkey") % 11 == 0, F.lit(None))
        .when(F.col("c_acctbal") < 0, F.concat(number, F.lit("S")))
        .otherwise(F.concat(number, F.lit("N")))
    )
    return table(spark, folder, "customer").select(
        "c_custkey", hemisphere_coordinate(text).alias("latitude")
    )


@query(
    """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') END AS day,
           o_orderstatus = 'O' AS is_sentinel,
           strftime(o_orderdate, '%Y-%m-%d') AS plain_day
    FROM orders
    """
)
def sentinel_date_parse(spark: SparkSession, folder: str) -> DataFrame:
    text = F.date_format("o_orderdate", "ddMMyyyy")
    marked = (
        F.when(F.col("o_orderstatus") == "O", "D/S")
        .when(F.col("o_orderstatus") == "F", text)
        .otherwise("not a date")
    )
    day, is_sentinel = sentinel_date(marked, "ddMMyyyy")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        day.cast("string").alias("day"),
        is_sentinel.alias("is_sentinel"),
        parse_date(F.date_format("o_orderdate", "yyyy-MM-dd")).cast("string").alias("plain_day"),
    )


@query(
    """
    SELECT p_partkey, CASE WHEN p_size > 25 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS size_number
    FROM part
    """
)
def text_to_number(spark: SparkSession, folder: str) -> DataFrame:
    text = F.when(F.col("p_size") > 25, "n/a").otherwise(F.concat(F.lit(" "), F.col("p_size")))
    return table(spark, folder, "part").select("p_partkey", to_number(text).alias("size_number"))


@query(
    """
    SELECT 'p_brand' AS "column", 'double' AS "type", count(*) AS rejected FROM part
    UNION ALL
    SELECT 'p_retailprice', 'tinyint',
           CAST(count(*) FILTER (WHERE trunc(p_retailprice) > 127) AS BIGINT) FROM part
    """
)
def rejected_cast_counts(spark: SparkSession, folder: str) -> DataFrame:
    return rejected_casts(
        table(spark, folder, "part"), {"p_brand": "double", "p_retailprice": "tinyint"}
    )
