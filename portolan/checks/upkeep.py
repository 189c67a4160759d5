"""Tables kept up to date: key registries, merged checks, references, summaries, open pivots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan import schema
from portolan.checks.builders import _FACT, _RECORDS, YEAR, _fact, numbered_records, records
from portolan.checks.registry import ORACLES, query, table
from portolan.operators import open_pivot, reference_report
from portolan.operators.check_states import check_state, key_state, merged_report
from portolan.plans import star, summaries
from portolan.plans.analyses import destination_profile, travel_patterns
from portolan.plans.job import check_merged, publish, rerun_months
from portolan.sources import VersionedTable, new_scratch_path, refreshed_copy, write_partitioned
from portolan.sources.scratch import store

_FLIGHT = "airline IS NOT NULL AND fltno IS NOT NULL"


@query(
    f"""
    WITH {_RECORDS},
    early AS (
        SELECT airline, fltno, row_number() OVER (ORDER BY airline, fltno) AS id
        FROM (SELECT DISTINCT airline, fltno FROM r WHERE {_FLIGHT} AND l_orderkey % 3 = 1)),
    late AS (
        SELECT airline, fltno, (SELECT max(id) FROM early) + row_number() OVER (ORDER BY airline, fltno) AS id
        FROM (SELECT DISTINCT airline, fltno FROM r WHERE {_FLIGHT} EXCEPT SELECT airline, fltno FROM early))
    SELECT airline AS airline_code, fltno AS flight_number, CAST(id AS INTEGER) AS flight_id, 1 AS load FROM early
    UNION ALL SELECT airline, fltno, CAST(id AS INTEGER), 2 FROM late
    """
)
def key_registry_two_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Flights of a third of the records, then those of all: ids given first stay."""
    raw = records(spark, folder)
    third = raw.filter(F.floor(F.col("cicid") / 10) % 3 == 1)
    early = store(star.airlines_dimension(third), "airlines")
    late = star.new_airlines(raw, early)
    return early.withColumn("load", F.lit(1)).unionByName(late.withColumn("load", F.lit(2)))


_CHECKS = """
    SELECT 'immigration_ft' AS "table", 'has_rows' AS "check", '*' AS "column", count(*) > 0 AS passed, count(*) AS observed FROM fact
    UNION ALL SELECT 'immigration_ft', 'unique', 'cicid', count(*) = count(DISTINCT cicid), count(*) - count(DISTINCT cicid) FROM fact
    UNION ALL SELECT 'immigration_ft', 'not_null', 'cicid', count(*) = count(cicid), count(*) - count(cicid) FROM fact
    UNION ALL SELECT 'immigration_ft', 'type', name, true, 0 FROM (VALUES ('arr_date'), ('dept_date')) v(name)
"""


@query(f"WITH {_FACT} {_CHECKS}")
def merged_month_checks(spark: SparkSession, folder: str) -> DataFrame:
    """The fact table's gate from the stored states of its months."""
    spec = schema.IMMIGRATION
    fact = _fact(spark, folder)
    states = [store(state(fact, spec.expectations, spec.partition_by), "states") for state in (check_state, key_state)]
    return merged_report(*states, spec.name, spec.expectations)


_ORPHANS = f"""
    WITH {_FACT},
    lost AS (
        SELECT 'res_code' AS "column", CAST(res_code AS VARCHAR) AS value FROM fact WHERE res_code NOT IN (SELECT n_nationkey FROM nation)
        UNION ALL SELECT 'city_code', CAST(city_code AS VARCHAR) FROM fact WHERE city_code NOT IN (SELECT n_nationkey FROM nation)
        UNION ALL SELECT 'flight_id', CAST(flight_id AS VARCHAR) FROM fact WHERE flight_id % 3 = 0
        UNION ALL SELECT 'arr_date', arr_date FROM fact
            WHERE CAST(arr_date AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderkey % 10 = 0)
        UNION ALL SELECT 'port', port FROM fact WHERE port NOT IN ('AF', 'NO')),
    listed AS (SELECT unnest(['res_code', 'city_code', 'flight_id', 'arr_date', 'port']) AS "column")
    SELECT 'immigration_ft' AS "table", l."column", count(DISTINCT value) AS orphan_values, count(value) AS orphan_rows
    FROM listed l LEFT JOIN lost USING ("column") GROUP BY ALL
"""


def _references(spark: SparkSession, folder: str, **bound: int) -> DataFrame:
    raw = records(spark, folder)
    airlines = star.airlines_dimension(raw)
    nations = table(spark, folder, "nation")
    days = table(spark, folder, "orders").filter("o_orderkey % 10 = 0").select(F.to_date("o_orderdate").alias("date_date"))
    ports = spark.createDataFrame([("AF",), ("NO",)], "code string")
    return reference_report(
        store(star.immigration_fact(raw, airlines, YEAR), "fact"),
        {
            "res_code": (nations, "n_nationkey"), "city_code": (nations, "n_nationkey"),
            "flight_id": (airlines.filter("flight_id % 3 <> 0"), "flight_id"),
            "arr_date": (days.distinct(), "date_date"), "port": (ports, "code"),
        },
        "immigration_ft", **bound,
    )


@query(_ORPHANS)
def reference_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """Values of the fact table's references that the dimensions lack."""
    return _references(spark, folder)


@query(_ORPHANS)
def reference_orphans_beyond_the_bound(spark: SparkSession, folder: str) -> DataFrame:
    """The same where no dimension may be broadcast whole: a Bloom filter, then a shuffle."""
    return _references(spark, folder, max_broadcast_bytes=0)


def _summary(spark: SparkSession, folder: str) -> DataFrame:
    """The stored summary of a published fact table, one month of which was published again."""
    root, spec = new_scratch_path(spark, "star"), schema.IMMIGRATION
    raw = numbered_records(spark, folder)
    fact = star.immigration_fact(raw, star.airlines_dimension(raw), YEAR)
    published = publish(fact, spec, root, keep=False)
    summaries.refresh_summary(spark, root)
    month = published.filter((F.col("date_year") == YEAR) & (F.col("date_month") == 3))
    publish(month, spec, root, only_present=True)
    return summaries.refresh_summary(spark, root)


@query(ORACLES["analyse_travel_patterns"])
def travel_patterns_from_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The analysis from counts kept per month, without the fact table."""
    regions = table(spark, folder, "nation").select(F.col("n_nationkey").alias("cit_res_code"), F.col("n_name").alias("cit_res_name"))
    return travel_patterns(_summary(spark, folder), star.modes_dimension(spark), star.visas_dimension(spark), regions, YEAR)


@query(
    f"""
    WITH {_FACT}
    SELECT CASE WHEN addr IN ('CA', 'TX') THEN addr ELSE '99' END AS state_code, CAST(count(*) AS BIGINT) AS travellers
    FROM fact GROUP BY 1
    """
)
def destinations_from_summary(spark: SparkSession, folder: str) -> DataFrame:
    states = spark.createDataFrame([], schema.DEMOGRAPHICS.schema)
    return destination_profile(_summary(spark, folder), states).select("state_code", "travellers")


@query(
    """
    SELECT l_returnflag, sum(l_partkey) FILTER (WHERE l_linenumber % 5 = 1)::BIGINT AS line_1, sum(l_partkey) FILTER (WHERE l_linenumber % 5 = 2)::BIGINT AS line_2,
           sum(l_partkey) FILTER (WHERE l_linenumber % 5 = 3)::BIGINT AS line_3, sum(l_partkey) FILTER (WHERE l_linenumber % 5 = 4)::BIGINT AS line_4,
           sum(l_partkey) FILTER (WHERE l_linenumber % 5 = 0)::BIGINT AS line_null
    FROM lineitem GROUP BY l_returnflag
    """
)
def open_pivot_of_found_values(spark: SparkSession, folder: str) -> DataFrame:
    """Categories found in the data as columns, the null one among them."""
    line = F.nullif(F.col("l_linenumber") % 5, F.lit(0))
    return open_pivot(table(spark, folder, "lineitem").withColumn("line", line), ["l_returnflag"], "line", F.col("l_partkey"), prefix="line_")


@query(
    """
    SELECT l_returnflag, CAST(l_suppkey % 300 AS VARCHAR) AS category, CAST(sum(l_partkey) AS BIGINT) AS total
    FROM lineitem GROUP BY ALL
    """
)
def open_pivot_too_wide(spark: SparkSession, folder: str) -> DataFrame:
    """More categories than columns are wanted: the totals stay rows."""
    lines = table(spark, folder, "lineitem").withColumn("supplier", F.col("l_suppkey") % 300)
    return open_pivot(lines, ["l_returnflag"], "supplier", F.col("l_partkey"), widest=4)


@query(
    f"""
    WITH {_FACT}
    SELECT date_year, date_month, CASE WHEN date_year = {YEAR} AND date_month = 3 THEN 'X' ELSE gender END AS gender,
           count(*) AS "rows", CAST(sum(flight_id) AS BIGINT) AS flight_ids
    FROM fact GROUP BY 1, 2, 3
    """
)
def month_rerun(spark: SparkSession, folder: str) -> DataFrame:
    """The fact table after one of its months was built again from changed records."""
    root, raw = new_scratch_path(spark, "star"), numbered_records(spark, folder)
    airlines = publish(star.airlines_dimension(raw), schema.AIRLINES, root, keep=False)
    publish(star.immigration_fact(raw, airlines, YEAR), schema.IMMIGRATION, root, keep=False)
    month = raw.filter((F.col("i94yr") == YEAR) & (F.col("i94mon") == 3)).withColumn("gender", F.lit("X"))
    fact = rerun_months(month, root, YEAR)
    return fact.groupBy("date_year", "date_month", "gender").agg(F.count("*").alias("rows"), F.sum("flight_id").alias("flight_ids"))


@query(f"WITH {_FACT} {_CHECKS.replace('count(*) - count(DISTINCT cicid)', 'count(*) * 0').replace('count(*) = count(DISTINCT cicid)', 'count(*) >= 0')}")
def merged_checks_after_a_rerun(spark: SparkSession, folder: str) -> DataFrame:
    """The gate of the whole fact table after a month's rerun, from stored states alone."""
    root, raw = new_scratch_path(spark, "star"), numbered_records(spark, folder)
    airlines = publish(star.airlines_dimension(raw), schema.AIRLINES, root, keep=False)
    publish(star.immigration_fact(raw, airlines, YEAR), schema.IMMIGRATION, root, keep=False)
    rerun_months(raw.filter((F.col("i94yr") == YEAR) & (F.col("i94mon") == 3)), root, YEAR)
    return check_merged(spark, root)


@query(
    """
    SELECT o_orderstatus, count(*) AS "rows", CAST(sum(o_custkey) AS BIGINT) AS customers, 2 AS versions
    FROM orders GROUP BY o_orderstatus
    """
)
def copy_follows_source(spark: SparkSession, folder: str) -> DataFrame:
    """A stored copy that is asked for before and after its source changed, and once more."""
    source, copy = new_scratch_path(spark, "source"), new_scratch_path(spark, "copy")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")

    def asked() -> DataFrame:
        return refreshed_copy(spark, copy, spark.read.schema(orders.schema).parquet(source), lambda df: df.drop("o_orderkey"))

    orders.filter("o_orderkey % 2 = 0").write.parquet(source)
    asked()
    orders.filter("o_orderkey % 2 <> 0").write.mode("append").parquet(source)
    asked()
    found = asked()
    versions = VersionedTable(spark, copy).manifest().number
    return found.groupBy("o_orderstatus").agg(F.count("*").alias("rows"), F.sum("o_custkey").alias("customers"), F.lit(versions).alias("versions"))


@query("SELECT l_returnflag, CAST(l_shipdate AS DATE)::VARCHAR AS shipped, count(*) AS \"rows\", CAST(sum(l_partkey) AS BIGINT) AS parts FROM lineitem GROUP BY ALL")
def clustered_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """Rows written in folders, in ranges of day and part within each, and read back."""
    path = new_scratch_path(spark, "clustered")
    lines = table(spark, folder, "lineitem").select("l_returnflag", F.to_date("l_shipdate").alias("day"), "l_partkey")
    write_partitioned(lines, path, ["l_returnflag"], cluster_by=["day", "l_partkey"])
    return spark.read.parquet(path).groupBy("l_returnflag", F.col("day").cast("string").alias("shipped")).agg(
        F.count("*").alias("rows"), F.sum("l_partkey").alias("parts")
    )
