"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per query after one warm-up (default 3); the median counts

``--compare`` instead times each rewrite beside the plain form it replaces.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from portolan.checks import QUERIES  # noqa: E402

HEADLINE = (
    "build_immigration_fact",
    "build_airlines",
    "build_airports",
    "build_dates",
    "build_regions",
    "build_demographics",
    "analyse_travel_patterns",
    "surrogate_key_dim",
    "attach_surrogate_key",
    "attach_surrogate_key_large_dimension",
    "zero_to_null_int",
    "serial_day_to_date",
    "split_pick_typed",
    "hemisphere_coordinate",
    "sentinel_date_parse",
    "interval_sanity_filter",
    "year_or_open_filter",
    "calendar_dim",
    "monthly_profile_pivot",
    "dedupe_mixed_agg",
    "category_pivot_sum",
    "exclude_table_filter",
    "text_key_match_rate",
    "duplicate_key_topk",
    "year_pair_histogram",
    "table_profile",
    "summary_statistics",
    "quality_suite",
    "source_output_match",
    "csv_semicolon_roundtrip",
    "star_join_analysis",
)


def session(cpus: int) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("portolan-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def median_seconds(build: Callable[[], DataFrame], runs: int) -> float:
    run(build())
    times: list[float] = []
    for _ in range(runs):
        start = time.perf_counter()
        run(build())
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def plain_forms(spark: SparkSession, folder: str) -> dict[str, tuple[Callable, Callable]]:
    """Name to (this library's form, the plain form)."""
    from portolan.functions import hemisphere_coordinate, serial_day_to_date
    from portolan.functions.dates import date_to_serial_day
    from portolan.operators import Expectations, dense_surrogate_key, run_checks

    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    pairs = lines.select("l_partkey", "l_suppkey").distinct()
    serials = lines.select(date_to_serial_day("l_shipdate").alias("s"))
    places = lines.select(F.concat((F.col("l_partkey") % 90).cast("string"), F.lit(".5S")).alias("t"))
    pair = ["l_partkey", "l_suppkey"]

    @F.udf("date")
    def python_date(s):
        import datetime

        return datetime.date(1960, 1, 1) + datetime.timedelta(days=s) if s > 0 else None

    @F.udf("double")
    def python_coordinate(t):
        number = float(t.strip("NSEW"))
        return -number if t[-1] in "SW" else number

    def checks_one_by_one() -> DataFrame:
        orders.count()
        orders.dropDuplicates(["o_orderkey"]).count()
        orders.filter("o_orderkey IS NULL").count()
        return orders.groupBy().count()

    expected = Expectations(unique=(("o_orderkey",),), not_null=("o_orderkey",))
    by_flag = lines.groupBy("l_suppkey")
    return {
        "dense key vs one global window": (
            lambda: dense_surrogate_key(pairs, pair),
            lambda: pairs.withColumn("id", F.row_number().over(Window.orderBy(*pair))),
        ),
        "serial date: expression vs Python UDF": (
            lambda: serials.select(serial_day_to_date("s")),
            lambda: serials.select(python_date("s")),
        ),
        "coordinate: expression vs Python UDF": (
            lambda: places.select(hemisphere_coordinate("t")),
            lambda: places.select(python_coordinate("t")),
        ),
        "checks in one pass vs one job each": (
            lambda: run_checks(orders, "orders", expected),
            checks_one_by_one,
        ),
        "pivot with declared vs discovered values": (
            lambda: by_flag.pivot("l_returnflag", ["A", "N", "R"]).agg(F.sum("l_quantity")),
            lambda: by_flag.pivot("l_returnflag").agg(F.sum("l_quantity")),
        ),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(int(os.environ.get("BENCH_CPUS", "8")))
    if "--compare" in sys.argv:
        for name, (ours, plain) in plain_forms(spark, folder).items():
            print(f"{name}: {median_seconds(ours, runs)} s vs {median_seconds(plain, runs)} s", flush=True)
        return
    times = {n: median_seconds(lambda n=n: QUERIES[n](spark, folder), runs) for n in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
