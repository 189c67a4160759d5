"""Star-schema builders on raw inputs that are derived from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portolan.checks.registry import ORACLES, query, table
from portolan.functions.dates import MONTHS, date_to_serial_day
from portolan.operators.keys import dense_surrogate_key
from portolan.operators.quality import REPORTED
from portolan.plans import star
from portolan.plans.analyses import destination_profile, travel_patterns
from portolan.plans.job import Sources, build_star, check_star
from portolan.sources import new_scratch_path

YEAR = 1998


def _text(column: Column) -> Column:
    return column.cast("string")


def records(spark: SparkSession, folder: str) -> DataFrame:
    """Line items in the layout of entry/exit records, with nulls, zeros and bad stays."""
    key, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    supplier, quantity = F.col("l_suppkey"), F.col("l_quantity")
    departed = date_to_serial_day("l_shipdate")
    arrived = departed - part % 40 + 5
    arrived_on = F.date_add(F.col("l_shipdate").cast("date"), (F.lit(5) - part % 40).cast("int"))
    return table(spark, folder, "lineitem").select(
        (key * 10 + line).cast("double").alias("cicid"),
        F.year(arrived_on).cast("double").alias("i94yr"),
        F.month(arrived_on).cast("double").alias("i94mon"),
        (supplier % 30).cast("double").alias("i94cit"),
        (part % 30).cast("double").alias("i94res"),
        F.concat("l_returnflag", "l_linestatus").alias("i94port"),
        (arrived + 0.5).alias("arrdate"),
        (line % 4).cast("double").alias("i94mode"),
        F.when(part % 5 == 0, "CA").when(part % 5 == 1, "TX").otherwise("ZZ").alias("i94addr"),
        F.when(F.col("l_returnflag") == "N", F.lit(None))
        # None of these is a day, so that all of them are open stays.
        .when((F.col("l_returnflag") == "R") & (part % 3 == 0), F.lit(float("nan")))
        .when((F.col("l_returnflag") == "R") & (part % 3 == 1), F.lit(1e12))
        .when(F.col("l_returnflag") == "R", F.lit(0.0))
        .otherwise(departed + 0.25)
        .alias("depdate"),
        (quantity - 1).alias("i94bir"),
        (line % 5).cast("double").alias("i94visa"),
        F.lit(1.0).alias("count"),
        F.when(part % 2 == 0, "M").alias("matflag"),
        (F.lit(2000.0) - quantity).alias("biryear"),
        F.when(supplier % 2 == 0, "F").otherwise("M").alias("gender"),
        F.when(line != 7, F.concat(F.lit("A"), _text(supplier % 20))).alias("airline"),
        F.when(quantity < 49, F.lpad(_text(part % 200), 5, "0")).alias("fltno"),
        F.col("l_linestatus").alias("visatype"),
        (F.lit(90_000_000_000.0) + key).alias("admnum"),
    )


_RECORDS = """
    r AS (
        SELECT l_orderkey * 10 + l_linenumber AS cicid,
               CAST(l_shipdate AS DATE) AS dep,
               CAST(l_shipdate AS DATE) + CAST(5 - l_partkey % 40 AS INTEGER) AS arr,
               CASE WHEN l_linenumber <> 7 THEN 'A' || (l_suppkey % 20) END AS airline,
               CASE WHEN l_quantity < 49 THEN lpad(CAST(l_partkey % 200 AS VARCHAR), 5, '0') END AS fltno, *
        FROM lineitem),
    flights AS (
        SELECT airline AS airline_code, fltno AS flight_number,
               CAST(row_number() OVER (ORDER BY airline, fltno) AS INTEGER) AS flight_id
        FROM (SELECT DISTINCT airline, fltno FROM r WHERE airline IS NOT NULL AND fltno IS NOT NULL))
"""

_FACT = f"""
    {_RECORDS},
    fact AS (
        SELECT CAST(cicid AS INTEGER) AS cicid,
               CAST(NULLIF(l_suppkey % 30, 0) AS INTEGER) AS city_code,
               CAST(NULLIF(l_partkey % 30, 0) AS INTEGER) AS res_code,
               l_returnflag || l_linestatus AS port,
               CAST(arr AS VARCHAR) AS arr_date,
               CAST(NULLIF(l_linenumber % 4, 0) AS INTEGER) AS mode,
               CASE l_partkey % 5 WHEN 0 THEN 'CA' WHEN 1 THEN 'TX' ELSE 'ZZ' END AS addr,
               CASE WHEN l_returnflag = 'A' THEN CAST(dep AS VARCHAR) END AS dept_date,
               CAST(NULLIF(l_quantity - 1, 0) AS INTEGER) AS age,
               CAST(NULLIF(l_linenumber % 5, 0) AS INTEGER) AS visa_code,
               1 AS counter,
               CASE WHEN l_partkey % 2 = 0 THEN 'M' END AS matflag,
               CAST(2000 - l_quantity AS INTEGER) AS birth_year,
               CASE WHEN l_suppkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               flight_id,
               CAST(year(arr) AS INTEGER) AS date_year, CAST(month(arr) AS INTEGER) AS date_month,
               l_linestatus AS visa_type,
               90000000000 + l_orderkey AS admission_number
        FROM r JOIN flights ON airline = airline_code AND fltno = flight_number
        WHERE l_returnflag <> 'A' OR (year(dep) = {YEAR} AND dep >= arr))
"""


# Which of the broken records below do not fit, by target column.
_UNFIT = {
    "age": "l_quantity = 50",
    "city_code": "l_suppkey % 30 = 3",
    "admission_number": "(90000000000 + l_orderkey) % 7 = 0",
}


def _fact(spark: SparkSession, folder: str) -> DataFrame:
    raw = records(spark, folder)
    return star.immigration_fact(raw, star.airlines_dimension(raw), YEAR)


@query(
    f"""
    WITH {_RECORDS}
    SELECT 'no airline or flight number' AS reason, count(*) AS "rows" FROM r WHERE airline IS NULL OR fltno IS NULL
    UNION ALL SELECT 'stay ends outside the year', count(*) FROM r WHERE l_returnflag = 'A' AND year(dep) <> {YEAR}
    UNION ALL SELECT 'stay ends before it starts', count(*) FROM r WHERE l_returnflag = 'A' AND dep < arr
    UNION ALL {" UNION ALL ".join(
        f"SELECT '{n} does not fit {'bigint' if n == 'admission_number' else 'int'}',"
        f" count(*) FILTER (WHERE {_UNFIT.get(n, 'false')}) FROM r" for n in star.FACT_NUMBERS)}
    """
)
def count_record_losses(spark: SparkSession, folder: str) -> DataFrame:
    """With ages, cities and admission numbers that do not fit their types."""
    raw = records(spark, folder)
    broken = {
        "i94bir": F.when(F.col("i94bir") == 49, F.lit(1e12)).otherwise(F.col("i94bir")),
        "i94cit": F.when(F.col("i94cit") == 3, F.lit(float("nan"))).otherwise(F.col("i94cit")),
        "admnum": F.when(F.col("admnum") % 7 == 0, F.lit(1e30)).otherwise(F.col("admnum")),
    }
    return star.record_losses(raw.withColumns(broken), YEAR)


@query(f"WITH {_RECORDS} SELECT * FROM flights")
def build_airlines(spark: SparkSession, folder: str) -> DataFrame:
    return star.airlines_dimension(records(spark, folder))


@query(f"WITH {_FACT} SELECT * FROM fact")
def build_immigration_fact(spark: SparkSession, folder: str) -> DataFrame:
    fact = _fact(spark, folder)
    return fact.withColumns({c: _text(F.col(c)) for c in ("arr_date", "dept_date")})


@query(
    f"""
    WITH {_FACT},
    days AS (SELECT CAST(arr_date AS DATE) AS d FROM fact WHERE dept_date IS NOT NULL
             UNION SELECT CAST(dept_date AS DATE) FROM fact WHERE dept_date IS NOT NULL)
    SELECT CAST(d AS VARCHAR) AS date_date, CAST(day(d) AS INTEGER) AS day,
           CAST(weekofyear(d) AS INTEGER) AS week, CAST(month(d) AS INTEGER) AS month,
           strftime(d, '%B') AS month_name, CAST(year(d) AS INTEGER) AS year,
           CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, strftime(d, '%a') AS day_of_week_name
    FROM days
    """
)
def build_dates(spark: SparkSession, folder: str) -> DataFrame:
    dates = star.dates_dimension(_fact(spark, folder))
    return dates.withColumn("date_date", _text(F.col("date_date")))


def _airports(spark: SparkSession, folder: str) -> DataFrame:
    size, key = F.col("p_size"), F.col("p_partkey")
    return table(spark, folder, "part").select(
        F.concat(F.lit("ID"), _text(key)).alias("ident"),
        F.when(size == 50, F.lit(None))
        .when(F.col("p_type") == "PROMO", "closed")
        .otherwise(F.col("p_type"))
        .alias("type"),
        F.col("p_name").alias("name"),
        _text(size).alias("elevation_ft"),
        F.lit("NA").alias("continent"),
        F.lit("US").alias("iso_country"),
        F.concat(F.lit("US-"), _text(size)).alias("iso_region"),
        F.col("p_brand").alias("municipality"),
        F.lit(None).cast("string").alias("gps_code"),
        F.when(size != 9, _text(key % 150)).alias("iata_code"),
        F.concat(_text(size), F.lit(".25, -"), _text(key % 180), F.lit(".5")).alias("coordinates"),
    )


@query(
    """
    WITH raw AS (
        SELECT 'ID' || p_partkey AS ident, CASE WHEN p_size = 50 THEN NULL WHEN p_type = 'PROMO' THEN 'closed' ELSE p_type END AS type,
               p_name AS name, CAST(p_size AS DOUBLE) AS elevation_ft, 'NA' AS continent, 'US' AS iso_country,
               'US-' || p_size AS iso_region, p_brand AS municipality, CAST(NULL AS VARCHAR) AS gps_code,
               CASE WHEN p_size <> 9 THEN CAST(p_partkey % 150 AS VARCHAR) END AS iata_code,
               CAST(p_size AS VARCHAR) AS region_code, p_size + 0.25 AS latitude, -(p_partkey % 180) - 0.5 AS longitude
        FROM part)
    SELECT ident AS id, type, name, elevation_ft, continent, iso_country, iso_region, municipality, gps_code,
           iata_code, region_code, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude
    FROM (SELECT *, row_number() OVER (PARTITION BY iata_code, type ORDER BY ident) AS r FROM raw
          WHERE iata_code <> '0' AND type <> 'closed' AND iata_code NOT IN ('11', '12'))
    WHERE r = 1
    """
)
def build_airports(spark: SparkSession, folder: str) -> DataFrame:
    return star.airports_dimension(_airports(spark, folder), excluded=("11", "12"))


def _temperatures(spark: SparkSession, folder: str) -> DataFrame:
    customer = F.col("o_custkey")
    country = F.when(customer % 30 == 5, "elsewhere").otherwise(
        F.concat(F.lit("Nation_"), _text(customer % 30))
    )
    price = _text(F.floor("o_totalprice"))
    return table(spark, folder, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"),
        F.when(F.col("o_orderkey") % 13 != 0, price).alias("AverageTemperature"),
        country.alias("Country"),
        F.concat(_text(customer % 80), F.lit(".5N")).alias("Latitude"),
        F.concat(_text(customer % 170), F.lit(".5W")).alias("Longitude"),
    )


def _countries(spark: SparkSession, folder: str) -> DataFrame:
    blank = F.when(F.col("n_nationkey") % 2 == 0, " ").otherwise("")
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("cit_res_code"), F.concat("n_name", blank).alias("cit_res_name")
    )


@query(
    f"""
    WITH readings AS (
        SELECT o_custkey % 30 AS c, month(o_orderdate) AS m,
               avg(CASE WHEN o_orderkey % 13 <> 0 THEN floor(o_totalprice) END) AS t,
               avg(o_custkey % 80 + 0.5) AS lat, avg(-(o_custkey % 170) - 0.5) AS lon
        FROM orders WHERE o_orderdate >= DATE '2000-01-01' GROUP BY 1, 2),
    profile AS (
        SELECT c, arg_min(lat, m) AS latitude, arg_min(lon, m) AS longitude,
               {", ".join(f"max(CASE WHEN m = {i} THEN t END) AS temp_{name.lower()}"
                          for i, name in enumerate(MONTHS, 1))}
        FROM readings GROUP BY c)
    SELECT n_nationkey AS cit_res_code, n_name || CASE WHEN n_nationkey % 2 = 0 THEN ' ' ELSE '' END AS cit_res_name,
           latitude, longitude, {", ".join(f"temp_{name.lower()}" for name in MONTHS)}
    FROM nation LEFT JOIN profile ON n_nationkey = c AND n_nationkey <> 5
    """
)
def build_regions(spark: SparkSession, folder: str) -> DataFrame:
    return star.regions_dimension(_temperatures(spark, folder), _countries(spark, folder))


_RACES = tuple(star.RACE_COLUMNS)


def _cities(spark: SparkSession, folder: str) -> DataFrame:
    quantity, line = F.col("l_quantity").cast("int"), F.col("l_linenumber")
    race = F.element_at(F.array(*[F.lit(r) for r in (*_RACES, "Not listed")]), line % 6 + 1)
    return table(spark, folder, "lineitem").select(
        F.concat(F.lit("City "), _text(F.col("l_partkey") % 7)).alias("City"),
        F.concat(F.lit("State "), _text(F.col("l_suppkey"))).alias("State"),
        F.concat(F.lit("S"), _text(F.col("l_suppkey"))).alias("State Code"),
        _text(quantity).alias("Median Age"),
        _text(quantity * 10 + line).alias("Male Population"),
        _text(quantity * 20 + line).alias("Female Population"),
        _text(quantity * 30 + line * 2).alias("Total Population"),
        _text(line).alias("Number of Veterans"),
        F.when(line != 3, _text(quantity)).otherwise("").alias("Foreign-born"),
        _text(line).alias("Average Household Size"),
        race.alias("Race"),
        _text(quantity * 3 + line).alias("Count"),
    )


@query(
    f"""
    WITH raw AS (
        SELECT l_partkey % 7 AS city, l_suppkey AS s, CAST(l_quantity AS INTEGER) AS q, l_linenumber AS n,
               CAST(l_quantity AS INTEGER) * 3 + l_linenumber AS count FROM lineitem),
    places AS (
        SELECT *, row_number() OVER (PARTITION BY city, s ORDER BY CAST(q AS VARCHAR), CAST(n AS VARCHAR)) AS r FROM raw),
    totals AS (
        SELECT s, avg(CAST(q AS DOUBLE)) AS median_age, avg(CAST(n AS DOUBLE)) AS household_size_avg,
               sum(q * 10 + n) AS male, sum(q * 20 + n) AS female, sum(q * 30 + 2 * n) AS total,
               sum(n) AS veterans, sum(CASE WHEN n <> 3 THEN q END) AS born
        FROM places WHERE r = 1 GROUP BY s),
    races AS (
        SELECT s, {", ".join(f"sum(CASE WHEN n % 6 = {i} THEN count END) AS race{i}" for i in range(5))}
        FROM raw GROUP BY s)
    SELECT 'S' || s AS state_code, 'State ' || s AS state_name, median_age,
           CAST(male AS INTEGER) AS male_population, CAST(female AS INTEGER) AS female_population,
           CAST(total AS INTEGER) AS total_population, CAST(veterans AS INTEGER) AS veterans_population,
           CAST(born AS INTEGER) AS foreign_born_population, household_size_avg,
           {", ".join(f"CAST(race{i} AS INTEGER) AS {name}"
                      for i, name in enumerate(star.RACE_COLUMNS.values()))}
    FROM totals JOIN races USING (s)
    """
)
def build_demographics(spark: SparkSession, folder: str) -> DataFrame:
    return star.demographics_dimension(_cities(spark, folder))


def _ports(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.concat(F.lit("P"), _text(F.col("s_suppkey"))).alias("code"),
        F.concat(F.lit(" "), F.col("s_name"), F.lit("      ")).alias("port_name"),
    )


@query(
    """
    SELECT 'P' || s_suppkey AS code, s_name AS port_name FROM supplier
    """
)
def build_ports(spark: SparkSession, folder: str) -> DataFrame:
    return star.ports_dimension(_ports(spark, folder))


@query(
    """
    SELECT 'P' || s_suppkey AS code, CAST(count(*) AS BIGINT) AS count
    FROM (SELECT DISTINCT c_nationkey, c_custkey % 40 AS state FROM customer)
    LEFT JOIN supplier ON s_nationkey = c_nationkey AND s_suppkey % 45 = state
    GROUP BY 1
    """
)
def city_port_matches(spark: SparkSession, folder: str) -> DataFrame:
    cities = table(spark, folder, "customer").select(
        F.concat(F.lit("City"), _text(F.col("c_nationkey"))).alias("City"),
        _text(F.col("c_custkey") % 40).alias("State"),
        _text(F.col("c_custkey") % 40).alias("State Code"),
    )
    ports = table(spark, folder, "supplier").select(
        F.concat(F.lit("P"), _text(F.col("s_suppkey"))).alias("code"),
        F.concat(
            F.lit("CITY"), _text(F.col("s_nationkey")), F.lit(", "), _text(F.col("s_suppkey") % 45)
        ).alias("port_name"),
    )
    return star.city_port_match_rate(cities, ports)


@query(
    f"""
    WITH {_FACT}
    SELECT CASE mode WHEN 1 THEN 'Air' WHEN 2 THEN 'Sea' WHEN 3 THEN 'Land' END AS travel_mode,
           CASE visa_code WHEN 1 THEN 'Business' WHEN 2 THEN 'Pleasure' WHEN 3 THEN 'Student' END AS travel_purpose,
           n_name AS origin,
           CASE WHEN month(CAST(arr_date AS DATE)) IN (12, 1, 2) THEN 'winter'
                WHEN month(CAST(arr_date AS DATE)) <= 5 THEN 'spring'
                WHEN month(CAST(arr_date AS DATE)) <= 8 THEN 'summer' ELSE 'autumn' END AS season,
           CAST(count(*) AS BIGINT) AS travellers
    FROM fact LEFT JOIN nation ON res_code = n_nationkey WHERE date_year = {YEAR} GROUP BY 1, 2, 3, 4
    """
)
def analyse_travel_patterns(spark: SparkSession, folder: str) -> DataFrame:
    regions = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("cit_res_code"), F.col("n_name").alias("cit_res_name")
    )
    return travel_patterns(
        _fact(spark, folder),
        star.modes_dimension(spark),
        star.visas_dimension(spark),
        regions,
        YEAR,
    )


@query(
    f"""
    WITH {_FACT},
    states AS (
        SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'CA' ELSE 'NY' END AS state_code,
               'State of ' || CASE WHEN s_suppkey % 2 = 0 THEN 'CA' ELSE 'NY' END AS state_name, count(*) * 1000 AS total,
               CAST(sum(s_nationkey) AS BIGINT) AS born FROM supplier GROUP BY 1, 2)
    SELECT state_code, state_name, travellers, total AS total_population,
           CASE WHEN total > 0 THEN travellers * 1000 / total END AS travellers_per_1000,
           CASE WHEN total > 0 THEN born / total END AS foreign_born_share,
           CASE WHEN total > 0 THEN CAST(40 AS DOUBLE) END AS median_age, CASE WHEN total > 0 THEN CAST(2.5 AS DOUBLE) END AS household_size_avg
    FROM (SELECT CASE WHEN addr = 'ZZ' THEN '99' ELSE addr END AS state_code, CAST(count(*) AS BIGINT) AS travellers
          FROM fact GROUP BY 1)
    LEFT JOIN states USING (state_code)
    """
)
def analyse_destinations(spark: SparkSession, folder: str) -> DataFrame:
    state = F.when(F.col("s_suppkey") % 2 == 0, "CA").otherwise("NY")
    demographics = (
        table(spark, folder, "supplier")
        .groupBy(state.alias("state_code"))
        .agg(
            (F.count("*") * 1000).alias("total_population"),
            F.sum("s_nationkey").alias("foreign_born_population"),
        )
        .select(
            "*",
            F.concat(F.lit("State of "), F.col("state_code")).alias("state_name"),
            F.lit(40.0).alias("median_age"),
            F.lit(2.5).alias("household_size_avg"),
        )
    )
    return destination_profile(_fact(spark, folder), demographics)


_DAYS = """SELECT CAST(d AS VARCHAR) AS date_date, CAST(day(d) AS INTEGER) AS day,
           CAST(weekofyear(d) AS INTEGER) AS week, CAST(month(d) AS INTEGER) AS month,
           strftime(d, '%B') AS month_name, CAST(year(d) AS INTEGER) AS year,
           CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, strftime(d, '%a') AS day_of_week_name FROM days"""


@query(
    f"""
    WITH {_FACT},
    days AS (SELECT CAST(arr_date AS DATE) AS d FROM fact
             UNION SELECT CAST(dept_date AS DATE) FROM fact WHERE dept_date IS NOT NULL)
    {_DAYS}
    """
)
def build_dates_with_open_stays(spark: SparkSession, folder: str) -> DataFrame:
    dates = star.dates_dimension(_fact(spark, folder), include_open=True)
    return dates.withColumn("date_date", _text(F.col("date_date")))


@query(
    f"""
    WITH {_RECORDS}
    SELECT CAST(cicid AS INTEGER) AS cicid, CAST(l_suppkey % 30 AS INTEGER) AS city_code,
           CAST(NULLIF(l_partkey % 30, 0) AS INTEGER) AS res_code, CAST(l_linenumber % 4 AS INTEGER) AS mode, flight_id
    FROM r LEFT JOIN flights ON airline = airline_code AND fltno = flight_number
    WHERE l_returnflag <> 'A' OR (year(dep) = {YEAR} AND dep >= arr)
    """
)
def build_fact_keeping_zero(spark: SparkSession, folder: str) -> DataFrame:
    """Zero as a value in some columns, and records without a flight kept."""
    raw = records(spark, folder)
    fact = star.immigration_fact(
        raw, star.airlines_dimension(raw), YEAR, keep_zero=("city_code", "mode"), keep_unmatched=True
    )
    return fact.select("cicid", "city_code", "res_code", "mode", "flight_id")


@query(
    """
    SELECT 'temperatures' AS source, 'dt' AS "column", 'date' AS "type", count(*) FILTER (WHERE o_orderkey % 11 = 0) AS rejected FROM orders
    UNION ALL SELECT 'temperatures', 'AverageTemperature', 'double', count(*) FILTER (WHERE o_orderkey % 17 = 0) FROM orders
    UNION ALL SELECT 'cities', name, CASE WHEN name IN ('Median Age', 'Average Household Size') THEN 'double' ELSE 'int' END,
        CASE name WHEN 'Count' THEN (SELECT count(*) FROM lineitem WHERE l_orderkey % 5 = 0) ELSE 0 END
        FROM (VALUES ('Median Age'), ('Male Population'), ('Female Population'), ('Total Population'), ('Number of Veterans'),
                     ('Foreign-born'), ('Average Household Size'), ('Count')) v(name)
    """
)
def count_source_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Malformed text among temperatures and cities."""
    key = F.col("o_orderkey")
    temperatures = table(spark, folder, "orders").select(
        F.when(key % 11 == 0, "1999-13-45").otherwise("1999-12-31").alias("dt"),
        F.when(key % 17 == 0, "warm").when(key % 17 == 1, " ").otherwise("12.5").alias("AverageTemperature"),
    )
    return star.source_rejects({"temperatures": temperatures, "cities": _odd_cities(spark, folder)})


def _odd_cities(spark: SparkSession, folder: str) -> DataFrame:
    number = _text(F.col("l_linenumber"))
    names = [c for c in star.SOURCE_CASTS["cities"] if c != "Count"]
    count = F.when(F.col("l_orderkey") % 5 == 0, F.concat(number, F.lit(" people"))).otherwise(number)
    return table(spark, folder, "lineitem").select(*[number.alias(c) for c in names], count.alias("Count"))


def _rows(name: str, build: str) -> str:
    return f"SELECT '{name}' AS \"table\", CAST(0 AS BIGINT) AS failed, count(*) AS \"rows\" FROM ({ORACLES[build]})"


def numbered_records(spark: SparkSession, folder: str) -> DataFrame:
    """All records, with ids that are unique: some line items share their number."""
    raw = records(spark, folder).drop("cicid")
    return dense_surrogate_key(raw, raw.columns, "cicid").withColumn("cicid", F.col("cicid").cast("double"))


@query(
    " UNION ALL ".join(
        _rows(name, build)
        for name, build in {
            "airlines_dm": "build_airlines", "immigration_ft": "build_immigration_fact", "airports_dm": "build_airports",
            "immi_dates_dm": "build_dates", "regions_dm": "build_regions", "demographics_dm": "build_demographics", "ports_dm": "build_ports",
        }.items()
    )
    + " UNION ALL SELECT 'visas_dm', 0, 3 UNION ALL SELECT 'modes_dm', 0, 4"
)
def whole_job(spark: SparkSession, folder: str) -> DataFrame:
    """All nine tables built, gated and written, then gated again as they were read back."""
    sources = Sources(
        numbered_records(spark, folder), _airports(spark, folder), _temperatures(spark, folder), _cities(spark, folder),
        _countries(spark, folder), _ports(spark, folder),
    )
    tables = build_star(
        spark, sources, new_scratch_path(spark, "star"), YEAR, excluded_airports=("11", "12")
    )
    return check_star(tables).filter(F.col("check") != REPORTED).groupBy("table").agg(
        F.count_if(~F.col("passed")).alias("failed"),
        F.max(F.when(F.col("check") == "has_rows", F.col("observed"))).alias("rows"),
    )
