"""Builders of the fact table and its eight dimensions. Each returns its declared schema."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portolan import schema
from portolan.functions import (
    hemisphere_coordinate,
    parse_date,
    place_key,
    serial_day_to_date,
    split_pick,
    to_number,
    trimmed,
    zero_as_missing,
)
from portolan.operators import (
    attach_surrogate_key,
    calendar_dimension,
    category_pivot,
    conform,
    dedupe,
    dense_surrogate_key,
    distinct_rows,
    exclude_values,
    match_rate,
    mixed_rollup,
    monthly_profile,
    open_or_ordered,
    project,
    recorded_and_not,
    serial_open_or_within_year,
    since,
)
from portolan.operators.lookup import any_null
from portolan.operators.profile import rejected_casts
from portolan.operators.registry import unregistered_keys
from portolan.sources import TRAVEL_MODES, VISA_PURPOSES, code_list

# Airport codes that several airports share and no port of entry uses.
SHARED_AIRPORT_CODES = ("MRE", "YMX", "SGL", "RCH", "PRM", "LHG")

# Categories of the city table and the columns they become.
RACE_COLUMNS = {
    "American Indian and Alaska Native": "american_indian_and_alaskan_native_population",
    "Asian": "asian_population",
    "Black or African-American": "black_or_african_american_populaton",
    "Hispanic or Latino": "hispanic_latino_population",
    "White": "white_population",
}

# Target columns of the fact table that are raw numbers.
FACT_NUMBERS = {
    "cicid": "cicid",
    "city_code": "i94cit",
    "res_code": "i94res",
    "mode": "i94mode",
    "age": "i94bir",
    "visa_code": "i94visa",
    "counter": "count",
    "birth_year": "biryear",
    "date_year": "i94yr",
    "date_month": "i94mon",
    "admission_number": "admnum",
}
FACT_TEXTS = {
    "port": "i94port",
    "addr": "i94addr",
    "matflag": "matflag",
    "gender": "gender",
    "visa_type": "visatype",
    "airline": "airline",
    "fltno": "fltno",
}


def _flights(records: DataFrame) -> DataFrame:
    return project(records, {"airline_code": "airline", "flight_number": "fltno"})


def new_airlines(records: DataFrame, airlines: DataFrame) -> DataFrame:
    """Flights that the airlines table lacks, with ids that follow its largest."""
    new = unregistered_keys(_flights(records), airlines, ["airline_code", "flight_number"], "flight_id")
    return conform(new, schema.AIRLINES.schema)


def airlines_dimension(records: DataFrame) -> DataFrame:
    """Airline × flight number with a dense id in (airline, flight number) order."""
    pairs = distinct_rows(_flights(records).na.drop())
    numbered = dense_surrogate_key(pairs, ["airline_code", "flight_number"], "flight_id")
    return conform(numbered, schema.AIRLINES.schema)


def immigration_fact(
    records: DataFrame,
    airlines: DataFrame,
    year: int = 2016,
    zero_is_null: bool = True,
    keep_zero: Sequence[str] = (),
    keep_unmatched: bool = False,
) -> DataFrame:
    """One row per traveller: typed columns, stays that end in ``year`` or are open.

    In floating-point sources 0 means "not recorded" and becomes null, save for the
    target columns in ``keep_zero``. Records without airline or flight number are
    dropped unless ``keep_unmatched``. The year filter tests the raw serial, so the scan
    can skip row groups.
    """

    def number(name: str, raw: str) -> Column:
        target = schema.IMMIGRATION.schema[name].dataType.simpleString()
        floating = isinstance(records.schema[raw].dataType, T.DoubleType)
        if zero_is_null and floating and name not in keep_zero:
            return zero_as_missing(F.col(raw), target)
        return F.col(raw).try_cast(target)

    stays = project(
        records.filter(serial_open_or_within_year("depdate", year)),
        {
            **{name: number(name, raw) for name, raw in FACT_NUMBERS.items()},
            **FACT_TEXTS,
            "arr_date": serial_day_to_date("arrdate"),
            "dept_date": serial_day_to_date("depdate"),
        },
    ).filter(open_or_ordered("arr_date", "dept_date"))
    keyed = attach_surrogate_key(
        stays,
        airlines,
        {"airline": "airline_code", "fltno": "flight_number"},
        "flight_id",
        keep_unmatched,
    )
    return conform(keyed, schema.IMMIGRATION.schema)


def record_losses(records: DataFrame, year: int = 2016) -> DataFrame:
    """``(reason, rows)``: records the fact table leaves out, and values it cannot hold.

    A record may count under several reasons. One scan.
    """
    arrived, departed = serial_day_to_date("arrdate"), serial_day_to_date("depdate")
    reasons = {
        "no airline or flight number": any_null(["airline", "fltno"]),
        "stay ends outside the year": ~serial_open_or_within_year("depdate", year),
        "stay ends before it starts": ~F.coalesce(open_or_ordered(arrived, departed), F.lit(False)),
    }
    for name, raw in FACT_NUMBERS.items():
        target = schema.IMMIGRATION.schema[name].dataType.simpleString()
        unfit = F.col(raw).isNotNull() & F.col(raw).try_cast(target).isNull()
        reasons[f"{name} does not fit {target}"] = unfit
    totals = records.agg(*[F.count_if(c).alias(f"r{i}") for i, c in enumerate(reasons.values())])
    counted = [
        F.struct(F.lit(reason).alias("reason"), F.col(f"r{i}").alias("rows"))
        for i, reason in enumerate(reasons)
    ]
    return totals.select(F.inline(F.array(*counted)))


# Text columns of the delimited sources and the types they are cast to.
SOURCE_CASTS = {
    "airports": {"elevation_ft": "double"},
    "temperatures": {"dt": "date", "AverageTemperature": "double"},
    "cities": {
        "Median Age": "double",
        "Male Population": "int",
        "Female Population": "int",
        "Total Population": "int",
        "Number of Veterans": "int",
        "Foreign-born": "int",
        "Average Household Size": "double",
        "Count": "int",
    },
}


def source_rejects(sources: Mapping[str, DataFrame]) -> DataFrame:
    """``(source, column, type, rejected)``: recorded values that do not fit their type.

    ``sources`` maps airports, temperatures and cities to their text tables. Rejected
    values become null in the dimensions; a reading whose date is rejected is left out.
    Blank text counts as not recorded. One scan of each source.
    """
    reports = []
    for name, df in sources.items():
        recorded = df.select(*[F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")).alias(c) for c in SOURCE_CASTS[name]])
        reports.append(rejected_casts(recorded, SOURCE_CASTS[name]).select(F.lit(name).alias("source"), "*"))
    return reduce(DataFrame.unionByName, reports)


def airports_dimension(
    airports: DataFrame,
    excluded: Sequence[str] | DataFrame = SHARED_AIRPORT_CODES,
    latitude_part: int = 0,
    longitude_part: int = 1,
    id_column: str = "ident",
) -> DataFrame:
    """Open airports with a usable code, one per (code, type).

    ``id_column`` names the source of the primary key, ``ident`` or ``iata_code``.
    """
    usable = recorded_and_not(
        airports.select(*schema.AIRPORT_COLUMNS), {"iata_code": "0", "type": "closed"}
    )
    kept = dedupe(exclude_values(usable, "iata_code", excluded), ["iata_code", "type"], ["ident"])
    laid_out = project(
        kept,
        {
            "id": id_column,
            "type": "type",
            "name": "name",
            "elevation_ft": to_number("elevation_ft"),
            "continent": "continent",
            "iso_country": "iso_country",
            "iso_region": "iso_region",
            "municipality": "municipality",
            "gps_code": "gps_code",
            "iata_code": "iata_code",
            "region_code": split_pick("iso_region", "-", 1),
            "latitude": split_pick("coordinates", ",", latitude_part, "float"),
            "longitude": split_pick("coordinates", ",", longitude_part, "float"),
        },
    )
    return conform(laid_out, schema.AIRPORTS.schema)


def dates_dimension(fact: DataFrame, include_open: bool = False) -> DataFrame:
    """Arrival and departure dates of closed stays; ``include_open`` adds the other arrivals."""
    return conform(
        calendar_dimension(fact, "arr_date", "dept_date", include_open), schema.DATES.schema
    )


def climate_profile(
    temperatures: DataFrame, first: dt.date = dt.date(2000, 1, 1), exact: bool = False
) -> DataFrame:
    """Per upper-case country: mean temperature in each month, and where the readings lie."""
    country = F.col("Country") if exact else trimmed("Country")
    readings = project(
        temperatures,
        {
            "country": F.upper(country),
            "day": parse_date("dt"),
            "temperature": to_number("AverageTemperature"),
            "latitude": hemisphere_coordinate("Latitude"),
            "longitude": hemisphere_coordinate("Longitude"),
        },
    ).filter(since("day", first))
    return monthly_profile(
        readings,
        "country",
        "day",
        "temperature",
        {"latitude": "latitude", "longitude": "longitude"},
        prefix="temp_",
    )


def regions_dimension(
    temperatures: DataFrame,
    countries: DataFrame,
    first: dt.date = dt.date(2000, 1, 1),
    exact: bool = False,
) -> DataFrame:
    """The country list (``cit_res_code``, ``cit_res_name``) with its climate, if known.

    A listed name matches a country's upper-case name; blanks around either are ignored
    unless ``exact``.
    """
    listed_name = F.col("cit_res_name") if exact else trimmed("cit_res_name")
    listed = countries.withColumn("country", listed_name)
    joined = listed.join(climate_profile(temperatures, first, exact), "country", "left")
    return conform(joined, schema.REGIONS.schema)


def demographics_dimension(cities: DataFrame) -> DataFrame:
    """State totals over distinct cities, beside state totals per race over all rows."""
    places = dedupe(
        cities.select(*[c for c in schema.CITY_COLUMNS if c not in ("Race", "Count")]),
        ["City", "State", "State Code"],
    )
    totals = mixed_rollup(
        places,
        ["State Code", "State"],
        means={
            "median_age": to_number("Median Age"),
            "household_size_avg": to_number("Average Household Size"),
        },
        sums={
            "male_population": to_number("Male Population"),
            "female_population": to_number("Female Population"),
            "total_population": to_number("Total Population"),
            "veterans_population": to_number("Number of Veterans"),
            "foreign_born_population": to_number("Foreign-born"),
        },
    )
    races = category_pivot(cities, ["State Code"], "Race", RACE_COLUMNS, to_number("Count"))
    joined = totals.join(races, "State Code").withColumnsRenamed(
        {"State Code": "state_code", "State": "state_name"}
    )
    return conform(joined, schema.DEMOGRAPHICS.schema)


def visas_dimension(spark: SparkSession) -> DataFrame:
    return code_list(spark, VISA_PURPOSES, "code", "travel_purpose")


def modes_dimension(spark: SparkSession) -> DataFrame:
    return code_list(spark, TRAVEL_MODES, "code", "travel_mode")


def ports_dimension(ports: DataFrame, trim: bool = True) -> DataFrame:
    """The port list (``code``, ``port_name``), names without padding, codes as listed."""
    listed = ports.withColumn("port_name", trimmed("port_name")) if trim else ports
    return conform(listed, schema.PORTS.schema)


def city_port_match_rate(cities: DataFrame, ports: DataFrame) -> DataFrame:
    """Cities per port code whose name is ``CITY, ST``; the null code counts the rest."""
    places = distinct_rows(cities, ["City", "State", "State Code"])
    return match_rate(places, place_key("City", "State Code"), ports, "port_name", "code")
