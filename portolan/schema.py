"""The nine target tables: columns, types, keys and output folders; raw source columns."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

from portolan.functions.dates import MONTHS
from portolan.operators.quality import Expectations


@dataclass(frozen=True)
class TableSpec:
    """A target table.

    Foreign keys (``column -> table.column``) are reported, not enforced. Rows lie close
    together by ``cluster_by`` within a partition.
    """

    name: str
    folder: str
    schema: T.StructType
    primary_key: str
    foreign_keys: Mapping[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    typed_columns: tuple[str, ...] = ()
    reported_unique: tuple[tuple[str, ...], ...] = ()

    @property
    def expectations(self) -> Expectations:
        return Expectations(
            unique=((self.primary_key,),),
            reported_unique=self.reported_unique,
            not_null=(self.primary_key,),
            types={c: self.schema[c].dataType for c in self.typed_columns},
        )


_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "string": T.StringType(),
}


def _schema(columns: str) -> T.StructType:
    """Schema from ``name type, name type``; needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


IMMIGRATION = TableSpec(
    name="immigration_ft",
    folder="immigration_fact",
    schema=_schema(
        "cicid int, city_code int, res_code int, port string, arr_date date, mode int,"
        " addr string, dept_date date, age int, visa_code int, counter int, matflag string,"
        " birth_year int, gender string, flight_id int, date_year int, date_month int,"
        " visa_type string, admission_number bigint"
    ),
    primary_key="cicid",
    foreign_keys={
        "city_code": "regions_dm.cit_res_code",
        "res_code": "regions_dm.cit_res_code",
        "port": "ports_dm.code",
        "arr_date": "immi_dates_dm.date_date",
        "dept_date": "immi_dates_dm.date_date",
        "mode": "modes_dm.code",
        "addr": "demographics_dm.state_code",
        "visa_code": "visas_dm.code",
        "flight_id": "airlines_dm.flight_id",
    },
    partition_by=("date_year", "date_month"),
    cluster_by=("dept_date", "flight_id"),
    typed_columns=("arr_date", "dept_date"),
)

AIRLINES = TableSpec(
    name="airlines_dm",
    folder="flights",
    schema=_schema("airline_code string, flight_number string, flight_id int"),
    primary_key="flight_id",
)

AIRPORTS = TableSpec(
    name="airports_dm",
    folder="airports",
    schema=_schema(
        "id string, type string, name string, elevation_ft double, continent string,"
        " iso_country string, iso_region string, municipality string, gps_code string,"
        " iata_code string, region_code string, latitude double, longitude double"
    ),
    primary_key="id",
    foreign_keys={"iata_code": "immigration_ft.port"},
    reported_unique=(("iata_code",),),
)

DATES = TableSpec(
    name="immi_dates_dm",
    folder="dates",
    schema=_schema(
        "date_date date, day int, week int, month int, month_name string, year int,"
        " day_of_week int, day_of_week_name string"
    ),
    primary_key="date_date",
    typed_columns=("date_date",),
)

REGIONS = TableSpec(
    name="regions_dm",
    folder="regions",
    schema=_schema(
        "cit_res_code int, cit_res_name string, latitude double, longitude double, "
        + ", ".join(f"temp_{m.lower()} double" for m in MONTHS)
    ),
    primary_key="cit_res_code",
)

DEMOGRAPHICS = TableSpec(
    name="demographics_dm",
    folder="demographics",
    # One population column lacks a letter; readers of the table rely on the name.
    schema=_schema(
        "state_code string, state_name string, median_age double, male_population int,"
        " female_population int, total_population int, veterans_population int,"
        " foreign_born_population int, household_size_avg double,"
        " american_indian_and_alaskan_native_population int, asian_population int,"
        " black_or_african_american_populaton int, hispanic_latino_population int,"
        " white_population int"
    ),
    primary_key="state_code",
)

VISAS = TableSpec(
    name="visas_dm",
    folder="visas",
    schema=_schema("code int, travel_purpose string"),
    primary_key="code",
)

PORTS = TableSpec(
    name="ports_dm",
    folder="ports",
    schema=_schema("code string, port_name string"),
    primary_key="code",
)

MODES = TableSpec(
    name="modes_dm",
    folder="modes",
    schema=_schema("code int, travel_mode string"),
    primary_key="code",
)

TABLES = {
    t.name: t
    for t in (
        IMMIGRATION, AIRLINES, AIRPORTS, DATES, REGIONS, DEMOGRAPHICS, VISAS, PORTS, MODES,
    )
}

# Columns each builder reads from its raw source.
RECORD_COLUMNS = (
    "cicid", "i94yr", "i94mon", "i94cit", "i94res", "i94port", "arrdate", "i94mode", "i94addr",
    "depdate", "i94bir", "i94visa", "count", "matflag", "biryear", "gender", "airline", "fltno",
    "visatype", "admnum",
)
AIRPORT_COLUMNS = (
    "ident", "type", "name", "elevation_ft", "continent", "iso_country", "iso_region",
    "municipality", "gps_code", "iata_code", "coordinates",
)
TEMPERATURE_COLUMNS = ("dt", "AverageTemperature", "Country", "Latitude", "Longitude")
CITY_COLUMNS = (
    "City", "State", "State Code", "Median Age", "Male Population", "Female Population",
    "Total Population", "Number of Veterans", "Foreign-born", "Average Household Size", "Race",
    "Count",
)
