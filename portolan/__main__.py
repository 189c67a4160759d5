"""Command line: ``spark-submit`` this package to build the star schema."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from portolan import schema
from portolan.plans import Sources, build_star, record_losses, star
from portolan.plans.job import check_references, rerun_months
from portolan.sources import read_code_list, read_delimited, read_format_statement, read_parquet


def _code_list(
    spark: SparkSession, path: str, statement: str | None, code: str, name: str, code_type: str
) -> DataFrame:
    if statement:
        return read_format_statement(spark, path, statement, code, name, code_type)
    return read_code_list(spark, path, code, name, code_type)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="portolan", description=__doc__)
    p.add_argument("--records", required=True, help="Parquet folder of entry/exit records")
    p.add_argument("--airports", required=True, help="comma-separated airport codes")
    p.add_argument("--temperatures", required=True, help="comma-separated city temperatures")
    p.add_argument("--cities", required=True, help="semicolon-separated city demographics")
    p.add_argument("--countries", required=True, help="country list: CSV or label program")
    p.add_argument("--ports", required=True, help="port list: CSV or label program")
    p.add_argument("--country-statement", help="value statement of the country list")
    p.add_argument("--port-statement", help="value statement of the port list")
    p.add_argument("--output", required=True, help="folder for the nine tables")
    p.add_argument("--year", type=int, default=2016, help="year in which closed stays end")
    p.add_argument("--keep-unmatched", action="store_true", help="keep records without a flight")
    p.add_argument("--include-open", action="store_true", help="dates of open stays as well")
    p.add_argument("--losses", action="store_true", help="count records and values that are left out")
    p.add_argument("--climate-since", type=dt.date.fromisoformat, default=dt.date(2000, 1, 1), help="first day of readings")
    p.add_argument("--keep-zero", nargs="*", default=(), help="fact columns in which 0 is a value")
    p.add_argument("--zero-is-value", action="store_true", help="0 is a value in all fact columns")
    p.add_argument("--exclude-airports", nargs="*", default=star.SHARED_AIRPORT_CODES, help="airport codes left out")
    p.add_argument("--airport-id", default="ident", choices=("ident", "iata_code"), help="primary key of airports")
    p.add_argument("--longitude-first", action="store_true", help="airport coordinates are longitude, latitude")
    p.add_argument("--exact-countries", action="store_true", help="match country names with their blanks")
    p.add_argument("--rerun", action="store_true", help="replace only the months in --records; new flights join the airlines in --output")
    p.add_argument("--rebuild", action="store_true", help="build tables that are up to date as well")
    p.add_argument("--references", action="store_true", help="count references that no dimension holds")
    a = p.parse_args(argv)

    spark = SparkSession.builder.appName("portolan").getOrCreate()
    sources = Sources(
        records=read_parquet(spark, a.records, required=schema.RECORD_COLUMNS),
        airports=read_delimited(spark, a.airports, required=schema.AIRPORT_COLUMNS),
        temperatures=read_delimited(spark, a.temperatures, required=schema.TEMPERATURE_COLUMNS),
        cities=read_delimited(spark, a.cities, sep=";", required=schema.CITY_COLUMNS),
        countries=_code_list(
            spark, a.countries, a.country_statement, "cit_res_code", "cit_res_name", "int"
        ),
        ports=_code_list(spark, a.ports, a.port_statement, "code", "port_name", "string"),
    )
    fact_options = {"zero_is_null": not a.zero_is_value, "keep_zero": a.keep_zero, "keep_unmatched": a.keep_unmatched}
    if a.rerun:
        tables = {"immigration_ft": rerun_months(sources.records, a.output, a.year, **fact_options)}
    else:
        tables = build_star(
            spark,
            sources,
            a.output,
            a.year,
            a.climate_since,
            include_open=a.include_open,
            excluded_airports=a.exclude_airports,
            airport_id=a.airport_id,
            latitude_part=int(a.longitude_first),
            longitude_part=int(not a.longitude_first),
            exact_countries=a.exact_countries,
            resume=not a.rebuild,
            **fact_options,
        )
    if a.losses:
        for row in record_losses(sources.records, a.year).collect():
            print(f"{row['reason']}: {row['rows']} records")
        texts = {"airports": sources.airports, "temperatures": sources.temperatures, "cities": sources.cities}
        for row in star.source_rejects(texts).collect():
            print(f"{row['source']}.{row['column']} does not fit {row['type']}: {row['rejected']} values")
    if a.references and not a.rerun:
        for row in check_references(tables).orderBy("column").collect():
            print(f"{row['table']}.{row['column']}: {row['orphan_values']} unknown values in {row['orphan_rows']} rows")
    for name, table in tables.items():
        print(f"{name}: {table.count()} rows")


if __name__ == "__main__":
    main()
