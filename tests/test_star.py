"""The builders and the whole job on small inputs with results worked out by hand."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from portolan import __main__ as cli
from portolan import schema
from portolan.operators import QualityError
from portolan.plans import (
    Sources,
    airlines_dimension,
    airports_dimension,
    build_star,
    check_star,
    city_port_match_rate,
    dates_dimension,
    demographics_dimension,
    destination_profile,
    immigration_fact,
    ports_dimension,
    publish,
    read_star,
    record_losses,
    regions_dimension,
    travel_patterns,
)

RECORD_SCHEMA = (
    "cicid double, i94yr double, i94mon double, i94cit double, i94res double, i94port string,"
    " arrdate double, i94mode double, i94addr string, depdate double, i94bir double,"
    " i94visa double, count double, matflag string, biryear double, gender string,"
    " airline string, fltno string, visatype string, admnum double, dtadfile string"
)
ARRIVED = 20573.0  # 2016-04-29


def record(cicid, airline="AA", flight="1", arrived=ARRIVED, departed=ARRIVED + 3, **other):
    row = {
        "cicid": float(cicid), "i94yr": 2016.0, "i94mon": 4.0, "i94cit": 209.0, "i94res": 209.0,
        "i94port": "NOM", "arrdate": arrived, "i94mode": 1.0, "i94addr": "AK", "depdate": departed,
        "i94bir": 40.0, "i94visa": 2.0, "count": 1.0, "matflag": "M", "biryear": 1976.0,
        "gender": "F", "airline": airline, "fltno": flight, "visatype": "WT",
        "admnum": 92478461600.0, "dtadfile": "20160429",
    }
    return tuple({**row, **other}.values())


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame(
        [
            record(1, i94bir=0.0, i94cit=0.0),
            record(2, "BA", "7", departed=None, gender=None),
            record(3, None, "1"),
            record(4, "AA", None),
            record(5, departed=ARRIVED - 1),
            record(6, departed=ARRIVED + 0.4, arrived=ARRIVED + 0.9),
            record(7, departed=20820.0),
            record(8, "AA", "0010", departed=0.0, arrived=20500.0, i94addr="XX", i94mon=2.0, i94mode=3.0),
            record(9, "ZZ", "9", departed=19000.0, arrived=18000.0),
        ],
        RECORD_SCHEMA,
    )


AIRPORT_ROWS = [
    ("A1", "small", "One", "11", "NA", "US", "US-PA", "Town", None, "AAA", "40.07, -74.93"),
    ("A0", "small", "Twin", "12.5", "NA", "US", "US-NY", "Town", None, "AAA", "1, 2"),
    ("A2", "big", "Two", "high", "NA", "US", "US", None, "G", "AAA", "x, 3"),
    ("B1", "closed", "Gone", "1", "NA", "US", "US-PA", "T", None, "BBB", "1, 2"),
    ("B2", None, "Typeless", "1", "NA", "US", "US-PA", "T", None, "CCC", "1, 2"),
    ("B3", "small", "Zero", "1", "SA", "BR", "BR-SP", "T", None, "0", "1, 2"),
    ("B4", "small", "Codeless", "1", "NA", "US", "US-PA", "T", None, None, "1, 2"),
    ("B5", "small", "Shared", "1", "NA", "US", "US-PA", "T", None, "MRE", "1, 2"),
]
TEMPERATURE_ROWS = [
    ("1999-12-31", "90", "U", "Rome", "Italy", "40.00N", "10.00E"),
    ("2000-01-01", "4", "U", "Rome", "Italy", "42.00N", "12.00E"),
    ("2001-01-01", "8", "U", "Bari", "Italy", "44.00N", "14.00E"),
    ("2001-02-01", None, "U", "Rome", "Italy", "50.00N", "10.00E"),
    ("2001-07-01", "25.5", "U", "Rome", "Italy", "50.00N", "10.00E"),
    ("2001-12-01", "20", "U", "Salta", "Argentina", "5S", "60.5W"),
    ("broken", "1", "U", "Oslo", "Norway", "60N", "10E"),
]
COUNTRY_ROWS = [(117, "ITALY"), (687, "ARGENTINA "), (582, "MEXICO (I-94)"), (0, "INVALID: STATELESS")]
PORT_ROWS = [("NOM", "NOM, AK   "), ("CP ", "No PORT Code (CP)"), ("BAR", " BARROW, AK"), ("BA2", "BARROW, AK")]
CITY_ROWS = [
    # City, State, Code, age, male, female, total, veterans, foreign, household, race, count
    ("Nom", "Alaska", "AK", "30", "10", "11", "21", "1", "2", "2.5", "White", "5"),
    ("Nom", "Alaska", "AK", "30", "10", "11", "21", "1", "2", "2.5", "Asian", "6"),
    ("Barrow", "Alaska", "AK", "40", "5", "5", "10", None, "3", "3.5", "White", "7"),
    ("Faith", "Texas", "TX", "50", "1", "2", "3", "1", "", "2", "Hispanic or Latino", "2"),
]


@pytest.fixture(scope="module")
def sources(spark, records):
    text = lambda names: ", ".join(f"`{n}` string" for n in names)
    temperature = ("dt", "AverageTemperature", "AverageTemperatureUncertainty", "City", "Country",
                   "Latitude", "Longitude")
    return Sources(
        records=records,
        airports=spark.createDataFrame(AIRPORT_ROWS, text(schema.AIRPORT_COLUMNS)),
        temperatures=spark.createDataFrame(TEMPERATURE_ROWS, text(temperature)),
        cities=spark.createDataFrame(CITY_ROWS, text(schema.CITY_COLUMNS)),
        countries=spark.createDataFrame(COUNTRY_ROWS, "cit_res_code int, cit_res_name string"),
        ports=spark.createDataFrame(PORT_ROWS, "code string, port_name string"),
    )


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def by(df, key, *columns):
    return {r[0]: tuple(r)[1:] for r in df.select(key, *columns).collect()}


def test_airlines(records):
    out = airlines_dimension(records)
    assert out.schema == schema.AIRLINES.schema or out.dtypes == [
        ("airline_code", "string"), ("flight_number", "string"), ("flight_id", "int")]
    assert rows(out) == [("AA", "0010", 1), ("AA", "1", 2), ("BA", "7", 3), ("ZZ", "9", 4)]


def test_fact(records):
    fact = immigration_fact(records, airlines_dimension(records))
    assert fact.dtypes == [(f.name, f.dataType.simpleString()) for f in schema.IMMIGRATION.schema]
    day = dt.date(2016, 4, 29)
    assert by(fact, "cicid", "arr_date", "dept_date", "flight_id") == {
        1: (day, dt.date(2016, 5, 2), 2),
        2: (day, None, 3),
        6: (day, day, 2),
        8: (dt.date(2016, 2, 16), None, 1),
    }
    first = fact.filter("cicid = 1").first()
    assert first["age"] is None and first["city_code"] is None and first["res_code"] == 209
    assert first["admission_number"] == 92478461600
    assert (first["date_year"], first["date_month"], first["birth_year"]) == (2016, 4, 1976)


def test_fact_options(records):
    airlines = airlines_dimension(records)
    kept = immigration_fact(records, airlines, keep_unmatched=True)
    assert by(kept, "cicid", "flight_id") == {1: (2,), 2: (3,), 3: (None,), 4: (None,), 6: (2,), 8: (1,)}
    zeros = immigration_fact(records, airlines, keep_zero=("age",))
    assert zeros.filter("cicid = 1").first()["age"] == 0
    assert zeros.filter("cicid = 1").first()["city_code"] is None
    plain = immigration_fact(records, airlines, zero_is_null=False)
    assert plain.filter("cicid = 1").first()["city_code"] == 0
    assert rows(immigration_fact(records, airlines, year=2012), "cicid") == [(2,), (8,), (9,)]


def test_fact_does_not_depend_on_partitioning(records):
    expected = rows(immigration_fact(records, airlines_dimension(records)))
    for n in (1, 7):
        spread = records.repartition(n)
        assert rows(immigration_fact(spread, airlines_dimension(spread))) == expected


def test_record_losses(spark, records):
    wide = spark.createDataFrame([record(1e12)], RECORD_SCHEMA)
    got = by(record_losses(records.unionByName(wide)), "reason", "rows")
    assert {reason: n for reason, (n,) in got.items() if n} == {
        "no airline or flight number": 2,
        "stay ends outside the year": 2,
        "stay ends before it starts": 1,
        "cicid does not fit int": 1,
    }


def test_dates(records):
    fact = immigration_fact(records, airlines_dimension(records))
    assert rows(dates_dimension(fact), "date_date", "day_of_week") == [
        (dt.date(2016, 4, 29), 6), (dt.date(2016, 5, 2), 2)]
    opened = rows(dates_dimension(fact, include_open=True), "date_date")
    assert (dt.date(2016, 2, 16),) in opened and len(opened) == 3


def test_airports(sources):
    out = airports_dimension(sources.airports)
    columns = ("type", "elevation_ft", "region_code", "latitude", "longitude")
    assert by(out, "id", *columns) == {
        "A0": ("small", 12.5, "NY", 1.0, 2.0),
        "A2": ("big", None, None, None, 3.0),
    }
    swapped = airports_dimension(sources.airports, excluded=(), latitude_part=1, longitude_part=0)
    assert by(swapped, "id", "latitude", "longitude")["B5"] == (2.0, 1.0)
    assert rows(airports_dimension(sources.airports, id_column="iata_code"), "id") == [("AAA",), ("AAA",)]


def test_regions(sources):
    out = regions_dimension(sources.temperatures, sources.countries)
    columns = ("cit_res_name", "latitude", "longitude", "temp_january", "temp_february",
               "temp_july", "temp_december")
    assert by(out, "cit_res_code", *columns) == {
        117: ("ITALY", 43.0, 13.0, 6.0, None, 25.5, None),
        687: ("ARGENTINA ", -5.0, -60.5, None, None, None, 20.0),
        582: ("MEXICO (I-94)", None, None, None, None, None, None),
        0: ("INVALID: STATELESS", None, None, None, None, None, None),
    }
    exact = regions_dimension(sources.temperatures, sources.countries, exact=True)
    assert by(exact, "cit_res_code", "temp_december")[687] == (None,)
    early = regions_dimension(sources.temperatures, sources.countries, dt.date(1900, 1, 1))
    assert by(early, "cit_res_code", "temp_december")[117] == (90.0,)


def test_demographics(sources):
    assert rows(demographics_dimension(sources.cities)) == [
        ("AK", "Alaska", 35.0, 15, 16, 31, 1, 5, 3.0, None, 6, None, None, 12),
        ("TX", "Texas", 50.0, 1, 2, 3, 1, None, 2.0, None, None, None, 2, None),
    ]


def test_ports(sources):
    assert rows(ports_dimension(sources.ports)) == [
        ("BA2", "BARROW, AK"), ("BAR", "BARROW, AK"), ("CP ", "No PORT Code (CP)"), ("NOM", "NOM, AK")]
    assert ("NOM", "NOM, AK   ") in rows(ports_dimension(sources.ports, trim=False))


def test_city_port_match_rate(sources):
    got = rows(city_port_match_rate(sources.cities, ports_dimension(sources.ports)))
    assert got == [("BA2", 1), ("BAR", 1), ("NOM", 1), (None, 1)]


def test_no_python_in_the_plans(records, sources, plan):
    airlines = airlines_dimension(records)
    fact = immigration_fact(records, airlines)
    for df in (
        airlines,
        fact,
        dates_dimension(fact),
        airports_dimension(sources.airports),
        regions_dimension(sources.temperatures, sources.countries),
        demographics_dimension(sources.cities),
        ports_dimension(sources.ports),
    ):
        assert "EvalPython" not in plan(df)


def test_fact_scan_is_narrow_and_filtered(spark, records, tmp_path, plan):
    path = str(tmp_path / "records")
    records.write.parquet(path)
    stored = spark.read.parquet(path)
    fact = plan(immigration_fact(stored, airlines_dimension(stored)))
    assert "dtadfile" not in fact
    pushed = fact.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(depdate,20454.0)" in pushed and "isnotnull(airline" in fact
    assert "BroadcastHashJoin" in fact and "Exchange hashpartitioning(airline" not in fact


def test_whole_job(spark, sources, tmp_path):
    root = str(tmp_path / "star")
    built = build_star(spark, sources, root)
    counts = {name: df.count() for name, df in built.items()}
    assert counts == {
        "airlines_dm": 4, "immigration_ft": 4, "airports_dm": 2, "immi_dates_dm": 2, "regions_dm": 4,
        "demographics_dm": 2, "visas_dm": 3, "ports_dm": 4, "modes_dm": 4,
    }
    assert set(counts) == set(schema.TABLES)
    assert sorted(p.name for p in (tmp_path / "star" / "immigration_fact").glob("v*/date_year=2016/*")) == [
        "date_month=2", "date_month=4"]
    again = read_star(spark, root)
    for name, spec in schema.TABLES.items():
        assert sorted(again[name].dtypes) == sorted(
            (f.name, f.dataType.simpleString()) for f in spec.schema)
        assert rows(again[name]) == rows(built[name])

    report = check_star(again).collect()
    assert {r["table"] for r in report} == set(schema.TABLES)
    assert [(r["table"], r["column"]) for r in report if not r["passed"]] == [("airports_dm", "iata_code")]

    tables = again
    patterns = travel_patterns(
        tables["immigration_ft"], tables["modes_dm"], tables["visas_dm"], tables["regions_dm"], 2016)
    assert rows(patterns) == [
        ("Air", "Pleasure", None, "spring", 3), ("Land", "Pleasure", None, "winter", 1)]
    places = destination_profile(tables["immigration_ft"], tables["demographics_dm"])
    got = by(places, "state_code", "travellers", "total_population", "foreign_born_share")
    assert got == {"AK": (3, 31, 5 / 31), "99": (1, None, None)}


def test_month_rerun(spark, records, sources, tmp_path):
    root = str(tmp_path / "star")
    built = build_star(spark, sources, root)
    february = records.filter("i94mon = 2").withColumn("gender", F.lit("X"))
    fact = immigration_fact(february, built["airlines_dm"])
    publish(fact, schema.IMMIGRATION, root, keep=False, only_present=True)
    stored = read_star(spark, root)["immigration_ft"]
    assert by(stored, "cicid", "gender") == {1: ("F",), 2: (None,), 6: ("F",), 8: ("X",)}


def test_failed_gate_stops_the_job(spark, records, sources, tmp_path):
    doubled = Sources(**{**sources.__dict__, "records": records.unionByName(records)})
    with pytest.raises(QualityError, match="immigration_ft.cicid unique"):
        build_star(spark, doubled, str(tmp_path / "star"))
    assert [p.name for p in (tmp_path / "star").iterdir()] == ["flights"]


def test_keys_point_at_declared_columns():
    for spec in schema.TABLES.values():
        assert spec.primary_key in spec.schema.fieldNames()
        for column, target in spec.foreign_keys.items():
            table, key = target.split(".")
            assert column in spec.schema.fieldNames()
            assert key in schema.TABLES[table].schema.fieldNames()


def test_command_line(spark, records, sources, tmp_path, capsys):
    records.write.parquet(str(tmp_path / "records"))
    for name, sep in (("airports", ","), ("temperatures", ","), ("cities", ";"), ("countries", ","), ("ports", ",")):
        getattr(sources, name).write.csv(
            str(tmp_path / name), sep=sep, header=True, ignoreTrailingWhiteSpace=False,
            ignoreLeadingWhiteSpace=False)
    inputs = [f"--{n}={tmp_path / n}" for n in
              ("records", "airports", "temperatures", "cities", "countries", "ports")]
    cli.main([*inputs, f"--output={tmp_path / 'out'}", "--losses"])
    printed = capsys.readouterr().out
    assert "immigration_ft: 4 rows" in printed and "ports_dm: 4 rows" in printed
    assert "no airline or flight number: 2 records" in printed


@pytest.mark.parametrize("keep", [True, False])
def test_publish_builds_its_rows_once(spark, tmp_path, keep):
    """Gate, the ranges of the folders and the write share one build."""
    spec, built = schema.IMMIGRATION, spark.sparkContext.accumulator(0)

    def number(x):
        built.add(1)
        return x

    own = F.udf(number, "int")(F.col("id").cast("int"))
    empty = [f for f in spec.schema.fields if f.name not in ("cicid", *spec.partition_by)]
    fact = spark.range(50).select(own.alias("cicid"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in empty], F.lit(2016).alias("date_year"), (F.col("id") % 2).cast("int").alias("date_month"))
    written = publish(fact.select(*spec.schema.names), spec, str(tmp_path), keep=keep)
    assert written.count() == 50 and built.value == 50
