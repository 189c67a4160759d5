"""The whole job after stops, month reruns, merged gates, references, stored summaries."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from test_star import RECORD_SCHEMA, record, records, rows, sources  # noqa: F401

from portolan import schema
from portolan.operators import QualityError, lookup, references, run_checks
from portolan.operators.check_states import check_state, key_state, merged_report
from portolan.plans import Sources, build_star, destination_profile, immigration_fact, job, read_star, summaries, travel_patterns
from portolan.sources import VersionedTable
from portolan.sources.versions import VersionedTable as Versions


@pytest.fixture
def stored(spark, sources, tmp_path):  # noqa: F811
    """The sources as Parquet files."""
    at = {}
    for name, df in sources.__dict__.items():
        df.write.parquet(str(tmp_path / "in" / name))
        at[name] = str(tmp_path / "in" / name)
    return lambda **other: Sources(**{n: spark.read.parquet(p) for n, p in at.items()} | other)


def numbers(spark, root):
    found = {n: VersionedTable(spark, job.table_path(s, root)).manifest() for n, s in schema.TABLES.items()}
    return {n: m.number if m else None for n, m in found.items()}


def test_a_run_goes_on_after_a_stop(spark, stored, tmp_path, monkeypatch):
    root, published = str(tmp_path / "star"), []
    real = job.publish

    def publish(df, spec, *a, **o):
        if len(published) == 4:
            raise KeyboardInterrupt
        published.append(spec.name)
        return real(df, spec, *a, **o)

    monkeypatch.setattr(job, "publish", publish)
    with pytest.raises(KeyboardInterrupt):
        build_star(spark, stored(), root)
    first = list(published)
    monkeypatch.setattr(job, "publish", lambda df, spec, *a, **o: published.append(spec.name) or real(df, spec, *a, **o))
    built = build_star(spark, stored(), root)
    assert first == ["airlines_dm", "immigration_ft", "airports_dm", "immi_dates_dm"]
    assert published[4:] == ["regions_dm", "demographics_dm", "visas_dm", "ports_dm", "modes_dm"]
    assert set(numbers(spark, root).values()) == {1}

    del published[:]
    again = build_star(spark, stored(), root)
    assert not published and {n: rows(t) for n, t in again.items()} == {n: rows(t) for n, t in built.items()}
    # An option or a source that has changed rebuilds just what depends on it.
    build_star(spark, stored(), root, include_open=True)
    assert published == ["immi_dates_dm"]
    del published[:]
    more = spark.createDataFrame([("XXX", "NEW PORT, XX")], "code string, port_name string")
    build_star(spark, stored(ports=stored().ports.unionByName(more)), root, include_open=True)
    assert published == ["ports_dm"]
    del published[:]
    build_star(spark, stored(), root, include_open=True, resume=False)
    assert len(published) == 9


def test_ids_stay_when_a_month_brings_new_flights(spark, records, stored, tmp_path):  # noqa: F811
    root = str(tmp_path / "star")
    before = build_star(spark, stored(), root)
    old = {r[:2]: r[2] for r in rows(before["airlines_dm"], "airline_code", "flight_number", "flight_id")}
    february = records.filter("i94mon = 2").withColumn("fltno", F.concat(F.lit("0"), "fltno"))
    job.rerun_months(records.filter("i94mon = 2").unionByName(february.withColumn("cicid", F.col("cicid") + 100)), root)
    star = read_star(spark, root)
    new = {r[:2]: r[2] for r in rows(star["airlines_dm"], "airline_code", "flight_number", "flight_id")}
    added = {k: v for k, v in new.items() if k not in old}
    assert {k: new[k] for k in old} == old and added
    assert sorted(added.values()) == list(range(max(old.values()) + 1, max(old.values()) + 1 + len(added)))
    assert star["immigration_ft"].join(star["airlines_dm"], "flight_id", "left_anti").count() == 0


def test_a_key_that_two_months_share_fails_the_rerun(spark, records, stored, tmp_path):  # noqa: F811
    root = str(tmp_path / "star")
    built = build_star(spark, stored(), root)
    other = rows(built["immigration_ft"].filter("date_month = 4"), "cicid")[0][0]
    february = records.filter("i94mon = 2")
    clash = february.withColumn("cicid", F.when(F.col("cicid") == rows(built["immigration_ft"].filter("date_month = 2"), "cicid")[0][0], float(other)).otherwise(F.col("cicid")))
    before = rows(read_star(spark, root)["immigration_ft"])
    with pytest.raises(QualityError, match="immigration_ft.cicid unique .observed 1."):
        job.rerun_months(clash, root)
    assert rows(read_star(spark, root)["immigration_ft"]) == before
    job.rerun_months(february.withColumn("gender", F.lit("X")), root)
    report = {(r["check"], r["column"]): (r["passed"], r["observed"]) for r in job.check_merged(spark, root).collect()}
    fact = read_star(spark, root)["immigration_ft"]
    direct = {(r["check"], r["column"]): (r["passed"], r["observed"]) for r in run_checks(fact, "immigration_ft", schema.IMMIGRATION.expectations).collect()}
    assert report == direct and all(p for p, _ in report.values())


def test_states_that_lag_are_made_anew(spark, records, stored, tmp_path, monkeypatch):  # noqa: F811
    root = str(tmp_path / "star")
    build_star(spark, stored(), root)
    monkeypatch.setattr(job, "_store_states", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        job.rerun_months(records.filter("i94mon = 2"), root)
    monkeypatch.undo()
    job.rerun_months(records.filter("i94mon = 2").limit(1), root)
    with pytest.MonkeyPatch.context() as m:  # the fact table is committed, its states are not
        m.setattr(job, "_store_states", lambda *a: None)
        job.rerun_months(records.filter("i94mon = 2"), root)
    rows_now = read_star(spark, root)["immigration_ft"].count()
    report = job.check_merged(spark, root)
    assert report.filter("check = 'has_rows'").first()["observed"] == rows_now


def test_merged_report_equals_the_direct_one(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "a", 2), (None, "c", 1), (None, None, 1), (3, None, 2)], "k int, t string, m int")
    expected = schema.Expectations(unique=(("k",), ("k", "t"), ("gone",)), reported_unique=(("t",),), not_null=("k", "t", "gone"), types={"k": df.schema["k"].dataType, "t": df.schema["k"].dataType})
    merged = merged_report(check_state(df, expected, ["m"]), key_state(df, expected, ["m"]), "x", expected)
    def by(report):
        return {(r["check"], r["column"]): (r["passed"], r["observed"]) for r in report.collect()}
    direct = by(run_checks(df, "x", expected))
    direct["not_null", "gone"] = (False, 6)  # counted row by row in the states
    assert by(merged) == direct
    nothing = df.limit(0)
    empty = by(merged_report(check_state(nothing, expected, ["m"]), key_state(nothing, expected, ["m"]), "x", expected))
    assert empty["has_rows", "*"] == (False, 0)


def test_references(spark, stored, tmp_path, monkeypatch):
    tables = build_star(spark, stored(), str(tmp_path / "star"))
    fact = tables["immigration_ft"]
    for bound in (None, 0):  # broadcast, and the Bloom filter before a shuffle
        report = {r["column"]: (r["orphan_values"], r["orphan_rows"]) for r in job.check_references(tables, bound).collect()}
        assert set(report) == set(schema.IMMIGRATION.foreign_keys)
        for column, target in schema.IMMIGRATION.foreign_keys.items():
            table, key = target.split(".")
            keys = tables[table].select(F.col(key).alias(column))
            lost = fact.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")
            assert report[column] == (lost.select(column).distinct().count(), lost.count())


def test_bloom_filter_loses_no_value(spark):
    values = spark.range(0, 3000, 3).select(F.col("id").cast("string").alias("value"))
    made = references.bloom_filter(values, "value", 1000)
    kept = references.possibly_in(spark.range(30_000).select(F.col("id").cast("string").alias("value"), F.lit(1).alias("x")), "value", *made)
    assert kept.columns == ["value", "x"]
    assert kept.join(values, "value", "left_semi").count() == 1000
    assert kept.count() < 1000 + 29_000 * 0.03
    assert references.bloom_filter(values, "value", 1 << 30) is None


def test_summary_equals_the_fact_table(spark, records, stored, tmp_path, plan):  # noqa: F811
    root = str(tmp_path / "star")
    tables = build_star(spark, stored(), root)

    def compare():
        star, summary = read_star(spark, root), summaries.refresh_summary(spark, root)
        dims = [star[n] for n in ("modes_dm", "visas_dm", "regions_dm")]
        for year in (None, 2016):
            assert rows(travel_patterns(summary, *dims, year)) == rows(travel_patterns(star["immigration_ft"], *dims, year)) != []
            places = destination_profile(summary, star["demographics_dm"], year)
            assert rows(places) == rows(destination_profile(star["immigration_ft"], star["demographics_dm"], year))
        assert schema.IMMIGRATION.folder not in plan(travel_patterns(summary, *dims))

    compare()
    manifest = VersionedTable(spark, f"{root}/{summaries.SUMMARY_FOLDER}").manifest
    first = dict(manifest().parts)
    summaries.refresh_summary(spark, root)
    assert dict(manifest().parts) == first
    job.rerun_months(records.filter("i94mon = 2").limit(2), root)
    second = dict(manifest().parts)
    assert {m for m in second if second[m] != first.get(m)} == {"date_year=2016/date_month=2"}
    compare()
    april = immigration_fact(records.filter("i94mon = 4"), tables["airlines_dm"])
    job.publish(april, schema.IMMIGRATION, root, keep=False)
    compare()
    assert set(dict(manifest().parts)) == {"date_year=2016/date_month=4"}
