"""The whole job: build every table in order, gate it, write it, compare the copy."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

import portolan
from portolan import schema
from portolan.operators import QualityError, enforce, run_checks, run_suite
from portolan.operators.check_states import check_state, key_state, merged_report, replaced
from portolan.operators.references import reference_report
from portolan.plans import star, summaries
from portolan.schema import TableSpec
from portolan.sources import read_parquet, write_partitioned, write_table
from portolan.sources.fingerprints import fingerprint
from portolan.sources.folders import remove_folder
from portolan.sources.scratch import scratch_scope, store
from portolan.sources.versions import VersionedTable


@dataclass(frozen=True)
class Sources:
    """Raw inputs; temperatures, cities and airports are all-text as read from CSV."""

    records: DataFrame
    airports: DataFrame
    temperatures: DataFrame
    cities: DataFrame
    countries: DataFrame
    ports: DataFrame


def table_path(spec: TableSpec, root: str) -> str:
    return f"{root.rstrip('/')}/{spec.folder}"


def publish(
    df: DataFrame,
    spec: TableSpec,
    root: str,
    keep: bool = True,
    only_present: bool = False,
    append: bool = False,
    **facts: object,
) -> DataFrame:
    """Gate ``df``, write it under ``root`` and return the written table.

    A failed gate raises before anything is written. The rows are written as a new version
    beside the live one and compared with the source by count; only then the table's
    manifest names them, so that readers see the old table or the new one whatever fails.
    Gate and write read rows that are built once: ``keep`` holds them in memory and on disk
    in between; without it they are stored in the scratch folder, for a table as large as
    its source, and read by the columns that each step uses. ``only_present`` replaces just
    the partitions that occur in ``df`` and ``append`` none; ``facts`` go into the manifest.
    """
    table = VersionedTable(df.sparkSession, table_path(spec, root))
    staged = table.stage()
    with scratch_scope(df.sparkSession):
        df = df.persist(StorageLevel.MEMORY_AND_DISK) if keep else store(df, spec.name)
        try:
            checked = enforce(run_checks(df, spec.name, spec.expectations))
            if spec.partition_by:
                write_partitioned(df, staged, spec.partition_by, cluster_by=spec.cluster_by)
            else:
                write_table(df, staged)
        finally:
            if keep:
                df.unpersist()
    rows = next(r["observed"] for r in checked if r["check"] == "has_rows")
    if read_parquet(df.sparkSession, staged, spec.schema).count() != rows:
        raise QualityError(f"{spec.name}: the written table does not hold the source's rows")
    mode = "append" if append else "replace_present" if only_present and spec.partition_by else "replace"
    table.commit(staged, mode, **facts)
    return table.read(spec.schema)


def check_star(tables: dict[str, DataFrame]) -> DataFrame:
    """The gates of all given tables as one report, by table name."""
    return run_suite({name: (df, schema.TABLES[name].expectations) for name, df in tables.items()})


def build_star(
    spark: SparkSession,
    sources: Sources,
    root: str,
    year: int = 2016,
    climate_since: dt.date = dt.date(2000, 1, 1),
    keep_unmatched: bool = False,
    include_open: bool = False,
    zero_is_null: bool = True,
    keep_zero: Sequence[str] = (),
    excluded_airports: Sequence[str] | DataFrame = star.SHARED_AIRPORT_CODES,
    airport_id: str = "ident",
    latitude_part: int = 0,
    longitude_part: int = 1,
    exact_countries: bool = False,
    resume: bool = True,
) -> dict[str, DataFrame]:
    """Write the nine tables under ``root``; the first failed gate stops the job.

    Each later table that depends on an earlier one reads its written form. A table's
    manifest holds the fingerprint of its definition, options and inputs; one that is there
    with the same fingerprint is not built again, so a run after a stop goes on at the
    first table that is missing or out of date. ``resume=False`` builds all.
    """
    built: dict[str, DataFrame] = {}

    def add(spec: TableSpec, build: Callable[[], DataFrame], inputs: Sequence[DataFrame], *options: object, keep: bool = True) -> DataFrame:
        made_from = fingerprint(inputs, (portolan.__version__, spec, options))
        table = VersionedTable(spark, table_path(spec, root))
        current = table.manifest()
        if resume and current is not None and current.facts.get("fingerprint") == made_from:
            built[spec.name] = table.read(spec.schema)
        else:
            with scratch_scope(spark):
                built[spec.name] = publish(build(), spec, root, keep=keep, fingerprint=made_from)
        return built[spec.name]

    s = sources
    records = [s.records]
    airlines = add(schema.AIRLINES, lambda: star.airlines_dimension(s.records), records, keep=False)
    fact_options = (year, zero_is_null, tuple(keep_zero), keep_unmatched)
    fact = add(
        schema.IMMIGRATION, lambda: star.immigration_fact(s.records, airlines, *fact_options),
        [*records, airlines], fact_options, keep=False,
    )
    listed = [excluded_airports] if isinstance(excluded_airports, DataFrame) else []
    airport_options = (latitude_part, longitude_part, airport_id)
    add(
        schema.AIRPORTS, lambda: star.airports_dimension(s.airports, excluded_airports, *airport_options),
        [s.airports, *listed], airport_options, () if listed else tuple(excluded_airports),
    )
    add(schema.DATES, lambda: star.dates_dimension(fact, include_open), [fact], include_open)
    region_options = (climate_since, exact_countries)
    add(
        schema.REGIONS, lambda: star.regions_dimension(s.temperatures, s.countries, *region_options),
        [s.temperatures, s.countries], region_options,
    )
    add(schema.DEMOGRAPHICS, lambda: star.demographics_dimension(s.cities), [s.cities])
    add(schema.VISAS, lambda: star.visas_dimension(spark), [], star.VISA_PURPOSES)
    add(schema.PORTS, lambda: star.ports_dimension(s.ports), [s.ports])
    add(schema.MODES, lambda: star.modes_dimension(spark), [], star.TRAVEL_MODES)
    return built


def extend_airlines(records: DataFrame, root: str) -> DataFrame:
    """The airlines table with the flights of ``records`` that it lacks appended.

    Old ids stay as they are; new ones follow the largest.
    """
    spec = schema.AIRLINES
    table = VersionedTable(records.sparkSession, table_path(spec, root))
    with scratch_scope(records.sparkSession):
        new = star.new_airlines(records, table.read(spec.schema))
        return table.read(spec.schema) if new.isEmpty() else publish(new, spec, root, append=True)


# The states of the fact table's checks, one folder per month, beside it.
COUNTS_FOLDER, KEYS_FOLDER = "checks/immigration_counts", "checks/immigration_keys"


def fact_states(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Counts and keys of each month of the fact table that is there now.

    States name the version of the table that they describe. If they lag behind it, as
    after a crash between two commits or a first build, they are made anew from the table.
    """
    spec, by = schema.IMMIGRATION, schema.IMMIGRATION.partition_by
    fact = VersionedTable(spark, table_path(spec, root))
    number = fact.manifest().number
    stored = [VersionedTable(spark, f"{root.rstrip('/')}/{f}") for f in (COUNTS_FOLDER, KEYS_FOLDER)]
    manifests = [s.manifest() for s in stored]
    if any(m is None or m.facts.get("of_version") != number for m in manifests):
        _store_states(fact.read(spec.schema), root, "replace", number)
    return stored[0].read(_state_schema(check_state, spec, spark)), stored[1].read(_state_schema(key_state, spec, spark))


def _state_schema(state: Callable, spec: TableSpec, spark: SparkSession):
    return state(spark.createDataFrame([], spec.schema), spec.expectations, spec.partition_by).schema


def _store_states(fact: DataFrame, root: str, mode: str, number: int) -> None:
    spec = schema.IMMIGRATION
    for state, folder in ((check_state, COUNTS_FOLDER), (key_state, KEYS_FOLDER)):
        table = VersionedTable(fact.sparkSession, f"{root.rstrip('/')}/{folder}")
        staged = table.stage()
        write_partitioned(state(fact, spec.expectations, spec.partition_by), staged, spec.partition_by)
        table.commit(staged, mode, of_version=number)


def rerun_months(records: DataFrame, root: str, year: int = 2016, **options: object) -> DataFrame:
    """Build the fact rows of ``records`` and replace just the months that occur in them.

    ``records`` has all records of those months. Flights that are new are appended to the
    airlines table; known ones keep their ids. The gate is that of the whole table: the
    states of the other months are merged with those of the new rows, so a key that two
    months share fails it, and the other months' rows are not read.
    """
    spark, spec = records.sparkSession, schema.IMMIGRATION
    by, table = spec.partition_by, VersionedTable(spark, table_path(spec, root))
    airlines = extend_airlines(records, root)
    counts, keys = fact_states(spark, root)
    staged = table.stage()
    with scratch_scope(spark):
        fact = store(star.immigration_fact(records, airlines, year, **options), spec.name)
        write_partitioned(fact, staged, by, cluster_by=spec.cluster_by)
        rows = fact.count()
    new = read_parquet(spark, staged, spec.schema)  # the states come from the written rows
    states = replaced(counts, check_state(new, spec.expectations, by), by), replaced(keys, key_state(new, spec.expectations, by), by)
    try:
        enforce(merged_report(*states, spec.name, spec.expectations))
        if new.count() != rows:
            raise QualityError(f"{spec.name}: the written table does not hold the source's rows")
    except QualityError:
        remove_folder(spark, staged)
        raise
    number = table.commit(staged, "replace_present").number
    _store_states(new, root, "replace_present", number)
    summaries.refresh_summary(spark, root)
    return table.read(spec.schema)


def check_merged(spark: SparkSession, root: str) -> DataFrame:
    """The gates of the fact table from its stored states."""
    spec = schema.IMMIGRATION
    return merged_report(*fact_states(spark, root), spec.name, spec.expectations)


def check_references(tables: dict[str, DataFrame], max_broadcast_bytes: int | None = None) -> DataFrame:
    """Values of each reference of the fact table that its dimension lacks, and their rows."""
    spec = schema.IMMIGRATION
    targets = {c: target.split(".") for c, target in spec.foreign_keys.items()}
    bound = {} if max_broadcast_bytes is None else {"max_broadcast_bytes": max_broadcast_bytes}
    return reference_report(
        tables[spec.name], {c: (tables[name], key) for c, (name, key) in targets.items() if name in tables}, spec.name, **bound
    )


def read_star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of an earlier run."""
    return {
        name: VersionedTable(spark, table_path(spec, root)).read(spec.schema)
        for name, spec in schema.TABLES.items()
    }
