"""Travellers counted per month of the fact table and kept beside it, for the analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portolan import schema
from portolan.operators import valid_or_other
from portolan.sources import STATE_CODES, write_partitioned
from portolan.sources.versions import VersionedTable

SUMMARY_FOLDER = "summaries/travellers"
# What the analyses group by; a summary row counts the travellers alike in all of them.
KEYS = ("mode", "visa_code", "res_code", "month", "state_code")
SUMMARY_SCHEMA = T.StructType([
    T.StructField("mode", T.IntegerType()), T.StructField("visa_code", T.IntegerType()), T.StructField("res_code", T.IntegerType()),
    T.StructField("month", T.IntegerType()), T.StructField("state_code", T.StringType()), T.StructField("travellers", T.LongType()),
    T.StructField("date_year", T.IntegerType()), T.StructField("date_month", T.IntegerType()),
])


def travellers(fact: DataFrame) -> DataFrame:
    """The summary's rows: travellers per folder of the fact table and ``KEYS``."""
    return (
        fact.select(
            *schema.IMMIGRATION.partition_by, "mode", "visa_code", "res_code",
            F.month("arr_date").alias("month"), valid_or_other("addr", STATE_CODES).alias("state_code"),
        )
        .groupBy(*schema.IMMIGRATION.partition_by, *KEYS).agg(F.count("*").alias("travellers"))
        .select(*SUMMARY_SCHEMA.names)
    )


def refresh_summary(spark: SparkSession, root: str) -> DataFrame:
    """The summary of the fact table under ``root``, with just the months counted anew
    whose files have changed since the summary was made.

    The summary's manifest notes the fact table's folders, version by version, that it was
    counted from; a month that is gone from the fact table goes from the summary too.
    """
    root = root.rstrip("/")
    spec = schema.IMMIGRATION
    fact = VersionedTable(spark, f"{root}/{spec.folder}")
    summary = VersionedTable(spark, f"{root}/{SUMMARY_FOLDER}")
    parts = {month: version for month, version in fact.manifest().parts}
    stored = summary.manifest()
    counted = dict(stored.facts["counted_from"]) if stored is not None else {}
    if counted == parts:
        return summary.read(SUMMARY_SCHEMA)
    changed = [m for m, version in parts.items() if counted.get(m) != version]
    gone = set(counted) - set(parts)
    staged = summary.stage()
    rows = fact.read(spec.schema) if gone else fact.read(spec.schema, only=changed)
    write_partitioned(travellers(rows), staged, spec.partition_by)
    summary.commit(staged, "replace" if gone else "replace_present", counted_from=parts)
    return summary.read(SUMMARY_SCHEMA)
