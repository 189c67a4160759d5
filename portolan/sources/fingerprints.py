"""What a table was made from, as a digest to compare before it is made again."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.sources.folders import file_marks

_FIELDS = "spark.sql.debug.maxToStringFields"
# Leaves of a plan whose rows are in no file.
_IN_MEMORY = re.compile(r"LocalRelation|LogicalRDD|ExternalRDD|InMemoryRelation")


def _plan(df: DataFrame) -> str:
    """The analysed plan as text, without the numbers that each session gives anew."""
    spark = df.sparkSession
    before = spark.conf.get(_FIELDS)
    spark.conf.set(_FIELDS, "100000")
    try:
        text = df._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.set(_FIELDS, before)
    return re.sub(r"#\d+L?", "", text)


def fingerprint(inputs: Iterable[DataFrame], details: object = ()) -> str:
    """A digest of the inputs' plans and of what they read, and of ``details`` as text.

    Files count by path, length and time of change, so no data is read. Inputs with rows
    that lie in no file, such as short code lists, count by their rows in any order.
    """
    said = [repr(details)]
    for df in inputs:
        plan = _plan(df)
        files = sorted(df.inputFiles())
        said += [plan, *map(repr, file_marks(df.sparkSession, files))]
        if _IN_MEMORY.search(plan) or not files:
            total = F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)"))
            said.append(repr(df.agg(F.count("*"), total).first()))
    return hashlib.sha256("\n".join(said).encode()).hexdigest()
