"""Code lists as two-column tables.

The short lists are given here. The country and port lists, with several hundred
entries each, are inputs: delimited text (:func:`read_code_list`) or the ``value``
statement that publishes them in the label program of the records
(:func:`read_format_statement`).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Codes and labels of the published record layout.
VISA_PURPOSES = {1: "Business", 2: "Pleasure", 3: "Student"}

TRAVEL_MODES = {1: "Air", 2: "Sea", 3: "Land", 9: "Not reported"}

# State and territory codes that count as valid; all others are "99".
STATE_CODES = (
    "AL AK AZ AR CA CO CT DE DC FL GA GU HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT "
    "NC ND NE NV NH NJ NM NY OH OK OR PA PR RI SC SD TN TX UT VT VI VA WV WA WI WY"
).split()
OTHER_STATE = "99"


def code_list(
    spark: SparkSession, entries: Mapping[int | str, str], code: str, name: str
) -> DataFrame:
    """A short in-memory list as a table; integer codes become ``int``."""
    key_type = "int" if all(isinstance(k, int) for k in entries) else "string"
    rows = spark.createDataFrame(list(entries.items()), f"`{code}` {key_type}, `{name}` string")
    return rows.coalesce(1)


def read_code_list(
    spark: SparkSession, path: str, code: str, name: str, code_type: str = "string", sep: str = ","
) -> DataFrame:
    """A list from delimited text with a header; first column code, second name.

    Codes keep their blanks (``'CP '`` is not ``'CP'``); quote fields that hold the
    separator.
    """
    raw = spark.read.csv(
        path,
        sep=sep,
        header=True,
        inferSchema=False,
        enforceSchema=False,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return raw.select(
        F.col(f"`{raw.columns[0]}`").cast(code_type).alias(code),
        F.col(f"`{raw.columns[1]}`").alias(name),
    )


def read_format_statement(
    spark: SparkSession,
    path: str,
    statement: str,
    code: str,
    name: str,
    code_type: str = "string",
) -> DataFrame:
    """The ``code = 'label'`` pairs of one ``value <statement> ... ;`` in a label program.

    The file is read one statement per row, by its closing semicolon. A doubled quote
    inside a label is dropped (``INT''L`` gives ``INTL``).
    """
    statements = spark.read.text(path, lineSep=";")
    body = F.regexp_extract("value", rf"(?is)\bvalue\s+\$?{statement}\b(.*)$", 1)
    pair = r"(?:'([^']*)'|([^\s'=]+))\s*=\s*'((?:[^']|'')*)'"
    groups = [
        F.regexp_extract_all(body, F.lit(pair), F.lit(i)).alias(group)
        for i, group in enumerate(("quoted", "bare", "label"), start=1)
    ]
    pairs = statements.select(F.explode(F.arrays_zip(*groups)).alias("p")).select("p.*")
    return pairs.select(
        F.when(F.col("quoted") != "", F.col("quoted")).otherwise(F.col("bare"))
        .cast(code_type).alias(code),
        F.replace("label", F.lit("''"), F.lit("")).alias(name),
    )
