"""Run the registered queries on Spark and their SQL on DuckDB, and compare the rows.

Usage: python tools/compare.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from portolan.checks import ORACLES, QUERIES  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


DUCK_TYPES = {
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


def difference(spark: SparkSession, con, folder: str, name: str) -> str | None:
    """None if both sides give the same columns, types and rows, else what differs."""
    df = QUERIES[name](spark, folder)
    got = [tuple(r) for r in df.collect()]
    expected = con.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    types = {d[0]: str(d[1]) for d in expected.description}
    if sorted(names) != sorted(df.columns):
        return f"columns {df.columns} vs {names}"
    other = {c: DUCK_TYPES.get(types[c], types[c]) for c in names}
    mine = dict(df.dtypes)
    if mine != other:
        return f"types {[(c, mine[c], other[c]) for c in names if mine[c] != other[c]]}"
    order = [names.index(c) for c in df.columns]
    want = [tuple(r[i] for i in order) for r in expected.fetchall()]
    missing, extra = Counter(want) - Counter(got), Counter(got) - Counter(want)
    if missing or extra:
        return (
            f"rows {len(got)} vs {len(want)}; not in Spark {list(missing)[:2]};"
            f" only in Spark {list(extra)[:2]}"
        )
    return None if got else "no rows"


def main() -> int:
    p = argparse.ArgumentParser()
    p.add_argument("--sf", default="0.01")
    p.add_argument("names", nargs="*")
    a = p.parse_args()
    folder = f"/root/testdata/sf{a.sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(folder), 0
    for name in a.names or QUERIES:
        start = time.time()
        try:
            found = difference(spark, con, folder, name)
        except Exception as e:  # report and go on with the next query
            found = f"{type(e).__name__}: {str(e)[:600]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print(f"{bad} of {len(a.names or QUERIES)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
