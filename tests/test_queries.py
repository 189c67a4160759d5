"""Every registered query against its SQL on DuckDB."""

from __future__ import annotations

import importlib.util
import os

import pytest

from portolan.checks import ORACLES, QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")


def _load(path):
    spec = importlib.util.spec_from_file_location(os.path.basename(path)[:-3], path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


compare = _load(os.path.join(ROOT, "tools", "compare.py"))


@pytest.fixture(scope="module")
def con():
    return compare.duck(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare.difference(spark, con, FOLDER, name) is None


def test_entry_points(spark):
    entry = _load(os.path.join(ROOT, "__spark_entry__.py"))
    assert set(QUERIES) == set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
