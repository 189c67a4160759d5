"""Queries over the shared test tables, each beside the SQL that states its result."""

from portolan.checks import builders, expressions, relational, upkeep  # noqa: F401  (they register)
from portolan.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
