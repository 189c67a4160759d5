"""Surrogate keys that stay as they are when keys are added."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.operators.broadcasting import MAX_BROADCAST_BYTES
from portolan.operators.keys import dense_surrogate_key
from portolan.operators.lookup import lookup_join


def unregistered_keys(
    keys: DataFrame,
    registry: DataFrame,
    on: Sequence[str],
    name: str = "id",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """The rows to append to ``registry``: keys that it lacks, with ids above its largest.

    ``keys`` may repeat and may hold keys that are registered; those with a null part are
    left out. New ids follow each other without gaps in the order of ``on``, so the same
    loads in the same order give the same ids, and an id once given never changes. An empty
    registry is one that starts at 1.
    """
    on = list(on)
    fresh = keys.select(*on).na.drop().distinct()
    unknown = lookup_join(fresh, registry.select(*on), on, "left_anti", max_broadcast_bytes)
    numbered = dense_surrogate_key(unknown, on, name)
    largest = registry.agg(F.max(name)).first()[0] or 0
    return numbered.withColumn(name, (F.col(name) + F.lit(largest)).cast(registry.schema[name].dataType))
