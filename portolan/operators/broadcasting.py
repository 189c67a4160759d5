"""Broadcast only what has been measured."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Data that every executor can hold as a hash table beside its tasks.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

_ROW_BYTES = 16
_FIELD_BYTES = 8


def fits_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether ``df`` takes no more than ``max_bytes`` as rows in memory.

    Rows and text are measured in one aggregation.
    """
    row_bytes = _ROW_BYTES + _FIELD_BYTES * len(df.columns)
    sizes = [F.count("*") * row_bytes]
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            sizes.append(F.sum(F.octet_length(F.to_json(c))))
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.sum(F.octet_length(c)))
    measured = df.agg(*[s.alias(f"s{i}") for i, s in enumerate(sizes)]).first()
    return sum(n or 0 for n in measured) <= max_bytes
