from __future__ import annotations

import pytest
from pyspark.sql import types as T

# Columns that operators use inside, and more: an operator must not trip over them.
CLASHING = ("rank", "shard", "slot", "blob", "spans", "length", "score", "quality", "kept", "host", "path", "fingerprint", "node", "list", "_row", "_bucket", "count")


@pytest.fixture(scope="session")
def documents(spark):
    """Build documents from (doc_id, text[, lang, source]) with further clashing columns."""

    def build(rows, clashing=True):
        names = CLASHING if clashing else ()
        schema = T.StructType(
            [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
             T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
            + [T.StructField(n, T.StringType()) for n in names]
        )
        full = [
            (r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None, len(r[1] or ""), *["x"] * len(names))
            for r in rows
        ]
        return spark.createDataFrame(full, schema).repartition(3)

    return build
