"""The shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from portolan.sources.folders import remove_folder

# Paths that the open scopes own, the innermost last.
_scopes: list[list[str]] = []


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder (``spark.checkpoint.dir``).

    Where a local session names none, a temporary folder is set; a cluster must name a
    folder that all its executors reach.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        if configured is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            configured = tempfile.mkdtemp(prefix="portolan-checkpoint-")
        context.setCheckpointDir(configured)
        current = context.getCheckpointDir()
    return configured or current


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the checkpoint folder and return the stored table.

    Cuts lineage as a checkpoint does, and later steps read just the columns they use. The
    folder goes with the innermost :func:`scratch_scope`; outside of one it stays, as the
    table may be read at any time.
    """
    path = new_scratch_path(df.sparkSession, name)
    if _scopes:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the checkpoint folder that nothing has used yet."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove what ``store`` writes within, once the block is done or has failed.

    For blocks whose results are written elsewhere before they end.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove_folder(spark, path)
