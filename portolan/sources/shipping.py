"""Make this package importable on the executors."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

import portolan

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.abspath(portolan.__file__)))
        target = os.path.join(tempfile.mkdtemp(prefix="portolan-"), "portolan")
        context.addPyFile(shutil.make_archive(target, "zip", root, "portolan"))
        _shipped.add(context.applicationId)
