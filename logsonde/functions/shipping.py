"""Getting this package onto the executors, for the tasks that run its Python functions."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

import logsonde

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Adds the package to the Python path of all executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(logsonde.__file__))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="logsonde-"), "logsonde"), "zip", os.path.dirname(package), "logsonde"
    )
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
