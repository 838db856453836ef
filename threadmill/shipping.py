"""The package as an archive for the Python workers of a cluster."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand the package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
