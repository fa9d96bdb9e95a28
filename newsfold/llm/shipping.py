"""Sending this package to the executors, whose tasks import it."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to all executors once per application, as ``--py-files`` would."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(application)
