"""Make the package importable in the Python workers of the executors."""

from __future__ import annotations

import shutil
from pathlib import Path

from pyspark import SparkFiles
from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to every executor, once per Spark application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    folder = Path(SparkFiles.getRootDirectory()) / "packages"  # removed by Spark at its end
    folder.mkdir(exist_ok=True)
    archive = shutil.make_archive(
        str(folder / package.name), "zip", root_dir=package.parent, base_dir=package.name
    )
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
