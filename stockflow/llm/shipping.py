"""The package's own code on the executors."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

import stockflow

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Spark hand this package to all Python workers, once per application.

    Tasks import their functions by name, so a cluster on which the package is not installed
    needs it. The archive is made on the driver; Spark copies it.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    root = os.path.dirname(os.path.dirname(os.path.abspath(stockflow.__file__)))
    folder = tempfile.mkdtemp(prefix="package-")
    clean = os.path.join(folder, "code", "stockflow")
    shutil.copytree(os.path.join(root, "stockflow"), clean, ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(os.path.join(folder, "stockflow"), "zip", os.path.join(folder, "code")))
