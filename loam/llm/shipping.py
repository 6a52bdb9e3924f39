"""Makes the package importable on executors, whatever their PYTHONPATH."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import loam

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package's sources to the executors once per application, as a py-file."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(loam.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="loam-src-"), "loam_sources.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
