"""Make the package importable in Spark's Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import tillwork

_shipped: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Hand the package's source to the executors, once for each application.

    Workers unpickle functions by module name; Spark serves the archive from the driver.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = os.path.dirname(os.path.abspath(tillwork.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tillwork-source-"), "tillwork.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join("tillwork", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(archive)
    _shipped[application] = archive
