"""The package's source on the executors, so that tasks import it by name and keep its tables while a worker lives."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package to the files Spark sends to every executor; once per application.

    The archive is built in the driver's own temporary folder, which only the driver reads: Spark serves it.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="gridmend-package-")), "gridmend-package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as packed:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    packed.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)
