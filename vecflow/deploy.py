"""Making the package importable in Python workers, wherever they run."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers of a session, once per application.

    Not needed where the package is installed on the cluster or was given with
    ``--py-files``.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(
        f"{tempfile.mkdtemp(prefix='vecflow-package-')}/vecflow", "zip", package.parent, package.name
    )
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)
