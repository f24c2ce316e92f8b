"""The package on every executor, also where it is not installed there."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import ticketlens

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hands the package's source files to the executors, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(ticketlens.__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="ticketlens-")) / f"ticketlens-{app}.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)
