"""Sending the library to the Python workers of a cluster."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the library to the workers, as --py-files would, once per application. Spark distributes the archive."""
    sc = spark.sparkContext
    if sc.applicationId in _sent:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="urlgauge-workers-")) / "urlgauge-core.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for file in sorted(package.rglob("*.py")):
            bundle.write(file, file.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _sent.add(sc.applicationId)
