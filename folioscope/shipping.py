"""Getting this package to Python workers on clusters where it isn't installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession | None = None) -> None:
    """Adds the package to the session's Python files, once per application."""
    spark = spark or SparkSession.getActiveSession()
    if spark is None or spark.sparkContext.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp()) / f"{top.name}.zip"  # on the driver; Spark hands it to executors
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(spark.sparkContext.applicationId)
