"""Makes this package importable in the executors' Python workers."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package to the application's Python files, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    with tempfile.TemporaryDirectory() as tmp:
        stage = Path(tmp, "stage")
        shutil.copytree(root, stage / root.name, ignore=shutil.ignore_patterns("__pycache__"))
        keep = tempfile.mkdtemp(prefix="emberline-py-")
        sc.addPyFile(shutil.make_archive(f"{keep}/{root.name}", "zip", stage))
    _SHIPPED.add(sc.applicationId)
