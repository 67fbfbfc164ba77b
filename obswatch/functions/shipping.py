"""Sends this package to executors that don't have it."""

from __future__ import annotations

import atexit
import pathlib
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Once a Spark context; Python functions of this package can then run anywhere."""
    sc = spark.sparkContext
    if getattr(sc, "_obswatch_files", False):
        return
    root = pathlib.Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="ship_")  # Spark serves the file from here until the driver ends
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = f"{folder}/{root.name}-{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(path)
    sc._obswatch_files = True
