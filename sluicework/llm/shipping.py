"""Makes this package importable in Spark's Python workers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hands the package to the application's workers, once.

    The driver serves the archive as long as it runs, so late executors get it too.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="sluicework-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    files = Path(folder) / "files"
    shutil.copytree(package, files / package.name, ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(str(Path(folder) / package.name), "zip", files))
    _shipped.add(context.applicationId)
