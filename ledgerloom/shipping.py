"""Make this package importable in the cluster's Python workers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package's sources to the executors through Spark's own file distribution, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    folder = Path(tempfile.mkdtemp(prefix="ledgerloom-src-"))
    archive = folder / "ledgerloom_sources.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # tasks may fetch it until the application ends
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
