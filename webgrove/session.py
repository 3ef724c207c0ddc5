"""Session settings that suit wide page rows, and the package on the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path
from types import ModuleType

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows hold whole pages: bound batches by bytes, not by row count alone.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings a running session can change, and ship the package.

    Not needed where the package is installed on every executor and the cluster
    sets these values.
    """
    import webgrove

    if "webgrove" in spark.__dict__.get("_configured_for", ()):
        return spark
    spark._configured_for = {"webgrove"}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.startswith("local["):
        spark._own_folder = tempfile.mkdtemp(prefix="run-")     # one process: driver and tasks share its disk
    ship(spark, webgrove)
    return spark


def ship(spark: SparkSession, package: ModuleType) -> None:
    """Make a pure Python package importable in the tasks, once per application."""
    context = spark.sparkContext
    shipped = context.__dict__.setdefault("_shipped_packages", set())
    if package.__name__ in shipped:
        return
    root = Path(package.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="run-")) / f"{package.__name__}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))     # copied to the executors by Spark
    shipped.add(package.__name__)
