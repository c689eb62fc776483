"""Session settings the operators are designed around."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: partition coalescing and skewed-partition splitting.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Wide vector rows: smaller Arrow batches keep Python worker memory flat.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    # Recording the Python line of every Column call slows long plans down.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


_shipped: set[str] = set()


def build(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send the package's source to the Python workers, which need no path of their own then.

    The archive is a few hundred kilobytes; Spark's file server hands it out, so
    driver and executors share no folder for it.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="catalogops-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # tasks fetch it until the end
    archive = Path(folder) / "catalogops_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, f"{root.name}/{source.relative_to(root)}")
    spark.sparkContext.addPyFile(str(archive))
