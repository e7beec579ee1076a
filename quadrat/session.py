"""The session settings that the operators rely on."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def builder(master: str | None = None, partitions: int | None = None) -> SparkSession.Builder:
    """UTC times, adaptive plans and Arrow; nothing else is fixed, so a cluster's own settings hold."""
    b = SparkSession.builder.appName("quadrat")
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    return b.config(map=settings)


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers of this application, once: executors need not have it on their own path.

    Functions that are sent to workers name the package's modules, which the driver alone may be able to import.
    The driver keeps the file and serves it, so executors that start late find it whatever becomes of the shared folder.
    """
    sc, root = spark.sparkContext, Path(__file__).resolve().parent
    if getattr(sc, "_quadrat_shipped", False):
        return
    at = f"{tempfile.mkdtemp(prefix='quadrat-code-', dir=sc._temp_dir)}/quadrat-{uuid.uuid4().hex}.zip"  # goes with the application
    with zipfile.ZipFile(at, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*")):
            if f.suffix in (".py", ".csv"):
                z.write(f, f"quadrat/{f.relative_to(root)}")
    sc.addPyFile(at)
    sc._quadrat_shipped = True
