"""Makes this library importable in the Python processes of the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent.parent


def ship_library(spark: SparkSession) -> None:
    """Adds the package to the files of the application, once; Spark hands them to its executors."""
    context = spark.sparkContext
    if getattr(context, "_perkline_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="perkline-code-")) / "perkline.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(PACKAGE.rglob("*.py")):
            out.write(source, source.relative_to(PACKAGE.parent))
    context.addPyFile(str(archive))
    context._perkline_shipped = True
