"""Bring this package to Python workers on executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_ARCHIVE = "tillscope_package.zip"


def ship_package(spark: SparkSession) -> None:
    """Send the package's source with the application, once; Spark copies it to every executor.

    Not needed where the package is installed on all machines or passed with ``--py-files``.
    """
    context = spark.sparkContext
    if any(str(path).endswith(_ARCHIVE) for path in context.listFiles):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="tillscope-package-")) / _ARCHIVE
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
