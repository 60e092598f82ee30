"""Sends this package to the Python workers, and texts in batches they can hold."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Rows of an Arrow batch, unless the session has a number of its own; Spark's default is meant for
#: numbers, not for whole texts.
BATCH_ROWS = "2000"
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"

_sent: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add the package to the session's Python files, once per application.

    Spark's own file server hands it to executors, so they need no shared folder for code.
    """
    context = spark.sparkContext
    if spark.conf.get(_BATCH_CONF) == "10000":
        spark.conf.set(_BATCH_CONF, BATCH_ROWS)
    if context.applicationId in _sent:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    _sent.add(context.applicationId)
