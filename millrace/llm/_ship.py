"""Puts this package where Python workers find it, whatever folder the driver was started in."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


#: Bytes of a batch of rows on its way to Python, unless the session says otherwise than Spark's 64 MB. Texts are long: tasks
#: hold several batches at a time.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once an application; the driver serves the archive."""
    if spark.conf.get(BATCH).rstrip("b") == str(64 << 20):
        spark.conf.set(BATCH, str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="millrace-")) / f"millrace-{context.applicationId}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
