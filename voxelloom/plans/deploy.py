"""Makes this package importable in Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()
#: Rows of a batch that goes to a Python worker: texts and planes are long, so fewer than Spark's default.
BATCH_ROWS = "2000"
_SETTING, _DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def ship(spark: SparkSession) -> None:
    """Hand the package to the executors through Spark's own file distribution, once an application; batches are kept small
    in a session that doesn't set them."""
    if spark.conf.get(_SETTING, _DEFAULT) == _DEFAULT:
        spark.conf.set(_SETTING, BATCH_ROWS)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="voxelloom-code-")) / "voxelloom.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)
