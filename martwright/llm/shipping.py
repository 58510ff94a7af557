"""Getting a session ready for operators that run Python functions of this package on texts."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

ROWS = "1000"  # of texts that travel between Spark and a Python worker at a time, where nothing else is set
BYTES = str(4 << 20)  # of a batch of rows, likewise
_shipped: set[str] = set()  # applications


def ship(spark: SparkSession) -> None:
    """Send the package to all executors once per application, as `spark-submit --py-files` would.

    Not needed where the package is installed on all machines. Also makes batches of rows smaller than
    Spark's own 10,000 rows and 64 MB, of which the JVM and the Python worker hold several; any other setting stays.
    """
    for limit, usual, ours in (("maxRecordsPerBatch", "10000", ROWS), ("maxBytesPerBatch", f"{64 << 20}b", BYTES)):
        if spark.conf.get(f"spark.sql.execution.arrow.{limit}") == usual:
            spark.conf.set(f"spark.sql.execution.arrow.{limit}", ours)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        base = Path(tempfile.mkdtemp(prefix=f"{package.name}-")) / package.name
        context.addPyFile(shutil.make_archive(str(base), "zip", package.parent, package.name))
        _shipped.add(context.applicationId)
