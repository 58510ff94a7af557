"""Session building and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "martwright", master: str | None = None, shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A UTC session with AQE on.

    On a cluster leave `master` and `shuffle_partitions` unset: spark-submit supplies the first, and
    AQE coalesces from the cluster's own partition count. Further settings go by keyword with `__`
    for the dots: `spark__driver__memory="8g"`.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


ROWS_A_TASK = 1 << 17  # rows that one task of a shuffle gets, on average
FEW_ROWS = 1 << 12  # no task gets fewer only to keep another core busy
SPLIT = "8m"  # of a file that one task reads, where nothing else than Spark's 128 MB is set


def tasks_for(spark: SparkSession, rows: int) -> int:
    """How many tasks a shuffle of so many rows is dealt to."""
    return max(1, -(-rows // ROWS_A_TASK), min(spark.sparkContext.defaultParallelism, rows // FEW_ROWS))


@contextmanager
def dealt_by_rows(spark: SparkSession, rows: int) -> Iterator[int]:
    """Shuffles that run inside are dealt to as many tasks as `rows`, the most that any of them carries, ask for; scans read smaller splits.

    AQE joins shuffle partitions by their compressed bytes, or by the number of cores. Keys, dates and short repeated texts are a
    few bytes a row there and hundreds once a task sorts and joins them, so that a task's memory would grow with the input. Skewed
    joins are still split by AQE. Frames that are made inside and run later have the session's own settings.
    """
    held = {"spark.sql.shuffle.partitions": str(tasks := tasks_for(spark, rows)), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    if spark.conf.get("spark.sql.files.maxPartitionBytes") == f"{128 << 20}b":
        held["spark.sql.files.maxPartitionBytes"] = SPLIT
    before = {key: spark.conf.get(key) for key in held}
    for key, value in held.items():
        spark.conf.set(key, value)
    try:
        yield tasks
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


_LOCAL_FOLDERS: dict[str, str] = {}  # by application, for local sessions without a setting


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local master may fall back to a temporary folder: on a cluster that folder would exist on
    one machine and the data in it would be lost with that machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="martwright-")
    return _LOCAL_FOLDERS[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared folder and go on from the written table.

    Values that depend on how rows were laid out (partition ids, positions) must not be worked out
    twice, and a written table outlives the executors that produced it. Parquet rather than a
    checkpoint: later steps read only the columns they need, and Spark knows the table's size when it
    chooses a join.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
