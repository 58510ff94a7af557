"""Stored histories of dimensions: versions in buckets of the key, all given changes and the change log.

A batch reads and writes only the buckets that its keys are in. Versions, given changes, log entries and changes that
come before the first version become visible in one commit.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martwright.operators import scd
from martwright.session import ROWS_A_TASK, cut, dealt_by_rows
from martwright.sources import schemas
from martwright.sources import tables as store

BUCKETS = 64  # of a history; a number that its tables keep for good
BUCKET = "bucket"


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(BUCKETS)).cast("int")


def _write(df: DataFrame, root: str, name: str, snapshot: str, most: int) -> int:
    """Write rows that have their bucket, `most` of them at most, in a few files each or as many as their number asks for."""
    files = max(8, -(-most // (BUCKETS * ROWS_A_TASK)))
    dealt = df.repartition(BUCKET, F.pmod(F.xxhash64(*[c for c in df.columns if c != BUCKET][:2]), F.lit(files)))
    return store.write_snapshot(dealt, root, name, snapshot, partition_by=[BUCKET])


def open_history(spark: SparkSession, root: str, table: str, ddl: str | StructType | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
    """The committed versions of a dimension; none when its history was not started."""
    return store.read_parts(spark, root, f"{table}_history", ddl or schemas.HISTORY[table], BUCKET, buckets).drop(BUCKET)


def start(spark: SparkSession, root: str, table: str, dim: DataFrame, at: Column | dt.datetime, key: str | None = None) -> int:
    """Store version 1 of every row of a dimension, whose key is its first column if not named; returns how many there are."""
    snapshot = store.new_snapshot()
    first = scd.scd2_init(dim, at).withColumn(BUCKET, bucket_of(key or dim.columns[0]))
    with dealt_by_rows(spark, most := dim.count()):
        rows = _write(first, root, f"{table}_history", snapshot, most)
    every = list(range(BUCKETS))
    store.commit_parts(spark, root, snapshot, {f"{table}_{part}": every for part in ("history", "changes", "log")})
    return rows


def apply(spark: SparkSession, root: str, table: str, changes: DataFrame, key: str, tracked: Sequence[str], at: str,
          tie_break: Sequence[str] = (), ddl: str | StructType | None = None) -> int:
    """Apply a batch of changes, of any time, to the stored history; returns how many entries of the log it wrote.

    The same changes give the same history in whatever batches and order they come; a failed or repeated batch changes nothing.
    Changes that are not later than the first version of their key are kept aside (`late_changes`). A tracked column that a batch
    does not have is NULL in all its rows, which leaves the value as it is.
    """
    types = {f.name: f.dataType for f in open_history(spark, root, table, ddl, []).schema.fields}
    given = {c: F.col(c) if c in changes.columns else F.lit(None) for c in dict.fromkeys([key, at, *tracked, *tie_break])}
    batch = changes.select(*[v.cast(types[c]).alias(c) if c in tracked else v.alias(c) for c, v in given.items()])
    with dealt_by_rows(spark, changes.count()):
        batch = cut(batch.filter(F.col(key).isNotNull()).distinct().withColumn(BUCKET, bucket_of(key)))
    touched = sorted(r[0] for r in batch.select(BUCKET).distinct().collect())
    snapshot, given = store.new_snapshot(), batch.drop(BUCKET)
    before = open_history(spark, root, table, ddl, touched)
    known = store.read_parts(spark, root, f"{table}_changes", given.schema, BUCKET, touched)
    most = batch.count() + before.count() + known.count()  # each change makes one version and one entry of the log at most
    with dealt_by_rows(spark, most):
        after, log, rebuilt = scd.scd2_splice(before, known, given, key, tracked, at, tie_break)
        old_log = store.read_parts(spark, root, f"{table}_log", schemas.CHANGE_LOG, BUCKET, touched)
        log = cut(log.withColumn(BUCKET, bucket_of("record_id")).select(
            F.lit(table).alias("table_name"), F.col("record_id").cast("string").alias("record_id"), *[c for c in log.columns if c != "record_id"], BUCKET))
        again = rebuilt.select(F.col(key).cast("string").alias("record_id"))

        _write(after.withColumn(BUCKET, bucket_of(key)), root, f"{table}_history", snapshot, most)
        _write(known.unionByName(batch).distinct(), root, f"{table}_changes", snapshot, most)
        _write(old_log.join(again, "record_id", "left_anti").unionByName(log), root, f"{table}_log", snapshot, most)
    store.commit_parts(spark, root, snapshot, {f"{table}_{part}": touched for part in ("history", "changes", "log")})
    return log.count()


def change_log(spark: SparkSession, root: str, table: str = "dim_customers") -> DataFrame:
    """The changes that have effect, of all batches."""
    return store.read_parts(spark, root, f"{table}_log", schemas.CHANGE_LOG, BUCKET).drop(BUCKET)


def late_changes(spark: SparkSession, root: str, table: str, key: str, at: str, changes: str | StructType, ddl: str | StructType | None = None) -> DataFrame:
    """The given changes that have no place in the history because they are not later than the first version of their key.

    `changes` is the type of the stored changes."""
    given = store.read_parts(spark, root, f"{table}_changes", changes, BUCKET).drop(BUCKET)
    first = open_history(spark, root, table, ddl).filter("version = 1").select(F.col(key).alias("_key"), F.col("effective_from").alias("_since"))
    return given.join(first, (F.col(key) == F.col("_key")) & (F.col(at).cast("timestamp") <= F.col("_since")), "left_semi")
