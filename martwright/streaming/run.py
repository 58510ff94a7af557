"""Structured Streaming runs with idempotent sinks.

A micro-batch writes the folder that carries its batch id, replacing what an earlier try of the same
batch left there. With the query's checkpoint that makes every result exactly-once. Readers fold
the folders: window cells and lateness by their sums. No run keeps state in the stream.

What a batch is compared with to find copies is the stored events. Where copies carry the time of their
event (`slot`), events lie in folders by slot of time, and a batch opens those of its own slots alone: what
it lists and reads does not grow with the events of other times. Otherwise it reads the ids of all.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from martwright.operators import keyed
from martwright.sources import schemas
from martwright.sources import tables as store
from martwright.sources.tables import read_parquet
from martwright.streaming import events as ev

CELLS = ("window_start timestamp, customer_id bigint, channel string, event_type string, n bigint, "
         "amount decimal(28,2), batch bigint")
MAX_SLOTS = 1000  # a batch of more slots of time reads the ids of all; the result is the same
SLOT, NO_TIME = "slot", -1 << 62
LATENESS = "processed bigint, late_events bigint, last_event_time timestamp"
ARRIVAL = ("processing_time", "event_id")


def _batch_folder(sink: str, part: str, batch_id: int) -> str:
    return f"{sink.rstrip('/')}/{part}/batch={batch_id}"


def _start(df: DataFrame, write, mode: str, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _fresh(batch: DataFrame, batch_id: int, folder: str, order: Sequence[str], slot: int | None = None) -> DataFrame:
    """The first copy, by arrival, of each event of a micro-batch that no earlier batch stored; stored itself.

    What is known of earlier events is the stored table and no state of the stream, so events of any
    age are told apart and none is dropped for being late. With `slot`, the seconds of a slot of event time,
    copies are looked for among the events of the same slot; those without a time share one.
    """
    if slot:
        return _fresh_of_slots(batch, batch_id, folder, order, slot)
    spark = batch.sparkSession
    first = ev.dedup_events(batch, order=F.struct(*order))
    earlier = read_parquet(spark, folder, "event_id string, batch bigint").filter(F.col("batch") < batch_id)
    path = f"{folder}/batch={batch_id}"
    first.join(earlier.select("event_id"), "event_id", "left_anti").write.mode("overwrite").parquet(path)
    return spark.read.schema(batch.schema).parquet(path)


def _fresh_of_slots(batch: DataFrame, batch_id: int, folder: str, order: Sequence[str], slot: int) -> DataFrame:
    """`_fresh` over folders by slot of time; a copy is an event of the same id and slot."""
    spark, columns = batch.sparkSession, batch.columns
    placed = F.coalesce(F.floor(F.unix_seconds("event_time") / slot), F.lit(NO_TIME)).cast("bigint")
    batch = batch.withColumn(SLOT, placed)
    slots = [r[SLOT] for r in batch.select(SLOT).distinct().limit(MAX_SLOTS + 1).collect()]
    first = keyed.first_by(batch, ["event_id", SLOT], F.struct(*order))
    earlier = stored_slots(spark, folder, "event_id string", slots).filter(F.col("batch") < batch_id)
    fresh = first.join(earlier, ["event_id", SLOT], "left_anti").withColumn("batch", F.lit(batch_id).cast("bigint"))
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(SLOT, "batch").parquet(folder)
    return stored_slots(spark, folder, batch.select(*columns).schema, slots, batch_id).select(*columns)


def stored_slots(spark: SparkSession, folder: str, wanted: str | StructType, slots: Sequence[int], batch_id: int | None = None) -> DataFrame:
    """The named columns, slot and batch of the stored events of some slots, or of all when there are more than MAX_SLOTS.

    Only the folders of these slots, or those of one batch in them, are listed.
    """
    wanted = StructType.fromDDL(wanted) if isinstance(wanted, str) else wanted
    ddl = StructType([*wanted.fields, StructField(SLOT, LongType()), StructField("batch", LongType())])
    if len(slots) > MAX_SLOTS:
        found = read_parquet(spark, folder, ddl)
        return found if batch_id is None else found.filter(F.col("batch") == batch_id)
    below = "" if batch_id is None else f"/batch={batch_id}"
    paths = [p for s in slots if store.exists(spark, p := f"{folder}/{SLOT}={s}{below}")]
    if not paths:
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).option("basePath", folder).parquet(*paths)


def run_events(stream: DataFrame, sink: str, checkpoint: str, order: Sequence[str] = ARRIVAL,
               available_now: bool = True, slot: int | None = None) -> StreamingQuery:
    """Deduplicated events, each stored once: the copy that came first.

    `slot`: copies carry the time of their event and are looked for only in its slot of so many seconds. A sink keeps
    to one slot for good.
    """
    columns = schemas.names(schemas.STREAM_EVENTS)

    def write(batch: DataFrame, batch_id: int) -> None:
        _fresh(batch.select(*dict.fromkeys([*columns, *order])), batch_id, f"{sink.rstrip('/')}/stream_events", order, slot)

    return _start(stream, write, "append", checkpoint, available_now)


def run_windows(stream: DataFrame, sink: str, checkpoint: str, size: str = "10 seconds", slide: str | None = None,
                order: Sequence[str] = ARRIVAL, available_now: bool = True) -> StreamingQuery:
    """Window cells of the deduplicated stream.

    Each batch stores the cells of its own new events; readers add them up, so an event that comes late
    changes its window however old that is.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        fresh = _fresh(batch, batch_id, f"{sink.rstrip('/')}/windows_events", order)
        ev.window_cells(fresh, size, slide).write.mode("overwrite").parquet(_batch_folder(sink, "window_cells", batch_id))

    return _start(stream, write, "append", checkpoint, available_now)


def run_lateness(stream: DataFrame, sink: str, checkpoint: str, order: Sequence[str] = ARRIVAL,
                 available_now: bool = True) -> StreamingQuery:
    """Late events per micro-batch, in arrival order across batches.

    All that one batch takes from those before it is the time of the last event, in the row of the
    batch before.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        fresh = _fresh(batch, batch_id, f"{sink.rstrip('/')}/lateness_events", order)
        _write_lateness(fresh, sink, batch_id, order)

    return _start(stream, write, "append", checkpoint, available_now)


def run_all(stream: DataFrame, sink: str, checkpoint: str, size: str = "10 seconds", slide: str | None = None,
            order: Sequence[str] = ARRIVAL, available_now: bool = True, copies_slot: int | None = None) -> StreamingQuery:
    """Events, window cells and lateness by one query: the stream is read once, and each event is stored and told from its copies once.

    Read the results with `read_events`, `read_windows` and `read_lateness`. `copies_slot` is the `slot` of `run_events`.
    """
    columns = schemas.names(schemas.STREAM_EVENTS)

    def write(batch: DataFrame, batch_id: int) -> None:
        fresh = _fresh(
            batch.select(*dict.fromkeys([*columns, *order])), batch_id, f"{sink.rstrip('/')}/stream_events", order, copies_slot)
        ev.window_cells(fresh, size, slide).write.mode("overwrite").parquet(_batch_folder(sink, "window_cells", batch_id))
        _write_lateness(fresh, sink, batch_id, order)

    return _start(stream, write, "append", checkpoint, available_now)


def _write_lateness(fresh: DataFrame, sink: str, batch_id: int, order: Sequence[str]) -> None:
    before = read_parquet(fresh.sparkSession, _batch_folder(sink, "lateness", batch_id - 1), LATENESS)
    carried = before.agg(F.max("last_event_time")).scalar()
    late = F.coalesce(F.col("event_time") < F.coalesce("watermark", carried), F.lit(False))
    ev.late_events(fresh, order).withColumn("late", late).agg(
        F.count("*").alias("processed"),
        F.count_if("late").alias("late_events"),
        F.coalesce(F.max_by("event_time", F.struct(*order)), carried).alias("last_event_time"),
    ).write.mode("overwrite").parquet(_batch_folder(sink, "lateness", batch_id))


def read_events(spark: SparkSession, sink: str) -> DataFrame:
    return read_parquet(spark, f"{sink.rstrip('/')}/stream_events", schemas.STREAM_EVENTS + ", batch bigint").select(
        *schemas.names(schemas.STREAM_EVENTS))


def read_cells(spark: SparkSession, sink: str) -> DataFrame:
    """Every window cell, summed over the batches that added to it."""
    cells = read_parquet(spark, f"{sink.rstrip('/')}/window_cells", CELLS)
    return cells.groupBy(*ev.CELL).agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"))


def read_windows(spark: SparkSession, sink: str) -> DataFrame:
    return ev.window_summary(read_cells(spark, sink))


def publish_windows(spark: SparkSession, sink: str, root: str) -> int:
    """Commit the windows as they stand to the warehouse table `stream_windows`; returns their number.

    Run it after any batch: the reports read the committed table, whole and of one moment.
    """
    snapshot = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S%f")
    rows = store.write_snapshot(read_windows(spark, sink), root, "stream_windows", snapshot, schemas.names(schemas.STREAM_WINDOWS))
    store.commit(spark, root, snapshot, ["stream_windows"])
    return rows


def read_lateness(spark: SparkSession, sink: str) -> DataFrame:
    return read_parquet(spark, f"{sink.rstrip('/')}/lateness", LATENESS + ", batch bigint").agg(
        F.coalesce(F.sum("processed"), F.lit(0)).alias("processed"),
        F.coalesce(F.sum("late_events"), F.lit(0)).alias("late_events"))
