"""Events: source, flattening, deduplication, windows and lateness.

The window and deduplication functions take batch frames and streams alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.functions.numeric import half_up
from martwright.operators import keyed
from martwright.operators.ordered import Ordered
from martwright.sources import schemas

# Window columns by the event type they count.
COUNTED = {"page_views": "page_view", "purchases": "purchase", "add_to_cart": "add_to_cart", "searches": "search"}
CELL = ["window_start", "customer_id", "channel", "event_type"]
CENTS = "decimal(18,2)"


def event_source(spark: SparkSession, path: str, ddl: str = schemas.EVENT, files_per_batch: int = 100,
                 file_format: str = "json") -> DataFrame:
    """A folder of event files as a stream; `files_per_batch` bounds a micro-batch."""
    return (
        spark.readStream.format(file_format).schema(ddl).option("maxFilesPerTrigger", files_per_batch).load(path))


def flatten(events: DataFrame) -> DataFrame:
    """Lift the nested metadata to columns."""
    return events.select(
        "event_id", "event_type", "customer_id", "event_time", "processing_time", "channel", "metadata.page",
        "metadata.session_id", "metadata.value")


def dedup_events(df: DataFrame, key: str = "event_id", order: Column | str = "processing_time") -> DataFrame:
    """Batch: the first arrival of every event id."""
    return keyed.first_by(df, [key], order)


def minute_bucket(time: Column | str, seconds: int) -> Column:
    """Window start that floors the seconds within their minute.

    For sizes that divide 60 this is `window(time, size).start`; others start anew every minute, and
    sizes above 60 act like 60.
    """
    time = F.col(time) if isinstance(time, str) else time
    start = F.floor(F.second(time) / seconds) * seconds
    return F.date_trunc("minute", time) + F.make_dt_interval(secs=start)


def window_cells(df: DataFrame, size: str, slide: str | None = None) -> DataFrame:
    """Counts and values per window, customer, channel and event type.

    Cells add up to every figure of a window, distinct customers included, and keep a busy window
    spread over as many groups as it has customers.
    """
    window = F.window("event_time", size, slide)
    return (
        df.groupBy(window.alias("window"), "customer_id", "channel", "event_type")
        .agg(F.count("*").alias("n"), F.sum(F.col("value").cast(CENTS)).alias("amount"))
        .select(F.col("window.start").alias("window_start"), "customer_id", "channel", "event_type", "n", "amount")
    )


def window_summary(cells: DataFrame) -> DataFrame:
    """One row per window from its cells."""
    counted = {
        out: F.coalesce(F.sum(F.when(F.col("event_type") == kind, F.col("n"))), F.lit(0)) for out, kind in COUNTED.items()}
    return cells.groupBy("window_start").agg(
        F.sum("n").alias("total_events"),
        F.coalesce(F.sum("amount").cast("double"), F.lit(0.0)).alias("total_revenue"),
        F.countDistinct("customer_id").alias("unique_customers"),
        *[c.alias(out) for out, c in counted.items()],
    )


def window_aggregate(df: DataFrame, size: str = "10 seconds", slide: str | None = None) -> DataFrame:
    """Batch: one row per tumbling (or sliding) window."""
    return window_summary(window_cells(df, size, slide))


def window_breakdown(cells: DataFrame, by: str) -> DataFrame:
    """Events per window and value of `by` (event type or channel)."""
    return cells.groupBy("window_start", by).agg(F.sum("n").alias("events"))


def window_maps(cells: DataFrame) -> DataFrame:
    """Per window the maps event type -> events and channel -> events (a handful of keys each)."""
    def as_map(by: str, out: str) -> DataFrame:
        entries = F.sort_array(F.collect_list(F.struct(F.col(by), F.col("events"))))
        return window_breakdown(cells, by).groupBy("window_start").agg(F.map_from_entries(entries).alias(out))

    return as_map("event_type", "events_by_type").join(as_map("channel", "channels"), "window_start")


def all_windows(windows: DataFrame) -> DataFrame:
    return windows.orderBy("window_start")


def stream_windows_latest(windows: DataFrame, limit: int = 50) -> DataFrame:
    return windows.orderBy(F.desc("window_start")).limit(limit)


def late_events(df: DataFrame, order: Sequence[str], time: str = "event_time") -> DataFrame:
    """Events in arrival order with the watermark they met and whether they came late.

    The watermark is the time of the event processed just before; it may fall again and drops
    nothing. `order` must be unique.
    """
    return Ordered.of(df, list(order)).previous([time], "_previous").plain().withColumns({
        "watermark": F.col(f"_previous.{time}"),
        "is_late": F.coalesce(F.col(time) < F.col(f"_previous.{time}"), F.lit(False)),
    }).drop("_previous")


def stream_summary(sent: DataFrame, processed: DataFrame, late: DataFrame, windows: DataFrame) -> DataFrame:
    """Totals of a run: processed, duplicates, late, windows, revenue and busiest window."""
    rows = F.count("*")
    totals = windows.agg(
        rows.alias("windows"),
        half_up(F.sum(F.col("total_revenue").cast(CENTS)), 2).alias("total_revenue"),
        F.max("unique_customers").alias("peak_customers"))
    done = processed.agg(rows).scalar()
    return totals.select(
        done.alias("processed"),
        (sent.agg(rows).scalar() - done).alias("duplicates"),
        late.agg(F.count_if("is_late")).scalar().alias("late_events"),
        "windows",
        "total_revenue",
        "peak_customers",
    )
