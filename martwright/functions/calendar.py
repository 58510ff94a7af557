"""Calendar parts of a date and the date dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.functions.numeric import col

CALENDAR_EPOCH = dt.date(1970, 1, 1)


def date_key(value: Column | str, epoch: dt.date = CALENDAR_EPOCH) -> Column:
    """Sequential date id: 1 on the epoch day."""
    return (F.datediff(col(value), F.lit(epoch)) + 1).cast("bigint")


def build_dim_date(spark: SparkSession, start: dt.date, end: dt.date, epoch: dt.date | None = None) -> DataFrame:
    """One row per day from `start` to `end`, numbered from `epoch` (by default from `start`).

    Built on `range`, so Catalyst knows its exact size and decides on broadcasting by itself.
    """
    epoch = epoch or start
    days = (end - start).days + 1
    date = F.date_add(F.lit(start), F.col("id").cast("int"))
    return spark.range(max(days, 0), numPartitions=1).select(
        (F.col("id") + F.lit((start - epoch).days + 1)).alias("date_id"),
        date.alias("full_date"),
        F.year(date).alias("year"),
        F.quarter(date).alias("quarter"),
        F.month(date).alias("month"),
        F.date_format(date, "MMMM").alias("month_name"),
        F.weekofyear(date).alias("week"),
        F.weekday(date).alias("day_of_week"),
        F.date_format(date, "EEEE").alias("day_name"),
        F.when(F.weekday(date) >= 5, 1).otherwise(0).alias("is_weekend"),
    )
