"""First-wins, last-wins and upsert over keyed rows, without windows.

`min_by` and `max_by` combine before the shuffle, so a key with a third of all rows reaches its
reducer as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Column, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    chosen = df.groupBy(*keys).agg(pick(F.struct(*rest), order).alias("_row"))
    return chosen.select(*keys, "_row.*").select(*df.columns)


def first_by(df: DataFrame, keys: Sequence[str], order: Column | str) -> DataFrame:
    """The row with the smallest `order` per key."""
    return _pick(df, list(keys), F.col(order) if isinstance(order, str) else order, F.min_by)


def last_by(df: DataFrame, keys: Sequence[str], order: Column | str) -> DataFrame:
    """The row with the largest `order` per key."""
    return _pick(df, list(keys), F.col(order) if isinstance(order, str) else order, F.max_by)


def insert_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Column | str) -> DataFrame:
    """Rows of `batch` to append: the first of each key that `target` does not hold yet."""
    return first_by(batch, keys, order).join(target.select(*keys), list(keys), "left_anti").select(*batch.columns)


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Column | str) -> DataFrame:
    """`target` with its rows replaced by the last row of `batch` for the same key."""
    newest = last_by(batch, keys, order).select(*target.columns)
    return target.join(newest.select(*keys), list(keys), "left_anti").unionByName(newest)
