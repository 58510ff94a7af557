"""Adding columns with Arrow batches, a bounded number of bytes at a time."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

SLAB = 4 << 20  # bytes of text that one call of a batch function sees; one longer text comes alone


def unused(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have, made from `name`."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sizes(column: pa.Array) -> np.ndarray:
    """Bytes of every text or binary value, elements of every list; a null has none."""
    kind = column.type
    length = pc.list_value_length if pa.types.is_list(kind) or pa.types.is_large_list(kind) else pc.binary_length
    return pc.fill_null(length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def slabs(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLAB) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most `limit` bytes (or list elements) of the column `text`, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        total = np.cumsum(sizes(batch.column(batch.schema.get_field_index(text))))
        start = 0
        while start < batch.num_rows:
            base = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, base + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, text: str) -> list[str]:
    """Texts of a batch; null counts as empty."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(text)).to_pylist()]


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An array of lists from flat values and the length of each list."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def give_back() -> None:
    """Hand freed memory of this Python worker, which goes on to other tasks, back to the machine: Arrow's, and the C library's where it can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def batchwise(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run` for `mapInArrow`; what it held is handed back when its task ends."""

    def task(batches):
        yield from run(batches)
        give_back()

    return task


def groupwise(make: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """`make` for `applyInArrow`; what it held is handed back after each group."""

    def group(table):
        made = make(table)
        give_back()
        return made

    return group


def with_columns(df: DataFrame, text: str, fields: str, make: Callable[[pa.RecordBatch], list],
                 limit: int = SLAB) -> DataFrame:
    """`df` with the columns of `fields` (a DDL string), made by `make` from one slice of rows
    (`limit` bytes of text) at a time.

    All other columns pass through; one that has a new column's name gives way to it.
    """
    added = StructType.fromDDL(fields)
    kept = [f for f in df.schema.fields if f.name not in added.names]
    names = [f.name for f in kept] + added.names
    read = df.select(*[f.name for f in kept], *([] if text in [f.name for f in kept] else [text]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slabs(batches, text, limit):
            columns = [part.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays(columns + make(part), names=names)

    return read.mapInArrow(batchwise(run), StructType(kept + added.fields))
