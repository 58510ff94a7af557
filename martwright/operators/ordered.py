"""Order-dependent operators without a single-partition window.

`Ordered.of` sorts the rows globally once and labels each with the sort partition it fell into
(bucket) and its place there (pos). Every operator then works in two levels: a window inside the
bucket, and a carry from bucket to bucket over a small table. The sort order must be unique, so equal
values, or one key that owns a third of all rows, spread over as many buckets as their size asks for.

Bucket tables have one row per sort partition, a number that the session configuration fixes
(`spark.sql.shuffle.partitions`) and that does not grow with the data. So they may be broadcast,
scanned in one task, or read to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.session import cut

BUCKET, POS = "_bucket", "_pos"


@dataclass(frozen=True)
class Ordered:
    """Globally sorted rows; `by` names the leading sort columns that form groups, if any.

    `spans` lists the groups that reach over a bucket border. Sorted by group first, at most one
    group crosses each border.
    """

    rows: DataFrame
    by: tuple[str, ...] = ()
    spans: DataFrame | None = None

    @classmethod
    def of(cls, df: DataFrame, order: Sequence[Column | str], by: Sequence[str] = ()) -> Ordered:
        """Sort by `order`, which starts with `by` and is unique, and write the labelled rows once."""
        rows = df.orderBy(*order).withColumn("_row", F.monotonically_increasing_id())
        rows = cut(
            rows.withColumn(BUCKET, F.shiftright("_row", 33).cast("int"))
            .withColumn(POS, F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("_row")
        )
        return cls(rows, tuple(by), spanning(rows, by) if by else None)

    def plain(self) -> DataFrame:
        return self.rows.drop(BUCKET, POS)

    def cut(self) -> Ordered:
        """Write the rows, so that what follows does not work them out again."""
        return replace(self, rows=cut(self.rows))

    def filter(self, condition: Column) -> Ordered:
        return replace(self, rows=self.rows.filter(condition))

    def with_columns(self, columns: dict[str, Column]) -> Ordered:
        return replace(self, rows=self.rows.withColumns(columns))

    # numbering ----------------------------------------------------------------------------------

    @cached_property
    def _sizes(self) -> list[tuple[int, int]]:
        return sorted(tuple(r) for r in self.rows.groupBy(BUCKET).agg(F.count("*")).collect())

    def count(self) -> int:
        return sum(n for _, n in self._sizes)

    def row_number(self, out: str) -> Ordered:
        """Global row number: the place in the bucket after the rows of all earlier buckets."""
        offsets, before = [], 0
        for bucket, n in self._sizes:
            offsets.append((bucket, before))
            before += n
        table = self.rows.sparkSession.createDataFrame(offsets, f"{BUCKET} int, _before bigint")
        rows = self.rows.join(F.broadcast(table), BUCKET).withColumn(out, F.col(POS) + F.col("_before") + 1)
        return replace(self, rows=rows.drop("_before"))

    # carries ------------------------------------------------------------------------------------

    def _edges(self, *aggs: Column) -> DataFrame:
        """Aggregates per bucket, or per bucket and group for the groups that cross a border."""
        if not self.by:
            return self.rows.groupBy(BUCKET).agg(*aggs)
        crossing = self.rows.join(F.broadcast(self.spans), list(self.by), "left_semi")
        return crossing.groupBy(BUCKET, *self.by).agg(*aggs)

    def _in_bucket(self):
        return Window.partitionBy(BUCKET, *self.by).orderBy(POS)

    def _across(self):
        return Window.partitionBy(*self.by).orderBy(BUCKET)

    def _carry(self, rows: DataFrame, edges: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(edges), [BUCKET, *self.by], "left")

    def running_sum(self, value: str, out: str) -> Ordered:
        """Row-wise running sum, anew in every group."""
        rows = self._in_bucket().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before = F.sum("_sum").over(self._across().rowsBetween(Window.unboundedPreceding, -1))
        offsets = self._edges(F.sum(value).alias("_sum")).select(BUCKET, *self.by, before.alias("_before"))
        summed = self._carry(self.rows.withColumn(out, F.sum(value).over(rows)), offsets)
        whole = F.col(out) + F.coalesce(F.col("_before"), F.lit(0))
        return replace(self, rows=summed.withColumn(out, whole).drop("_before"))

    def running_sum_with_peers(self, value: str, out: str) -> Ordered:
        """Running sum over rows of falling `value`, where equal values share the sum through their last.

        This is the default RANGE frame. What equal values have in later buckets is added from there.
        """
        peers = Window.partitionBy(BUCKET).orderBy(F.desc(value))
        before = F.sum("_sum").over(Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1))
        offsets = self._edges(F.sum(value).alias("_sum")).select(BUCKET, before.alias("_before"))
        tied = Ordered(self.rows, (value,), spanning(self.rows, [value]))
        later = F.sum("_tied").over(tied._across().rowsBetween(1, Window.unboundedFollowing))
        ties = tied._edges(F.sum(value).alias("_tied")).select(BUCKET, value, later.alias("_later"))
        summed = tied._carry(self._carry(self.rows.withColumn(out, F.sum(value).over(peers)), offsets), ties)
        whole = F.col(out) + F.coalesce(F.col("_before"), F.lit(0)) + F.coalesce(F.col("_later"), F.lit(0))
        return replace(self, rows=summed.withColumn(out, whole).drop("_before", "_later"))

    def _shift(self, cols: Sequence[str], out: str, shift, border) -> Ordered:
        row = F.struct(*cols)
        at_border = self._edges(border(row, POS).alias("_row")).select(
            BUCKET, *self.by, shift("_row").over(self._across()).alias("_carried"))
        shifted = self._carry(self.rows.withColumn(out, shift(row).over(self._in_bucket())), at_border)
        return replace(self, rows=shifted.withColumn(out, F.coalesce(out, "_carried")).drop("_carried"))

    def previous(self, cols: Sequence[str], out: str) -> Ordered:
        """`lag(1)` of `cols` as a struct column, NULL on the first row of a group."""
        return self._shift(cols, out, F.lag, F.max_by)

    def following(self, cols: Sequence[str], out: str) -> Ordered:
        """`lead(1)` of `cols` as a struct column, NULL on the last row of a group."""
        return self._shift(cols, out, F.lead, F.min_by)

    def fill_forward(self, cols: Sequence[str]) -> Ordered:
        """Replace NULLs in `cols` by the last value before them in the group."""
        upto = self._in_bucket().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before = self._across().rowsBetween(Window.unboundedPreceding, -1)
        ends = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(POS))).alias(f"_{c}") for c in cols]
        carried = self._edges(*ends).select(
            BUCKET, *self.by, *[F.last(f"_{c}", ignorenulls=True).over(before).alias(f"_{c}") for c in cols])
        local = self.rows.withColumns({c: F.last(c, ignorenulls=True).over(upto) for c in cols})
        filled = self._carry(local, carried).withColumns({c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in cols})
        return replace(self, rows=filled.drop(*[f"_{c}" for c in cols]))


def spanning(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Groups of `by` that continue in the next bucket; at most one per bucket."""
    ends = rows.groupBy(BUCKET).agg(
        F.min_by(F.struct(*by), POS).alias("first"), F.max_by(F.struct(*by), POS).alias("last")).collect()
    ends.sort(key=lambda r: r[BUCKET])
    crossing = {tuple(a["last"]) for a, b in zip(ends, ends[1:]) if a["last"] == b["first"]}
    return rows.sparkSession.createDataFrame(sorted(crossing), rows.select(*by).schema)


def ntile_of(rank: Column, rows: int, tiles: int) -> Column:
    """NTILE from a row number and the row count: the first `rows % tiles` tiles hold one row more."""
    small, extra = divmod(rows, tiles)
    wide = extra * (small + 1)
    in_wide = F.floor((rank - 1) / F.lit(small + 1)) + 1
    if small == 0:
        return in_wide.cast("int")
    return F.when(rank <= wide, in_wide).otherwise(extra + F.floor((rank - wide - 1) / F.lit(small)) + 1).cast("int")


def ntile(df: DataFrame, order: Sequence[Column | str], tiles: int, out: str) -> DataFrame:
    """NTILE over all rows of `df`."""
    rows = Ordered.of(df, order)
    numbered = rows.row_number("_rank")
    return numbered.with_columns({out: ntile_of(F.col("_rank"), rows.count(), tiles)}).plain().drop("_rank")
