import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martwright.operators.ordered import BUCKET, Ordered, ntile, ntile_of


@pytest.fixture
def frame(many_buckets):
    """300 rows; group 7 owns more than a third of them and spreads over several buckets."""
    rng = random.Random(5)
    rows = [(7 if rng.random() < 0.4 else rng.randrange(15), i, rng.choice([None, 0, 1, 5]), float(rng.randrange(6)))
            for i in range(300)]
    return many_buckets.createDataFrame(rows, "k int, t int, v int, x double")


def same(got, want, *columns):
    key = lambda r: repr(tuple(r))
    assert sorted(map(key, got.select(*columns).collect())) == sorted(map(key, want.select(*columns).collect()))


def test_the_hot_group_spans_buckets(frame):
    ordered = Ordered.of(frame, ["k", "t"], by=["k"])
    assert ordered.rows.filter("k = 7").select(BUCKET).distinct().count() > 1
    assert (7,) in [tuple(r) for r in ordered.spans.collect()]


def test_row_number(frame):
    got = Ordered.of(frame, [F.desc("x"), "t"]).row_number("n").plain()
    same(got, frame.withColumn("n", F.row_number().over(Window.orderBy(F.desc("x"), "t"))), "t", "n")


@pytest.mark.parametrize("by", [[], ["k"]])
def test_running_sum_and_shifts(frame, by):
    ordered = Ordered.of(frame, [*by, "t"], by=by)
    got = ordered.running_sum("t", "s").previous(["v", "t"], "p").following(["t"], "f").plain()
    w = Window.partitionBy(*by).orderBy("t")
    want = frame.withColumns({
        "s": F.sum("t").over(w), "p": F.lag(F.struct("v", "t")).over(w), "f": F.lead(F.struct("t")).over(w)})
    same(got, want, "k", "t", "s", "p", "f")


@pytest.mark.parametrize("by", [[], ["k"]])
def test_fill_forward(frame, by):
    got = Ordered.of(frame, [*by, "t"], by=by).fill_forward(["v"]).plain()
    w = Window.partitionBy(*by).orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    same(got, frame.withColumn("v", F.last("v", ignorenulls=True).over(w)), "k", "t", "v")


def test_filtered_rows_still_carry(frame):
    keep = F.col("t") % 3 != 0
    got = Ordered.of(frame, ["k", "t"], by=["k"]).filter(keep).running_sum("t", "s").previous(["t"], "p").plain()
    w = Window.partitionBy("k").orderBy("t")
    want = frame.filter(keep).withColumns({"s": F.sum("t").over(w), "p": F.lag(F.struct("t")).over(w)})
    same(got, want, "k", "t", "s", "p")


def test_equal_values_share_the_running_sum_over_buckets(frame):
    # Six distinct values in eight buckets: most ties reach over a border.
    got = Ordered.of(frame, [F.desc("x"), "t"]).running_sum_with_peers("x", "s").plain()
    same(got, frame.withColumn("s", F.sum("x").over(Window.orderBy(F.desc("x")))), "t", "x", "s")


@pytest.mark.parametrize("tiles", [1, 5, 7, 299, 300, 400])
def test_ntile(frame, tiles):
    got = ntile(frame, [F.asc_nulls_first("v"), F.asc("t")], tiles, "tile")
    same(got, frame.withColumn("tile", F.ntile(tiles).over(Window.orderBy(F.asc_nulls_first("v"), "t"))), "t", "tile")


def test_no_rows(many_buckets):
    empty = many_buckets.createDataFrame([], "k int, t int, v int")
    assert ntile(empty, ["t"], 5, "tile").count() == 0
    assert Ordered.of(empty, ["k", "t"], by=["k"]).fill_forward(["v"]).running_sum("v", "s").plain().count() == 0


def test_ntile_of_small_sets(spark):
    got = spark.range(1, 4).select(ntile_of(F.col("id"), 3, 5).alias("t")).collect()
    assert [r.t for r in got] == [1, 2, 3]
