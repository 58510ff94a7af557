import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martwright.operators import quality, quantiles
from martwright.operators.quantiles import MEDIAN, QUARTILES, describe, ntile_by_borders


def frame(spark, values):
    return spark.createDataFrame([(Decimal(str(v)),) for v in values], "v decimal(18,2)")


def at(df, column, ranks):
    found = describe(df, {column: (F.col(column), ranks)})[column]
    return {name: hit.value for name, hit in found.at.items()}


def test_order_statistics_by_rank(many_buckets):
    rng = random.Random(1)
    for size in (1, 2, 3, 4, 5, 9, 101):
        # A third of the values is the same.
        values = [5 if rng.random() < 0.34 else rng.randrange(1000) for _ in range(size)]
        got = describe(frame(many_buckets, values), {"v": (F.col("v"), {**MEDIAN, **QUARTILES})})["v"]
        s, n = sorted(values), size
        assert (got.at["q1"].value, got.at["q3"].value) == (s[n // 4], s[3 * n // 4])
        assert (got.at["median_lo"].value, got.at["median_hi"].value) == (s[(n - 1) // 2], s[n // 2])
        assert (got.count, got.min, got.max, got.total) == (n, s[0], s[-1], sum(s))
        for hit, rank in ((got.at["q1"], n // 4), (got.at["median_hi"], n // 2)):
            assert hit.rows == s.count(hit.value) and hit.place == rank - s.index(hit.value)


def test_a_sketch_that_misses_does_no_harm(spark, monkeypatch):
    """With a sketch of two values every bracket is wrong at first."""
    monkeypatch.setattr(quantiles, "ACCURACY", 2)
    values = [(i * 7919) % 5003 for i in range(5003)]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    assert at(df, "v", {**MEDIAN, **QUARTILES}) == {"median_lo": 2501, "median_hi": 2501, "q1": 1250, "q3": 3752}


def test_more_rows_than_the_sketch_keeps(spark):
    df = spark.range(300_000).select(((F.col("id") * 7919) % 300_007).alias("v"))
    s = sorted(i * 7919 % 300_007 for i in range(300_000))
    assert at(df, "v", QUARTILES) == {"q1": s[75_000], "q3": s[225_000]}


def test_several_columns_at_once(many_buckets):
    data = [(i, 100 - i, None if i % 2 else i) for i in range(60)]
    df = many_buckets.createDataFrame(data, "a int, b int, c int")
    got = describe(df, {c: (F.col(c), MEDIAN) for c in "abc"})
    assert got["a"].at["median_lo"].value == 29 and got["b"].at["median_hi"].value == 71
    assert got["c"].count == 30 and got["c"].at["median_lo"].value == 28


def test_every_digit_counts(spark):
    """Very large, very small and mixed types keep their values."""
    big = [10**15, 2**62, 2**62 + 1, 2**62 + 2, 2**63 - 1]
    tiny = [1e-5, 2e-5, 4e-5, 1e300, float("nan")]
    fine = [Decimal("0.000000000001"), Decimal("0.000000000002"), Decimal("0.000000000003"), Decimal("5"), None]
    df = spark.createDataFrame(list(zip(big, tiny, fine)), "big bigint, tiny double, fine decimal(30,12)")
    assert at(df, "big", MEDIAN) == {"median_lo": 2**62 + 1, "median_hi": 2**62 + 1}
    assert at(df, "tiny", MEDIAN) == {"median_lo": 2e-5, "median_hi": 4e-5}
    assert at(df, "fine", MEDIAN) == {"median_lo": fine[1], "median_hi": fine[2]}
    profile = {r["column"]: r for r in quality.profile_numeric(df, "t", ["big", "tiny", "fine"]).collect()}
    assert (profile["t.big"]["max"], profile["t.big"]["min"]) == (float(2**63 - 1), 1e15)
    assert (profile["t.tiny"]["count"], profile["t.fine"]["count"]) == (4, 4)


def test_no_values(spark):
    got = describe(frame(spark, []), {"v": (F.col("v"), MEDIAN)})["v"]
    assert (got.count, got.min, got.total, got.at) == (0, None, None, {})
    empty = quality.profile_numeric(frame(spark, []), "t", ["v"]).first()
    assert tuple(empty) == ("t.v", 0, *[None] * 7)
    check = quality.iqr_outliers(frame(spark, []), "v", "empty").first()
    assert (check.status, check.details) == ("SKIPPED", "no rows")


@pytest.mark.parametrize("size", [0, 1, 3, 5, 7, 100])
def test_ntile_by_borders(spark, size):
    rng = random.Random(size)
    data = [(i, 4 if rng.random() < 0.4 else rng.randrange(9), rng.random()) for i in range(size)]
    df = spark.createDataFrame(data, "id bigint, a int, b double")
    got = {r.id: (r.ra, r.rb) for r in ntile_by_borders(df, {"ra": -F.col("a"), "rb": F.col("b")}, "id", 5).collect()}

    def tiles(key):
        ranked = [r[0] for r in sorted(data, key=key)]
        small, extra = divmod(size, 5)
        sizes = [small + (t < extra) for t in range(5)]
        return dict(zip(ranked, [t + 1 for t in range(5) for _ in range(sizes[t])]))

    ra, rb = tiles(lambda r: (-r[1], r[0])), tiles(lambda r: (r[2], r[0]))
    assert got == {i: (ra[i], rb[i]) for i in range(size)}


def test_fences_are_strict(spark):
    # q1 = 10, q3 = 20: fences at -5 and 35.
    df = frame(spark, [-5, 10, 10, 15, 20, 20, 35])
    assert quality.iqr_bounds(df, "v").first().outliers == 0
    df = frame(spark, [-5.01, 10, 10, 15, 20, 20, 35.01])
    bounds = quality.iqr_bounds(df, "v").first()
    assert (bounds.q1, bounds.q3, bounds.outliers) == (10.0, 20.0, 2)


def test_profile_of_a_constant_column(spark):
    got = quality.profile_numeric(frame(spark, [3, 3, 3]), "t", ["v"]).first()
    assert (got["count"], got["min"], got["mean"], got["median"], got["std"], got["skewness"]) == (3, 3.0, 3.0, 3.0, 0.0, 0.0)


def test_profile_about_the_rounded_mean(spark):
    """Far from zero, near it, constant with digits beyond the mean's, and without values."""
    rng = random.Random(8)
    data = [(1e6 + rng.gauss(0, 0.4), rng.expovariate(3), 3.333, None, float("nan") if i % 5 == 0 else rng.choice([1.0, 1.0, 7.0])) for i in range(400)]
    df = spark.createDataFrame(data, "far double, near double, same double, none double, holes double")
    got = {r["column"][2:]: r for r in quality.profile_numeric(df, "t", df.columns).collect()}
    for i, name in enumerate(df.columns):
        values = [row[i] for row in data if row[i] is not None and row[i] == row[i]]
        assert got[name]["count"] == len(values)
        if values:
            mean = round(sum(values) / len(values), 2)
            std = (sum((v - mean) ** 2 for v in values) / len(values)) ** 0.5
            third = sum((v - mean) ** 3 for v in values) / len(values)
            assert got[name]["std"] == pytest.approx(std, abs=0.0051)
            assert got[name]["skewness"] == pytest.approx(third / std**3, abs=0.00051)
    assert got["none"]["std"] is None and got["none"]["skewness"] is None


def test_few_values_are_counted_and_not_sorted(spark, monkeypatch):
    df = frame(spark, [v for v in (1, 2, 2, 2, 5) for _ in range(4000)])
    monkeypatch.setattr(quantiles.Ordered, "of", lambda *_: pytest.fail("sorted"))
    got = at(df, "v", MEDIAN | QUARTILES)
    assert got == {"median_lo": 2, "median_hi": 2, "q1": 2, "q3": 2}
