"""Views kept up by months against views of all facts."""

import datetime as dt
import random
import re
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from martwright.functions.calendar import build_dim_date
from martwright.plans import load, monthly
from martwright.sources import schemas


def sales(spark, days, seed, n=300):
    rng = random.Random(seed)
    found = [(seed * 10_000 + i, rng.randint(1, 9), rng.randint(1, 5), rng.choice(days), rng.choice([1, 2, None]), rng.randint(1, 4), "9.990000", "0.100000",
              f"{rng.randint(1, 9999) / 100:.2f}", "1.25") for i in range(n)]
    return spark.createDataFrame(found, "sale_id long, customer_id long, product_id long, date_id long, channel_id long, quantity int, unit_price string, "
                                        "discount string, total_amount string, profit string").selectExpr(
        "sale_id", "customer_id", "product_id", "date_id", "channel_id", "quantity", "cast(unit_price as decimal(16,6)) unit_price",
        "cast(discount as decimal(8,6)) discount", "cast(total_amount as decimal(18,2)) total_amount", "cast(profit as decimal(18,2)) profit")


def sessions(spark, days, seed, n=100):
    rng = random.Random(seed)
    found = [(seed * 1000 + i, rng.randint(1, 9), rng.choice(days), 1, rng.choice([None, 10, 25]), rng.randint(0, 3), 1, 0) for i in range(n)]
    return spark.createDataFrame(found, schemas.STAR["fact_user_activity"])


@pytest.fixture
def dims(spark):
    return {
        "dim_date": build_dim_date(spark, dt.date(2024, 1, 1), dt.date(2024, 3, 31)),
        "dim_products": spark.createDataFrame([(i, f"p{i}", f"c{i % 2}", "s") for i in range(1, 7)], "product_id long, product_name string, category string, subcategory string").selectExpr(
            "*", "cast(1 as decimal(18,2)) unit_price", "cast(1 as decimal(18,2)) cost_price"),
        "dim_channels": spark.createDataFrame([(1, "web", "x"), (2, "shop", "y")], schemas.STAR["dim_channels"]),
        "dim_customers": spark.createDataFrame([(i, "a", f"b{i}", "e", "c", "d", "f", None) for i in range(1, 12)], schemas.STAR["dim_customers"]),
    }


def same(spark, root, dims, facts):
    for name in load.VIEWS:
        assert rows(monthly.view(spark, root, dims, name)) == rows(load.view({**dims, **facts}, name)), name


JANUARY, FEBRUARY, MARCH = list(range(1, 32)), list(range(32, 61)), list(range(61, 92))


def test_a_second_load_touches_its_month_alone(spark, tmp_path, dims):
    root = str(tmp_path / "w")
    january, february, march = sales(spark, JANUARY, 1), sales(spark, FEBRUARY, 2), sales(spark, [*MARCH, 900, None], 3)
    visits = sessions(spark, JANUARY + MARCH, 4)
    touched = monthly.load_months(spark, root, {"fact_sales": january.union(february).union(march), "fact_user_activity": visits}, dims["dim_date"])
    assert touched == {"fact_sales": [0, 202401, 202402, 202403], "fact_user_activity": [202401, 202403]}
    same(spark, root, dims, {"fact_sales": january.union(february).union(march), "fact_user_activity": visits})
    before = {p: p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}
    changed = sales(spark, FEBRUARY, 5, n=77)
    assert monthly.load_months(spark, root, {"fact_sales": changed}, dims["dim_date"]) == {"fact_sales": [202402]}
    new = [p for p in Path(root).rglob("*.parquet") if p not in before]
    assert {m.group() for p in new if (m := re.search(r"year_month=\d+", str(p)))} == {"year_month=202402"}
    assert all(p.stat().st_mtime_ns == t for p, t in before.items())
    same(spark, root, dims, {"fact_sales": january.union(changed).union(march), "fact_user_activity": visits})
    # A product that moves to another category moves in all months.
    dims["dim_products"] = dims["dim_products"].withColumn("category", dims["dim_products"].product_id.cast("string"))
    same(spark, root, dims, {"fact_sales": january.union(changed).union(march), "fact_user_activity": visits})
    monthly.load_months(spark, root, {"fact_sales": changed.limit(0)}, dims["dim_date"], emptied=[202401])
    same(spark, root, dims, {"fact_sales": changed.union(march), "fact_user_activity": visits})


def test_months_are_pruned(spark, tmp_path, dims, capsys):
    root = str(tmp_path / "w")
    monthly.load_months(spark, root, {"fact_sales": sales(spark, JANUARY + FEBRUARY, 1)}, dims["dim_date"])
    one = monthly.read_months(spark, root, "fact_sales", [202401])
    one.explain("formatted")
    assert re.search(r"PartitionFilters: \[.*year_month.*202401", capsys.readouterr().out)
    read = {r[0] for r in one.select(F.input_file_name()).distinct().collect()}
    assert len(read) == len(list(Path(root).rglob("fact_sales_by_month/*/year_month=202401/*.parquet")))


def test_a_load_that_fails_changes_nothing(spark, tmp_path, dims):
    root = str(tmp_path / "w")
    good = sales(spark, JANUARY, 1)
    monthly.load_months(spark, root, {"fact_sales": good}, dims["dim_date"])
    bad = sales(spark, JANUARY, 2).selectExpr("* except (quantity)", "cast(raise_error('lost') as int) quantity")
    with pytest.raises(Exception, match="lost"):
        monthly.load_months(spark, root, {"fact_sales": bad}, dims["dim_date"])
    assert monthly.read_months(spark, root, "fact_sales").count() == good.count()


def test_nothing_loaded(spark, tmp_path, dims):
    assert monthly.read_months(spark, str(tmp_path), "fact_sales").count() == 0
    assert monthly.view(spark, str(tmp_path), dims, "v_monthly_sales").count() == 0


def test_reach_within_its_error(spark, tmp_path, dims):
    """Distinct customers from merged sketches, many of them in several months and channels; a second load replaces a month's sketch."""
    root, n = str(tmp_path / "w"), 60_000
    sold = spark.range(3 * n).selectExpr(
        "id sale_id", f"if(id % 50 > 0, id % {n}, null) customer_id", f"case when id < {n} then 1L when id < {2 * n} then 40L else 70L end date_id",
        "1 + id % 2 channel_id", "1L product_id", "1 quantity", "cast(5 as decimal(16,6)) unit_price", "cast(0 as decimal(8,6)) discount",
        "cast(5 as decimal(18,2)) total_amount", "cast(1 as decimal(18,2)) profit")
    monthly.load_months(spark, root, {"fact_sales": sold}, dims["dim_date"])
    monthly.load_months(spark, root, {"fact_sales": sold.filter("date_id = 40 AND customer_id < 1000")}, dims["dim_date"])
    left = sold.filter("date_id != 40 OR customer_id < 1000").withColumn(
        "year_month", F.when(F.col("date_id") == 1, 202401).when(F.col("date_id") == 40, 202402).otherwise(202403))
    for by in ([], ["channel_id"], ["year_month"], ["year_month", "channel_id"]):
        exact = {tuple(r)[:-1]: r[-1] for r in left.groupBy(*by).agg(F.countDistinct("customer_id")).collect()}
        about = {tuple(r)[:-1]: r[-1] for r in monthly.reach(spark, root, *by).collect()}
        assert exact.keys() == about.keys()
        assert all(abs(about[k] - n) <= n * monthly.REACH_ERROR for k, n in exact.items())
    assert monthly.reach(spark, str(tmp_path / "none")).first().customers == 0
