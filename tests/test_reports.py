import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from martwright.functions.calendar import build_dim_date
from martwright.plans import advanced, sales, views


@pytest.fixture
def star(spark):
    """Customer 3 buys nothing, customer 2 has no sessions, customer 1 has 2 sales and 3 sessions."""
    dates = build_dim_date(spark, dt.date(2024, 1, 1), dt.date(2024, 3, 31))
    money = lambda c: F.col(c).cast("decimal(18,2)")
    facts = spark.createDataFrame(
        [(1, 1, 10, 1, 1, 2, 100.0, 40.0), (2, 1, 20, 32, 2, 1, 50.0, 10.0), (3, 2, 10, 33, 1, 1, 50.0, 5.0), (4, 2, 30, 1, 1, 1, 0.0, 0.0)],
        "sale_id long, customer_id long, product_id long, date_id long, channel_id long, quantity int, total_amount double, profit double"
    ).withColumns({c: money(c) for c in ("total_amount", "profit")})
    return {
        "dates": dates,
        "sales": facts,
        "customers": spark.createDataFrame(
            [(1, "Ann", "Lee", "FR", "18-24"), (2, "Bob", "Ray", "DE", "25-34"), (3, "Cy", "Dow", "FR", "25-34")],
            "customer_id long, first_name string, last_name string, country string, age_group string"
        ).withColumn("signup_date", F.lit(dt.date(2023, 12, 5))),
        "products": spark.createDataFrame(
            [(10, "lamp", "home", "light", 50), (20, "pen", "office", "desk", 50), (30, "gift", "free", "none", 0), (40, "rug", "home", "floor", 9)],
            "product_id long, product_name string, category string, subcategory string, unit_price int"),
        "channels": spark.createDataFrame([(1, "Web", "Online"), (2, "Shop", "Offline")], "channel_id long, channel_name string, channel_type string"),
        "activity": spark.createDataFrame(
            [(1, 1, 1, 1, 10, 1, 0, 1), (2, 1, 2, 1, 20, 2, 0, 0), (3, 1, 3, 2, 60, 6, 1, 0), (4, 3, 1, 1, 5, 1, 0, 1)],
            "activity_id long, customer_id long, date_id long, channel_id long, session_duration_sec int, pages_viewed int, actions_taken int, bounce int"),
    }


def test_customer_summary_fans_out(star):
    got = {r.customer_id: r for r in views.customer_summary_view(star["customers"], star["sales"], star["activity"]).collect()}
    assert (got[1].total_orders, got[1].lifetime_value, got[1].avg_session_sec, got[1].avg_pages_viewed) == (2, 450.0, 30.0, 3.0)
    assert (got[2].lifetime_value, got[2].avg_session_sec) == (50.0, None)
    assert (got[3].total_orders, got[3].lifetime_value, got[3].full_name) == (0, None, "Cy Dow")
    true = views.customer_summary_view(star["customers"], star["sales"], star["activity"], fan_out=False)
    assert {r.customer_id: r.lifetime_value for r in true.collect()} == {1: 150.0, 2: 50.0, 3: None}


def test_segments_with_and_without_sales(star):
    tiers = (100, 50, 10)
    assert rows(sales.customer_segments(star["customers"], star["sales"], tiers)) == [
        ("Bronze", 1, 0.0, 0.0), ("Gold", 1, 50.0, 2.0), ("Platinum", 1, 150.0, 2.0)]
    summary = views.customer_summary_view(star["customers"], star["sales"], star["activity"])
    assert rows(sales.customer_segments_view(summary, tiers)) == [
        ("Bronze", 1, None, 0.0), ("Gold", 1, 50.0, 2.0), ("Platinum", 1, 450.0, 2.0)]


def test_unsold_and_free_products(star):
    got = {r.product_id: r for r in views.product_performance_view(star["products"], star["sales"]).collect()}
    assert (got[40].times_sold, got[40].total_units_sold, got[40].total_revenue, got[40].profit_margin_pct) == (0, None, None, None)
    assert (got[30].times_sold, got[30].total_revenue, got[30].profit_margin_pct) == (1, 0.0, None)
    assert got[10].profit_margin_pct == 30.0
    by_category = {r.category: r.margin_pct for r in sales.sales_by_category(star["sales"], star["products"]).collect()}
    assert by_category["free"] is None and by_category["office"] == 20.0


def test_top_products_limits(star):
    assert [r.product_id for r in sales.top_products(star["sales"], star["products"], 2).collect()] == [10, 20]
    for limit in (0, 51):
        with pytest.raises(ValueError):
            sales.top_products(star["sales"], star["products"], limit)


def test_empty_facts(star):
    none = star["sales"].limit(0)
    head = sales.overview(none, star["customers"], star["products"], star["activity"].limit(0)).first()
    assert (head.total_revenue, head.total_orders, head.avg_order_value, head.total_customers, head.bounce_rate) == (None, 0, None, 3, None)
    assert advanced.monthly_trend(none, star["dates"]).count() == 0
    assert advanced.rfm(star["customers"], none, star["dates"], dt.date(2024, 4, 1)).count() == 0
    assert advanced.pareto(none, star["customers"]).count() == 0
    assert advanced.market_basket(none, star["products"]).count() == 0
    assert advanced.revenue_forecast(none, star["dates"]).count() == 0


def test_monthly_trend_first_month_and_zero_base(star):
    got = advanced.monthly_trend(star["sales"], star["dates"]).collect()
    assert [(r.revenue, r.cumulative_revenue, r.moving_avg_3m, r.mom_change, r.mom_pct_change) for r in got] == [
        (100.0, 100.0, 100.0, None, None), (100.0, 200.0, 100.0, 0.0, 0.0)]
    assert [r.revenue_rank for r in got] == [1, 1]
    zero = star["sales"].withColumn("total_amount", F.when(F.col("date_id") > 31, F.col("total_amount")).otherwise(0).cast("decimal(18,2)"))
    assert [r.mom_pct_change for r in advanced.monthly_trend(zero, star["dates"]).collect()] == [None, None]


def test_cohorts(star):
    got = rows(advanced.cohort_retention(star["customers"], star["sales"], star["dates"]))
    # Both customers buy on Jan 1st and again 31 or 32 days later.
    assert got == [("2023-12", 2, 0, 2, 100.0), ("2023-12", 2, 1, 2, 100.0)]


def test_pareto_ties_and_sampling(many_buckets, star):
    facts = many_buckets.range(250).select(
        F.col("id").alias("customer_id"), F.when(F.col("id") < 100, 5).otherwise(F.col("id") % 3).cast("decimal(18,2)").alias("total_amount"))
    people = many_buckets.range(250).select(F.col("id").alias("customer_id"), F.lit("A").alias("first_name"), F.lit("B").alias("last_name"))
    curve = advanced.pareto(facts, people)
    got = curve.orderBy("rank_num").collect()
    assert [r.rank_num for r in got] == list(range(1, 251))
    assert {r.cumulative_revenue for r in got[:100]} == {500.0} and got[-1].cumulative_pct == 100.0
    assert [r.customer_id for r in got[:100]] == list(range(100))
    points = [r.rank_num for r in advanced.pareto_sampled(curve).collect()]
    assert points == sorted({*range(1, 251, 2), 250})


def test_rfm_segments(star):
    got = {r.customer_id: r for r in advanced.rfm(star["customers"], star["sales"], star["dates"], dt.date(2024, 3, 31)).collect()}
    assert (got[1].recency_days, got[1].frequency, got[1].monetary, got[1].customer_name) == (59, 2, 150.0, "Ann Lee")
    assert (got[2].recency_days, got[2].r_score, got[1].r_score) == (58, 2, 1)
    summary = advanced.rfm_summary(advanced.rfm(star["customers"], star["sales"], star["dates"], dt.date(2024, 3, 31)))
    assert sum(r.customer_count for r in summary.collect()) == 2


def test_decomposition_averages_rows_not_days(star):
    got = advanced.ts_decompose(star["sales"], star["dates"], half_window=1).collect()
    assert [(r.daily_revenue, r.trend_component) for r in got] == [(100.0, 75.0), (50.0, 66.67), (50.0, 50.0)]


def test_clv_uses_the_rounded_average(spark, star):
    got = {r.customer_id: r for r in advanced.clv(star["customers"], star["sales"], star["dates"]).collect()}
    assert (got[1].avg_purchase_value, got[1].active_months, got[1].purchase_freq_monthly, got[1].predicted_clv_24m) == (75.0, 2, 1.0, 1800.0)
    assert advanced.clv(star["customers"], star["sales"].filter("sale_id = 1"), star["dates"]).count() == 0


def test_attribution(star):
    got = {r.channel_name: r for r in advanced.channel_attribution(star["sales"], star["channels"]).collect()}
    assert (got["Web"].revenue_share_pct, got["Web"].conversion_share_pct, got["Web"].revenue_rank) == (75.0, 75.0, 1)
    assert (got["Shop"].efficiency_rank, got["Web"].efficiency_rank) == (2, 1)


def test_churn(star):
    got = {r.customer_id: r.churn_risk for r in advanced.churn_risk(star["customers"], star["sales"], star["dates"], dt.date(2024, 6, 1)).collect()}
    assert got == {1: "High", 2: "High"}
    once = star["sales"].filter("sale_id = 1")
    assert advanced.churn_risk(star["customers"], once, star["dates"], dt.date(2024, 6, 1)).first().churn_risk == "Unknown"
