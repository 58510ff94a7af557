"""Trends, cohorts, RFM, baskets, Pareto, decomposition, lifetime value and attribution."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.functions.numeric import cents, half_up, mean, mean_amount, percent, ratio, units
from martwright.operators.basket import pair_counts
from martwright.operators.ordered import Ordered
from martwright.operators.quantiles import ntile_by_borders
from martwright.plans.views import full_name
from martwright.session import cut, dealt_by_rows


def _monthly(sales: DataFrame, dates: DataFrame) -> DataFrame:
    keys = ["year", "month", "month_name"]
    by_date = sales.groupBy("date_id").agg(
        F.sum(cents(sales, "total_amount")).alias("amount"), F.sum(cents(sales, "profit")).alias("gain"))
    return by_date.join(dates.select("date_id", *keys), "date_id").groupBy(*keys).agg(
        F.sum("amount").alias("amount"), F.sum("gain").alias("gain"))


def monthly_trend(sales: DataFrame, dates: DataFrame) -> DataFrame:
    """Revenue with running total, 3-month moving average, month-over-month change and rank.

    One row per calendar month reaches the unpartitioned windows, so one task is enough for them.
    """
    in_order = Window.orderBy("year", "month")
    last = F.lag("amount").over(in_order)
    change = F.col("amount") - last
    three = in_order.rowsBetween(-2, Window.currentRow)
    return (
        _monthly(sales, dates)
        .select(
            "year",
            "month",
            "month_name",
            units("amount").alias("revenue"),
            units("gain").alias("profit"),
            units(F.sum("amount").over(in_order)).alias("cumulative_revenue"),
            mean_amount(F.sum("amount").over(three), F.count("amount").over(three)).alias("moving_avg_3m"),
            units(change).alias("mom_change"),
            percent(units(change), units(last)).alias("mom_pct_change"),
            F.rank().over(Window.orderBy(F.desc("amount"))).cast("bigint").alias("revenue_rank"),
        )
        .orderBy("year", "month")
    )


def cohort_retention(customers: DataFrame, sales: DataFrame, dates: DataFrame,
                     max_bucket: int = 12, bucket_days: int = 30) -> DataFrame:
    """Share of a signup cohort that buys again, in blocks of days after the first purchase.

    Sales are reduced to distinct (customer, day) before the window, so a customer has at most as
    many rows there as the calendar has days.
    """
    visits = sales.select("customer_id", "date_id").distinct().join(dates.select("date_id", "full_date"), "date_id")
    first = F.min("full_date").over(Window.partitionBy("customer_id"))
    block = F.floor(F.datediff("full_date", first) / bucket_days).cast("int")
    active = visits.select("customer_id", block.alias("months_since_first")).distinct()
    cohorts = customers.select("customer_id", F.date_format("signup_date", "yyyy-MM").alias("cohort_month"))
    counts = active.join(cohorts, "customer_id").groupBy("cohort_month", "months_since_first").agg(
        F.count("*").alias("active_customers"))
    size = F.max(F.when(F.col("months_since_first") == 0, F.col("active_customers"))).over(Window.partitionBy("cohort_month"))
    return (
        counts.withColumn("cohort_size", size)
        .filter((F.col("months_since_first") <= max_bucket) & F.col("cohort_size").isNotNull())
        .select(
            "cohort_month",
            "cohort_size",
            "months_since_first",
            "active_customers",
            percent("active_customers", "cohort_size").alias("retention_pct"),
        )
        .orderBy("cohort_month", "months_since_first")
    )


def rfm(customers: DataFrame, sales: DataFrame, dates: DataFrame, as_of: dt.date, tiles: int = 5) -> DataFrame:
    """Recency, frequency and monetary quintiles per customer, and the segment they give.

    Each quintile is a global ranking of all customers; ties are broken by customer id. Only the first
    customers of the tiles are looked for, nothing is sorted.
    """
    bought = sales.groupBy("customer_id").agg(
        F.max("date_id").alias("date_id"),
        F.countDistinct("sale_id").alias("frequency"),
        F.sum(cents(sales, "total_amount")).alias("monetary"))
    scored = bought.join(dates.select("date_id", "full_date"), "date_id").join(
        customers.select("customer_id", full_name().alias("customer_name"), "country"), "customer_id"
    ).select(
        "customer_id",
        "customer_name",
        "country",
        F.datediff(F.lit(as_of), "full_date").alias("recency_days"),
        "frequency",
        "monetary",
    )
    scores = {"r_score": -F.col("recency_days"), "f_score": F.col("frequency"), "m_score": F.col("monetary")}
    scored = ntile_by_borders(cut(scored), scores, "customer_id", tiles)
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    segment = (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 3) & (f >= 3), "Loyal Customers")
        .when((r >= 4) & (f <= 2), "New Customers")
        .when((r <= 2) & (f >= 3), "At Risk")
        .when((r <= 2) & (f <= 2), "Lost")
        .otherwise("Potential Loyalists")
    )
    return scored.withColumns({
        "monetary": units("monetary"),
        "rfm_total": r + f + m,
        "rfm_segment": segment,
    })


def rfm_summary(scored: DataFrame) -> DataFrame:
    """Customers and averages per RFM segment."""
    rows = F.count("*")
    return (
        scored.groupBy("rfm_segment")
        .agg(
            rows.alias("customer_count"),
            mean(F.sum(F.col("monetary").cast("decimal(20,2)")), rows).alias("avg_monetary"),
            mean(F.sum("frequency"), rows, 1).alias("avg_frequency"),
            mean(F.sum("recency_days"), rows, 0).alias("avg_recency_days"),
        )
        .orderBy(F.desc("avg_monetary"))
    )


def market_basket(sales: DataFrame, products: DataFrame, min_count: int = 3, top: int = 20, rows: int | None = None, **tuning) -> DataFrame:
    """The `top` product pairs that the same customer buys on the same day, with their support.

    `rows` is the number of `sales`, for callers that know it without a pass over them.
    """
    rows = sales.count() if rows is None else rows
    pairs = pair_counts(sales, min_count, top, rows=rows, **tuning)
    best = pairs.orderBy(F.desc("co_occurrence"), "product_id_a", "product_id_b").limit(top)
    with dealt_by_rows(sales.sparkSession, rows):
        orders = F.lit(sales.agg(F.countDistinct("sale_id")).first()[0]).cast("bigint")

    def named(side: str) -> DataFrame:
        return products.select(
            F.col("product_id").alias(f"product_id_{side}"),
            F.col("product_name").alias(f"product_{side}"),
            F.col("category").alias(f"category_{side}"))

    return (
        best.join(named("a"), "product_id_a")
        .join(named("b"), "product_id_b")
        .select(
            "product_id_a",
            "product_id_b",
            "product_a",
            "product_b",
            "category_a",
            "category_b",
            "co_occurrence",
            "unique_customers",
            percent("co_occurrence", orders, 2).alias("support_pct"),
        )
        .orderBy(F.desc("co_occurrence"), "product_id_a", "product_id_b")
    )


def pareto(sales: DataFrame, customers: DataFrame, cut_share: float = 0.8) -> DataFrame:
    """Customers by falling revenue with running revenue, shares and the 80/20 group."""
    bought = sales.groupBy("customer_id").agg(F.sum(cents(sales, "total_amount")).alias("amount"))
    rows = bought.join(customers.select("customer_id", full_name().alias("name")), "customer_id")
    ranked = Ordered.of(rows, [F.desc("amount"), F.asc("customer_id")])
    everything = units(ranked.rows.agg(F.sum("amount")).scalar())
    customers_ranked = F.lit(ranked.count())
    curve = ranked.row_number("rank_num").running_sum_with_peers("amount", "running").plain()
    share = ratio(units("running"), everything)
    return curve.select(
        "rank_num",
        "customer_id",
        "name",
        units("amount").alias("revenue"),
        units("running").alias("cumulative_revenue"),
        half_up(share * 100.0, 1).alias("cumulative_pct"),
        percent("rank_num", customers_ranked).alias("customer_percentile"),
        F.when(share <= cut_share, "Top 80% Revenue").otherwise("Bottom 20% Revenue").alias("pareto_group"),
    )


def pareto_sampled(curve: DataFrame, points: int = 100) -> DataFrame:
    """Every n-th point of the Pareto curve and its end, for a chart of about `points` points."""
    rows = curve.agg(F.max("rank_num")).scalar()
    step = F.greatest(F.lit(1), F.floor(rows / points))
    rank = F.col("rank_num")
    return curve.filter(((rank - 1) % step == 0) | (rank == rows)).select(
        "rank_num", "customer_percentile", "cumulative_pct").orderBy("rank_num")


def _daily(sales: DataFrame, dates: DataFrame) -> DataFrame:
    return (
        sales.groupBy("date_id")
        .agg(F.sum(cents(sales, "total_amount")).alias("amount"))
        .join(dates.select("date_id", "full_date", "day_of_week"), "date_id")
        .groupBy("full_date", "day_of_week")
        .agg(F.sum("amount").alias("amount"))
    )


def ts_decompose(sales: DataFrame, dates: DataFrame, half_window: int = 15) -> DataFrame:
    """Daily revenue split into trend (centred mean of rows), weekday mean and the rest.

    One row per calendar day reaches the unpartitioned window.
    """
    near = Window.orderBy("full_date").rowsBetween(-half_window, half_window)
    weekday = Window.partitionBy("day_of_week")
    trend = mean_amount(F.sum("amount").over(near), F.count("amount").over(near))
    seasonal = mean_amount(F.sum("amount").over(weekday), F.count("amount").over(weekday))
    revenue = units("amount")
    return (
        _daily(sales, dates)
        .select(
            "full_date",
            revenue.alias("daily_revenue"),
            trend.alias("trend_component"),
            seasonal.alias("seasonal_component"),
        )
        .withColumn("residual", half_up(F.col("daily_revenue") - F.col("trend_component") - F.col("seasonal_component"), 2))
        .orderBy("full_date")
    )


def customer_metrics(customers: DataFrame, sales: DataFrame, dates: DataFrame) -> DataFrame:
    """Purchases, spend, first and last day and active months per customer."""
    bought = (
        sales.join(dates.select("date_id", "full_date"), "date_id")
        .groupBy("customer_id")
        .agg(
            F.countDistinct("sale_id").alias("total_purchases"),
            F.sum(cents(sales, "total_amount")).alias("amount"),
            F.count(cents(sales, "total_amount")).alias("n_amount"),
            F.min("full_date").alias("first_purchase"),
            F.max("full_date").alias("last_purchase"),
            F.countDistinct(F.trunc("full_date", "month")).alias("active_months"),
        )
    )
    return bought.join(customers.select("customer_id", full_name().alias("name"), "country"), "customer_id")


def clv(customers: DataFrame, sales: DataFrame, dates: DataFrame, months: int = 24, limit: int | None = 50) -> DataFrame:
    """Predicted value over `months`: the 2-digit average purchase times purchases per active month."""
    pace = ratio("total_purchases", "active_months")
    rows = (
        customer_metrics(customers, sales, dates)
        .filter(F.col("total_purchases") > 1)
        .withColumn("avg_purchase_value", mean_amount("amount", "n_amount"))
        .select(
            "customer_id",
            "name",
            "country",
            "total_purchases",
            units("amount").alias("total_spent"),
            "avg_purchase_value",
            "active_months",
            F.datediff("last_purchase", "first_purchase").alias("lifespan_days"),
            half_up(pace, 2).alias("purchase_freq_monthly"),
            half_up(F.col("avg_purchase_value") * pace * float(months), 2).alias("predicted_clv_24m"),
        )
    )
    if limit is None:
        return rows
    return rows.orderBy(F.desc("predicted_clv_24m"), "customer_id").limit(limit)


def channel_attribution(sales: DataFrame, channels: DataFrame) -> DataFrame:
    """Conversions, revenue and profit per channel with shares and ranks (one row per channel)."""
    amount = cents(sales, "total_amount")
    by_channel = sales.groupBy("channel_id").agg(
        F.count("sale_id").alias("conversions"),
        F.sum(amount).alias("amount"),
        F.countDistinct("customer_id").alias("unique_customers"),
        mean_amount(F.sum(amount), F.count(amount)).alias("avg_order_value"),
        F.sum(cents(sales, "profit")).alias("gain"))
    everything = Window.partitionBy()
    margin = ratio(units("gain"), units("amount"))
    return (
        by_channel.join(channels, "channel_id")
        .select(
            "channel_name",
            "channel_type",
            "conversions",
            units("amount").alias("attributed_revenue"),
            "unique_customers",
            "avg_order_value",
            units("gain").alias("attributed_profit"),
            percent(units("amount"), units(F.sum("amount").over(everything))).alias("revenue_share_pct"),
            percent("conversions", F.sum("conversions").over(everything)).alias("conversion_share_pct"),
            half_up(margin * 100.0, 1).alias("profit_margin_pct"),
            F.rank().over(Window.orderBy(F.desc("amount"))).cast("bigint").alias("revenue_rank"),
            F.rank().over(Window.orderBy(F.desc(margin))).cast("bigint").alias("efficiency_rank"),
        )
        .orderBy(F.desc("attributed_revenue"))
    )


def revenue_forecast(sales: DataFrame, dates: DataFrame, horizon: int = 3) -> DataFrame:
    """Straight-line trend of monthly revenue, continued for `horizon` months.

    Months are numbered from the first one, which keeps the fit well conditioned. Fewer than two
    months give no line and no rows.
    """
    months = _monthly(sales, dates).select(
        (F.col("year") * 12 + F.col("month") - 1).alias("m"), units("amount").alias("y"))
    since = F.col("m") - F.min("m").over(Window.partitionBy())
    line = months.select("m", "y", since.alias("x")).agg(
        F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"),
        F.max("x").alias("last"), F.min("m").alias("first")).filter(F.col("slope").isNotNull())
    ahead = line.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    x = F.col("last") + F.col("step")
    month = F.col("first") + x
    return ahead.select(
        F.floor(month / 12).cast("int").alias("year"),
        (month % 12 + 1).cast("int").alias("month"),
        half_up(F.col("intercept") + F.col("slope") * x, 0).alias("forecast_revenue"),
    )


def churn_risk(customers: DataFrame, sales: DataFrame, dates: DataFrame, as_of: dt.date) -> DataFrame:
    """Days since the last purchase against the customer's mean gap between purchase days."""
    days = sales.select("customer_id", "date_id").distinct().join(dates.select("date_id", "full_date"), "date_id")
    gaps = days.groupBy("customer_id").agg(
        F.count("*").alias("purchase_days"),
        F.datediff(F.lit(as_of), F.max("full_date")).alias("recency_days"),
        ratio(F.datediff(F.max("full_date"), F.min("full_date")), F.count("*") - 1).alias("gap"))
    late = ratio("recency_days", "gap")
    risk = F.when(F.col("gap").isNull(), "Unknown").when(late > 3, "High").when(late > 1.5, "Medium").otherwise("Low")
    return gaps.join(customers.select("customer_id"), "customer_id", "left_semi").select(
        "customer_id", "purchase_days", "recency_days", half_up("gap", 1).alias("mean_gap_days"), risk.alias("churn_risk"))
