"""Sales, product, customer and engagement reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.functions.numeric import cents, mean, mean_amount, percent, total, units

SEGMENTS = ("Platinum", "Gold", "Silver")  # and Bronze below the last tier
TIERS = (5000, 2000, 500)
MAX_TOP = 50


def overview(sales: DataFrame, customers: DataFrame, products: DataFrame, activity: DataFrame) -> DataFrame:
    """The eight headline figures in one row, one pass per table."""
    rows = F.count("*")
    amount = cents(sales, "total_amount")
    return sales.agg(
        total(amount).alias("total_revenue"),
        total(cents(sales, "profit")).alias("total_profit"),
        rows.alias("total_orders"),
        customers.agg(rows).scalar().alias("total_customers"),
        products.agg(rows).scalar().alias("total_products"),
        mean_amount(F.sum(amount), F.count(amount)).alias("avg_order_value"),
        activity.agg(rows).scalar().alias("total_sessions"),
        activity.agg(percent(F.sum("bounce"), rows)).scalar().alias("bounce_rate"),
    )


def _by_key(sales: DataFrame, key: str, *more: Column) -> DataFrame:
    """Sale count and amount in cents per key, with further aggregates."""
    amount = cents(sales, "total_amount")
    return sales.groupBy(key).agg(
        F.count("sale_id").alias("n"), F.count(amount).alias("n_amount"), F.sum(amount).alias("amount"), *more)


def _gain(sales: DataFrame) -> Column:
    return F.sum(cents(sales, "profit")).alias("gain")


def monthly_sales(sales: DataFrame, dates: DataFrame) -> DataFrame:
    """Orders, revenue, profit and distinct customers per month.

    The date is looked up first here: with the month known, one shuffle on (month, customer) serves
    the distinct count and the sums, and no single month or customer lands in one task.
    """
    keys = ["year", "month", "month_name"]
    return (
        sales.join(dates.select("date_id", *keys), "date_id")
        .groupBy(*keys)
        .agg(
            F.count("sale_id").alias("orders"),
            total(cents(sales, "total_amount")).alias("revenue"),
            total(cents(sales, "profit")).alias("profit"),
            F.countDistinct("customer_id").alias("unique_customers"),
        )
        .orderBy("year", "month")
    )


def sales_by_category(sales: DataFrame, products: DataFrame) -> DataFrame:
    by_key = _by_key(sales, "product_id", _gain(sales))
    return (
        by_key.join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(
            F.sum("n").alias("orders"),
            total("amount").alias("revenue"),
            total("gain").alias("profit"),
            percent(total("gain"), total("amount")).alias("margin_pct"),
        )
        .orderBy(F.desc("revenue"), "category")
    )


def sales_by_channel(sales: DataFrame, channels: DataFrame) -> DataFrame:
    return (
        _by_key(sales, "channel_id")
        .join(channels, "channel_id")
        .select(
            "channel_name",
            "channel_type",
            F.col("n").alias("orders"),
            units("amount").alias("revenue"),
            mean_amount("amount", "n_amount").alias("avg_order_value"),
        )
        .orderBy(F.desc("revenue"), "channel_name")
    )


def sales_by_country(sales: DataFrame, customers: DataFrame, limit: int | None = None) -> DataFrame:
    """After grouping by customer the distinct customers of a country are its rows."""
    rows = (
        _by_key(sales, "customer_id")
        .join(customers.select("customer_id", "country"), "customer_id")
        .groupBy("country")
        .agg(F.count("*").alias("customers"), F.sum("n").alias("orders"), total("amount").alias("revenue"))
        .orderBy(F.desc("revenue"), "country")
    )
    return rows if limit is None else rows.limit(limit)


def daily_pattern(sales: DataFrame, dates: DataFrame) -> DataFrame:
    return (
        _by_key(sales, "date_id")
        .join(dates.select("date_id", "day_name", "day_of_week"), "date_id")
        .groupBy("day_name", "day_of_week")
        .agg(
            F.sum("n").alias("orders"),
            total("amount").alias("revenue"),
            mean_amount(F.sum("amount"), F.sum("n_amount")).alias("avg_order"),
        )
        .orderBy("day_of_week")
    )


def top_products(sales: DataFrame, products: DataFrame, limit: int = 10) -> DataFrame:
    """The `limit` best-selling products; the join comes after the top-k is chosen."""
    if not 1 <= limit <= MAX_TOP:
        raise ValueError(f"limit must lie between 1 and {MAX_TOP}")
    sold = _by_key(sales, "product_id", F.sum("quantity").alias("units_sold"), _gain(sales))
    known = sold.join(products.select("product_id"), "product_id", "left_semi")
    best = known.orderBy(F.desc("amount"), "product_id").limit(limit)
    return (
        best.join(products.select("product_id", "product_name", "category"), "product_id")
        .orderBy(F.desc("amount"), "product_id")
        .select(
            "product_id",
            "product_name",
            "category",
            "units_sold",
            units("amount").alias("revenue"),
            units("gain").alias("profit"),
        )
    )


def tier(value: Column | str, tiers: Sequence[float] = TIERS) -> Column:
    """Platinum, Gold, Silver or Bronze; NULL falls through to Bronze."""
    value = F.col(value) if isinstance(value, str) else value
    picked = F.when(value >= tiers[0], SEGMENTS[0])
    for floor, name in zip(tiers[1:], SEGMENTS[1:]):
        picked = picked.when(value >= floor, name)
    return picked.otherwise("Bronze")


def customer_segments(customers: DataFrame, sales: DataFrame, tiers: Sequence[float] = TIERS) -> DataFrame:
    """Customers, average value and average orders per lifetime-value tier; no sales count as 0."""
    bought = _by_key(sales, "customer_id").select("customer_id", "n", "amount")
    value = F.coalesce("amount", F.lit(0))
    return (
        customers.select("customer_id")
        .join(bought, "customer_id", "left")
        .select(tier(units(value), tiers).alias("segment"), value.alias("value"), F.coalesce("n", F.lit(0)).alias("n"))
        .groupBy("segment")
        .agg(
            F.count("*").alias("customer_count"),
            mean_amount(F.sum("value"), F.count("*")).alias("avg_ltv"),
            mean(F.sum("n"), F.count("*"), 1).alias("avg_orders"),
        )
        .orderBy(F.desc("avg_ltv"))
    )


def customer_segments_view(summary: DataFrame, tiers: Sequence[float] = TIERS) -> DataFrame:
    """The same tiers over the customer summary view, whose value is NULL without sales."""
    return (
        summary.withColumn("segment", tier("lifetime_value", tiers))
        .groupBy("segment")
        .agg(
            F.count("*").alias("customer_count"),
            mean(F.sum(F.col("lifetime_value").cast("decimal(20,2)")), F.count("lifetime_value")).alias("avg_ltv"),
            mean(F.sum("total_orders"), F.count("*"), 1).alias("avg_orders"),
        )
        .orderBy(F.desc("avg_ltv"))
    )


def engagement_by_channel(activity: DataFrame, channels: DataFrame) -> DataFrame:
    by_key = activity.groupBy("channel_id").agg(
        F.count("activity_id").alias("sessions"),
        mean(F.sum("session_duration_sec"), F.count("session_duration_sec"), 0).alias("avg_duration_sec"),
        mean(F.sum("pages_viewed"), F.count("pages_viewed"), 1).alias("avg_pages"),
        percent(F.sum("bounce"), F.count("*")).alias("bounce_rate_pct"))
    return (
        by_key.join(channels.select("channel_id", "channel_name"), "channel_id")
        .drop("channel_id")
        .orderBy(F.desc("sessions"), "channel_name")
    )


def customers_by_country(customers: DataFrame) -> DataFrame:
    return customers.groupBy("country").agg(F.count("*").alias("customers")).orderBy(F.desc("customers"), "country")
