"""Semantic views over the star.

Facts are grouped by a dimension key before they meet the dimension. The partial aggregate runs
before the shuffle, so a key that owns a third of the fact leaves each map task as one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.functions.numeric import cents, half_up, mean, mean_amount, percent, total, units


def full_name() -> Column:
    return F.concat("first_name", F.lit(" "), "last_name")


MONTH = ["year", "month", "month_name"]


def sales_by_product(sales: DataFrame, *by: str) -> DataFrame:
    """Sums of sales by `by`, product and channel. Sums of such rows are sums of all their sales."""
    return sales.groupBy(*by, "product_id", "channel_id").agg(
        F.count("sale_id").alias("n"), F.sum("quantity").alias("units"),
        F.count(cents(sales, "total_amount")).alias("n_amount"),
        F.sum(cents(sales, "total_amount")).alias("revenue"), F.sum(cents(sales, "profit")).alias("profit"))


def sales_by_customer(sales: DataFrame, *by: str) -> DataFrame:
    """Distinct sales and their amount by `by` and customer."""
    return sales.groupBy(*by, "customer_id").agg(
        F.countDistinct("sale_id").alias("orders"), F.sum(cents(sales, "total_amount")).alias("revenue"))


def sessions_by_customer(activity: DataFrame, *by: str) -> DataFrame:
    """Sessions, and the sums and counts of what is known of them, by `by` and customer."""
    return activity.groupBy(*by, "customer_id").agg(
        F.count("*").alias("n_sessions"), F.sum("session_duration_sec").alias("seconds"),
        F.count("session_duration_sec").alias("n_seconds"), F.sum("pages_viewed").alias("pages"), F.count("pages_viewed").alias("n_pages"))


def monthly_sales_of(by_product: DataFrame, products: DataFrame, channels: DataFrame) -> DataFrame:
    """The monthly view from `sales_by_product` rows with the columns of MONTH."""
    return (
        by_product.join(products.select("product_id", "category"), "product_id")
        .join(channels.select("channel_id", "channel_name"), "channel_id")
        .groupBy(*MONTH, "category", "channel_name")
        .agg(
            F.sum("n").alias("total_orders"),
            F.sum("units").alias("total_units"),
            total("revenue").alias("total_revenue"),
            total("profit").alias("total_profit"),
            mean_amount(F.sum("revenue"), F.sum("n_amount")).alias("avg_order_value"),
        )
    )


def monthly_sales_view(sales: DataFrame, dates: DataFrame, products: DataFrame, channels: DataFrame) -> DataFrame:
    """Orders, units, revenue, profit and average order by month, category and channel.

    The calendar is the one dimension that is always small, so the month is looked up first and the
    fact leaves the map side as (month, product, channel).
    """
    return monthly_sales_of(sales_by_product(sales.join(dates.select("date_id", *MONTH), "date_id"), *MONTH), products, channels)


def customer_summary_of(customers: DataFrame, bought: DataFrame, sessions: DataFrame, fan_out: bool = True) -> DataFrame:
    """The customer view from rows of `sales_by_customer` and `sessions_by_customer`, one a customer or more."""
    bought = bought.groupBy("customer_id").agg(F.sum("orders").alias("total_orders"), F.sum("revenue").alias("revenue"))
    sessions = sessions.groupBy("customer_id").agg(
        F.sum("n_sessions").alias("n_sessions"),
        mean(F.sum("seconds"), F.sum("n_seconds"), 0).alias("avg_session_sec"),
        mean(F.sum("pages"), F.sum("n_pages"), 1).alias("avg_pages_viewed"))
    repeats = F.coalesce("n_sessions", F.lit(1)) if fan_out else F.lit(1)
    return (
        customers.join(bought, "customer_id", "left")
        .join(sessions, "customer_id", "left")
        .select(
            "customer_id",
            full_name().alias("full_name"),
            "country",
            "age_group",
            F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
            units(F.col("revenue") * repeats).alias("lifetime_value"),
            "avg_session_sec",
            "avg_pages_viewed",
        )
    )


def customer_summary_view(customers: DataFrame, sales: DataFrame, activity: DataFrame, fan_out: bool = True) -> DataFrame:
    """Per customer: orders, lifetime value, average session and pages.

    Joining both facts to the customer repeats each sale once per session, which inflates the
    lifetime value. `fan_out` keeps that figure by multiplying with the number of sessions;
    without it the value is the true revenue. Neither variant builds the sale x session product.
    """
    return customer_summary_of(customers, sales_by_customer(sales), sessions_by_customer(activity), fan_out)


def product_performance_of(products: DataFrame, by_product: DataFrame) -> DataFrame:
    """The product view from rows of `sales_by_product`."""
    sold = by_product.groupBy("product_id").agg(
        F.sum("n").alias("n"), F.sum("units").alias("total_units_sold"), F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit"))
    return products.join(sold, "product_id", "left").select(
        "product_id",
        "product_name",
        "category",
        "subcategory",
        F.coalesce("n", F.lit(0)).alias("times_sold"),
        "total_units_sold",
        units("revenue").alias("total_revenue"),
        units("profit").alias("total_profit"),
        percent(units("profit"), units("revenue")).alias("profit_margin_pct"),
    )


def product_performance_view(products: DataFrame, sales: DataFrame) -> DataFrame:
    """Per product, sold or not: times sold, units, revenue, profit and margin."""
    sold = sales.groupBy("product_id").agg(
        F.count("sale_id").alias("n"), F.sum("quantity").alias("units"),
        F.sum(cents(sales, "total_amount")).alias("revenue"), F.sum(cents(sales, "profit")).alias("profit"))
    return product_performance_of(products, sold)


def products_by_category(performance: DataFrame, products: DataFrame) -> DataFrame:
    """Catalogue size, average price and average margin per category."""
    priced = products.select("product_id", "unit_price")
    return performance.join(priced, "product_id").groupBy("category").agg(
        F.count("*").alias("products"),
        mean(F.sum("unit_price"), F.count("unit_price")).alias("avg_unit_price"),
        half_up(F.try_divide(F.sum((F.col("profit_margin_pct") * 10).cast("bigint")).cast("double"),
                             F.count("profit_margin_pct").cast("double")) / 10.0, 1).alias("avg_margin_pct"),
    )
