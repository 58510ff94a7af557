"""Facts in month partitions with partial aggregates beside them, from which the views are kept up to date.

A load replaces whole months: the facts of each month it brings and the partial sums of these months become visible in
one commit (tables in parts, `sources/tables.py`). Other months are neither read nor written.

The partial sums are by key and not by what the views show of a dimension, so a product that changes its
category moves in all months without any month being worked out anew.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.plans import views
from martwright.sources import schemas
from martwright.sources import tables as store

LG_K = 14  # a sketch of distinct customers has 2^LG_K registers of 6 bits at most, whatever it has seen
REACH_ERROR = 3 * 1.04 / 2 ** (LG_K / 2)  # three standard errors of a merged sketch, as a share of the count
MONTH = "year_month"  # year * 100 + month; 0 for facts whose date the calendar does not have

FACTS = {"fact_sales": schemas.STAR["fact_sales"], "fact_user_activity": schemas.STAR["fact_user_activity"]}


def customer_sketches(sales: DataFrame, *by: str) -> DataFrame:
    """Sketches of the distinct customers by `by` and channel; sketches of such rows can be merged in any grouping."""
    return sales.groupBy(*by, "channel_id").agg(F.hll_sketch_agg("customer_id", LG_K).alias("customers"))


PARTIALS = {
    "sales_by_product": (
        "fact_sales", views.sales_by_product,
        "product_id bigint, channel_id bigint, n bigint, units bigint, n_amount bigint, revenue bigint, profit bigint"),
    "sales_by_customer": ("fact_sales", views.sales_by_customer, "customer_id bigint, orders bigint, revenue bigint"),
    "sessions_by_customer": (
        "fact_user_activity", views.sessions_by_customer,
        "customer_id bigint, n_sessions bigint, seconds bigint, n_seconds bigint, pages bigint, n_pages bigint"),
    "customers_by_channel": ("fact_sales", customer_sketches, "channel_id bigint, customers binary"),
}


def read_months(spark: SparkSession, root: str, table: str, months: Sequence[int] | None = None) -> DataFrame:
    """The rows of a fact or partial table with their `year_month`: of all months, or of those asked for."""
    return store.read_parts(spark, root, f"{table}_by_month", FACTS.get(table) or PARTIALS[table][2], MONTH, months)


def load_months(spark: SparkSession, root: str, facts: Mapping[str, DataFrame], dates: DataFrame,
                emptied: Sequence[int] = ()) -> dict[str, list[int]]:
    """Replace the months that the given facts have rows in, and the `emptied` ones; returns the months of each fact.

    `facts` has whole months of `fact_sales`, `fact_user_activity` or both. A sale has one date, so its lines are in one month.
    """
    snapshot = store.new_snapshot()
    path = lambda table: store.snapshot_path(root, f"{table}_by_month", snapshot)
    calendar = dates.select(F.col("date_id").alias("_day"), (F.col("year") * 100 + F.col("month")).alias("_month"))
    touched, parts = {}, {}
    for table, rows in facts.items():
        placed = store.typed(rows, FACTS[table]).join(calendar, F.col("date_id") == F.col("_day"), "left")
        placed = placed.withColumn(MONTH, F.coalesce("_month", F.lit(0))).drop("_day", "_month")
        # A month's rows go to a few tasks and not all, so that a month is not as many files as there are tasks.
        placed.repartition(MONTH, F.pmod(F.xxhash64("customer_id", "product_id" if "product_id" in rows.columns else "activity_id"), F.lit(8))).write.partitionBy(
            MONTH).parquet(path(table))
        written = store.read_parquet(spark, path(table), f"{FACTS[table]}, {MONTH} int")
        months = sorted({r[0] for r in written.select(MONTH).distinct().collect()} | set(emptied))
        touched[table] = parts[f"{table}_by_month"] = months
        for name, (of, sums, ddl) in PARTIALS.items():
            if of == table:
                store.typed(sums(written, MONTH), f"{ddl}, {MONTH} int").write.partitionBy(MONTH).parquet(path(name))
                parts[f"{name}_by_month"] = months
    store.commit_parts(spark, root, snapshot, parts)
    return touched


def reach(spark: SparkSession, root: str, *by: str) -> DataFrame:
    """About how many distinct customers bought, by month (`year_month`), channel (`channel_id`), both, or in all.

    Opt-in beside the exact counts, which have to see every sale again: only the stored sketches are read, one a month and
    channel, and merged. The count is off by at most REACH_ERROR but for about one count in 370. Unknown customers are not counted.
    """
    merged = F.hll_sketch_estimate(F.hll_union_agg("customers"))
    return read_months(spark, root, "customers_by_channel").groupBy(*by).agg(F.coalesce(merged, F.lit(0).cast("bigint")).alias("customers"))


def view(spark: SparkSession, root: str, dims: Mapping, name: str) -> DataFrame:
    """A semantic view from the partial sums of all months and the dimensions as they are."""
    dim = lambda table: store.pick(dims, table, *schemas.names(schemas.STAR[table]))
    if name == "v_monthly_sales":
        months = dim("dim_date").select((F.col("year") * 100 + F.col("month")).alias(MONTH), *views.MONTH).distinct()
        return views.monthly_sales_of(read_months(spark, root, "sales_by_product").join(months, MONTH), dim("dim_products"), dim("dim_channels"))
    if name == "v_customer_summary":
        return views.customer_summary_of(
            dim("dim_customers"), read_months(spark, root, "sales_by_customer"), read_months(spark, root, "sessions_by_customer"))
    if name == "v_product_performance":
        return views.product_performance_of(dim("dim_products"), read_months(spark, root, "sales_by_product"))
    raise KeyError(name)
