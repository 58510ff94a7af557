"""The retail star on top of the given tables.

Every method builds one star table lazily, with the joins that the requested columns need and no
others: a query over products and amounts never touches `orders`. Fact joins are left joins on the
primary key of the other side, so leaving one out never changes the rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.functions.calendar import build_dim_date, date_key
from martwright.functions.numeric import MONEY
from martwright.sources import schemas

COST_SHARE = 60  # cost price in percent of the retail price
STAR_EPOCH = dt.date(1995, 1, 1)  # date_id 1

SALE_COLUMNS = tuple(schemas.names(schemas.STAR["fact_sales"]))
FROM_ORDERS = {"customer_id", "date_id", "channel_id"}
FROM_PARTS = {"unit_price", "profit", "profit_cents"}

# The event types of the given stream under their retail names.
EVENT_TYPES = {"view": "page_view", "click": "add_to_cart", "purchase": "purchase", "signup": "search", "error": "logout"}
CHANNELS = ("web", "mobile", "api")


# Money in the given tables is double. It is turned into whole cents at once and computed as long,
# which costs a third of decimal arithmetic per row, then shown as DECIMAL(18,2).


def in_cents(value: Column) -> Column:
    """A double amount in whole cents, rounded half up."""
    return F.signum(value).cast("bigint") * F.floor(F.abs(value) * 100.0 + 0.5)


def percent_of(amount_in_cents: Column, percent: Column) -> Column:
    """`percent` % of an amount in whole cents, rounded half away from zero."""
    part = amount_in_cents * percent
    return F.signum(part).cast("bigint") * F.call_function("div", F.abs(part) + 50, F.lit(100))


def as_money(amount_in_cents: Column) -> Column:
    return (amount_in_cents.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(2,2)")).cast(MONEY)


def cost_cents(price: Column) -> Column:
    return percent_of(in_cents(price), F.lit(COST_SHARE))


class Star:
    """Star tables derived from one folder of parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.schema(schemas.TABLES[table]).parquet(f"{self.folder}/{table}.parquet")

    # dimensions -------------------------------------------------------------------------------

    def customers(self, signup: bool = False) -> DataFrame:
        """Customers with their country; `signup` adds the day of the first order as signup date."""
        name = F.split("c_name", "#")
        rows = (
            self.raw("customer")
            .join(self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.get(name, F.lit(0)).alias("first_name"),
                F.get(name, F.lit(1)).alias("last_name"),
                F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
                F.col("n_name").alias("country"),
                F.col("r_name").alias("city"),
                F.col("c_mktsegment").alias("age_group"),
            )
        )
        if not signup:
            return rows
        first = self.raw("orders").groupBy(F.col("o_custkey").alias("customer_id")).agg(
            F.min("o_orderdate").cast("date").alias("signup_date"))
        return rows.join(first, "customer_id", "left")

    def products(self) -> DataFrame:
        price = F.col("p_retailprice")
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("subcategory"),
            price.cast(MONEY).alias("unit_price"),
            as_money(cost_cents(price)).alias("cost_price"),
        )

    def calendar(self) -> DataFrame:
        """The calendar that sales look dates up in: it reaches as far as the orders do."""
        return self.dates()

    def dates(self) -> DataFrame:
        """The date dimension proper: first to last order day (two values reach the driver)."""
        bounds = self.raw("orders").agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")).first()
        if bounds.lo is None:
            return build_dim_date(self.spark, STAR_EPOCH, STAR_EPOCH).limit(0)
        return build_dim_date(self.spark, bounds.lo.date(), bounds.hi.date(), STAR_EPOCH)

    def channels(self) -> DataFrame:
        priority = F.col("o_orderpriority")
        kind = F.when(priority.isin("1-URGENT", "2-HIGH"), "Direct").otherwise("Online")
        return self.raw("orders").select(priority).distinct().select(
            self._channel_id().alias("channel_id"), priority.alias("channel_name"), kind.alias("channel_type"))

    @staticmethod
    def _channel_id() -> Column:
        return F.substring("o_orderpriority", 1, 1).cast("bigint")

    # facts ------------------------------------------------------------------------------------

    def sales(self, *columns: str) -> DataFrame:
        """One row per order line. The sale id is the order key, so it repeats within an order.

        Reports ask for `total_amount_cents` and `profit_cents` and sum those.
        """
        wanted = columns or SALE_COLUMNS
        off = in_cents(F.col("l_discount"))
        total = percent_of(in_cents(F.col("l_extendedprice")), 100 - off)
        quantity = F.col("l_quantity").cast("int")
        rows = self.raw("lineitem")
        defined = {
            "sale_id": F.col("l_orderkey"),
            "product_id": F.col("l_partkey"),
            "quantity": quantity,
            "discount": F.col("l_discount").cast("decimal(4,2)"),
            "total_amount": as_money(total),
            "total_amount_cents": total,
        }
        if FROM_ORDERS & set(wanted):
            order = self.raw("orders").select(
                "o_orderkey",
                F.col("o_custkey").alias("customer_id"),
                date_key(F.col("o_orderdate").cast("date"), STAR_EPOCH).alias("date_id"),
                self._channel_id().alias("channel_id"),
            )
            rows = rows.join(order, F.col("l_orderkey") == F.col("o_orderkey"), "left")
            defined |= {name: F.col(name) for name in FROM_ORDERS}
        if FROM_PARTS & set(wanted):
            part = self.raw("part").select("p_partkey", "p_retailprice")
            rows = rows.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
            profit = total - quantity * cost_cents(F.col("p_retailprice"))
            defined |= {
                "unit_price": F.col("p_retailprice").cast(MONEY),
                "profit": as_money(profit),
                "profit_cents": profit,
            }
        return rows.select(*[defined[name].alias(name) for name in wanted])

    def activity(self) -> DataFrame:
        """One session per user and day."""
        day = F.col("ts").cast("date")
        micros = F.unix_micros(F.col("ts").cast("timestamp"))
        kind = F.col("event_type")
        date_id = date_key("day", STAR_EPOCH)
        return (
            self.raw("events")
            .groupBy(F.col("user_id").alias("customer_id"), day.alias("day"))
            .agg(
                F.floor((F.max(micros) - F.min(micros)) / 1000000.0).cast("int").alias("session_duration_sec"),
                F.count_if(kind == "view").cast("int").alias("pages_viewed"),
                F.count_if(kind.isin("click", "purchase")).cast("int").alias("actions_taken"),
                F.when(F.count("*") == 1, 1).otherwise(0).alias("bounce"),
            )
            .select(
                (F.col("customer_id") * 100000 + date_id).alias("activity_id"),
                "customer_id",
                date_id.alias("date_id"),
                (F.col("customer_id") % 5 + 1).alias("channel_id"),
                "session_duration_sec",
                "pages_viewed",
                "actions_taken",
                "bounce",
            )
        )

    # events -----------------------------------------------------------------------------------

    def stream_events(self) -> DataFrame:
        """The event stream as it arrives: out of event-time order, with every tenth event sent twice."""
        return with_repeats(as_stream_event(self.raw("events")))

    def tables(self) -> dict[str, DataFrame | Callable[..., DataFrame]]:
        """All star tables; those whose columns cost joins as functions of the wanted columns."""
        return {
            "dim_customers": lambda *columns: self.customers("signup_date" in columns).select(*columns),
            "dim_products": self.products(),
            "dim_date": lambda *columns: self.dates().select(*columns),
            "dim_channels": self.channels(),
            "fact_sales": self.sales,
            "fact_user_activity": self.activity(),
        }


# Arrival order is a fixed permutation of all event ids from 0 up to this prime, the largest below 2^62.
ARRIVAL_MOD = 4611686018427387847
ARRIVAL_STEP = 2850178706419532849


def as_stream_event(events: DataFrame) -> DataFrame:
    """Flat stream events from the given `events` table, batch or streaming."""
    kind = F.col("event_type")
    named = F.coalesce(*[F.when(kind == k, F.lit(v)) for k, v in EVENT_TYPES.items()])
    channel = F.element_at(F.array(*map(F.lit, CHANNELS)), (F.col("user_id") % len(CHANNELS) + 1).cast("int"))
    event_time = F.col("ts").cast("timestamp")
    return events.select(
        F.col("event_id"),
        named.alias("event_type"),
        F.col("user_id").alias("customer_id"),
        event_time.alias("event_time"),
        event_time.alias("processing_time"),
        channel.alias("channel"),
        F.concat(F.lit("/page/"), F.get_json_object("props", "$.k")).alias("page"),
        F.concat(F.lit("sess_"), F.col("user_id").cast("string")).alias("session_id"),
        F.when(kind == "purchase", F.col("value")).alias("value"),
        (F.col("event_id").cast("decimal(19,0)") * F.lit(ARRIVAL_STEP).cast("decimal(19,0)") % F.lit(ARRIVAL_MOD).cast("decimal(19,0)"))
        .cast("bigint").alias("arrival"),
    )


def with_repeats(sent: DataFrame) -> DataFrame:
    """All events, and every tenth of them once more after the others."""
    again = sent.filter(F.col("event_id") % 10 == 0).withColumn("arrival", F.col("arrival") + ARRIVAL_MOD)
    return sent.unionByName(again)
