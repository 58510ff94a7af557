"""Cleaning of landed rows: typed good rows and a quarantine of the others.

Landed columns are text. A required value that does not cast puts the row into quarantine together
with the reason; `strict` makes the first such row an error instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.functions.numeric import MONEY, PRICE, SHARE, sale_total
from martwright.functions.text import strip_ws, title_case
from martwright.sources.csv_records import CORRUPT

PROBLEM = "problem"
EXACT = (PRICE, SHARE)  # types whose values must not lose digits


def _typed(df: DataFrame, types: dict[str, str], strict: bool) -> DataFrame:
    """Cast `types` and add `problem`, the list of columns that did not cast.

    Casts ignore white space around a value. A price or share with more digits than its type keeps does not cast. A record
    that the reader marked as corrupt has the problem `record` alone.
    """
    wide = "decimal(38,18)"
    corrupt = F.col(CORRUPT) if CORRUPT in df.columns else F.lit(None).cast("string")
    if strict:
        stop = F.when(corrupt.isNotNull(), F.raise_error(F.concat(F.lit("malformed record: "), corrupt)).cast("string"))
        return df.withColumn(PROBLEM, F.array_compact(F.array(stop))).withColumns({c: F.col(c).cast(t) for c, t in types.items()})
    cast = {c: F.col(c).try_cast(t) for c, t in types.items()}
    lost = {c: v.isNull() | (v != F.col(c).try_cast(wide)) if t in EXACT else v.isNull() for (c, v), t in zip(cast.items(), types.values())}
    failed = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(c)) for c, bad in lost.items()]))
    return df.withColumn(PROBLEM, F.when(corrupt.isNotNull(), F.array(F.lit("record"))).otherwise(failed)).withColumns(cast)


def split(typed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without and with a problem."""
    good = typed.filter(F.size(PROBLEM) == 0).drop(PROBLEM, CORRUPT)
    return good, typed.filter(F.size(PROBLEM) > 0).withColumn(PROBLEM, F.array_join(PROBLEM, ","))


def customers(df: DataFrame, strict: bool = False) -> DataFrame:
    """Trim everything, title-case names and places, lower-case the address.

    A signup date that is none becomes NULL: the customer stays, and so do the sales.
    """
    titled = {c: title_case(strip_ws(c)) for c in ("first_name", "last_name", "country", "city")}
    tidy = df.withColumns({**titled, "email": F.lower(strip_ws("email")), "age_group": strip_ws("age_group")})
    typed = _typed(tidy, {"customer_id": "bigint"}, strict)
    day = F.col("signup_date")
    return typed.withColumn("signup_date", day.cast("date") if strict else day.try_cast("date"))


def products(df: DataFrame, strict: bool = False) -> DataFrame:
    tidy = df.withColumn("product_name", strip_ws("product_name"))
    return _typed(tidy, {"product_id": "bigint", "unit_price": MONEY, "cost_price": MONEY}, strict)


def dates(df: DataFrame, strict: bool = False) -> DataFrame:
    ints = dict.fromkeys(("year", "quarter", "month", "week", "day_of_week", "is_weekend"), "int")
    return _typed(df, {"date_id": "bigint", "full_date": "date", **ints}, strict)


def channels(df: DataFrame, strict: bool = False) -> DataFrame:
    return _typed(df, {"channel_id": "bigint"}, strict)


def sales(df: DataFrame, strict: bool = False) -> DataFrame:
    """Cast the measures and compute the amount anew from price and discount as landed, which are kept as they are;
    the profit is taken as landed."""
    keys = dict.fromkeys(("sale_id", "customer_id", "product_id", "date_id", "channel_id"), "bigint")
    return recompute_sales(_typed(df, {**keys, "quantity": "int", "unit_price": PRICE, "discount": SHARE, "profit": MONEY}, strict))


def recompute_sales(df: DataFrame) -> DataFrame:
    return df.withColumn("total_amount", sale_total("quantity", "unit_price", "discount"))


def derive_sale_amounts(df: DataFrame, cost: Column | str = "cost_price") -> DataFrame:
    """Amount and profit = amount - quantity x cost."""
    cost = F.col(cost) if isinstance(cost, str) else cost
    paid = (F.col("quantity").cast("decimal(10,0)") * cost.cast(MONEY)).cast(MONEY)
    return recompute_sales(df).withColumn("profit", (F.col("total_amount") - paid).cast(MONEY))


def activity(df: DataFrame, strict: bool = False) -> DataFrame:
    keys = dict.fromkeys(("activity_id", "customer_id", "date_id", "channel_id"), "bigint")
    measures = dict.fromkeys(("session_duration_sec", "pages_viewed", "actions_taken", "bounce"), "int")
    return _typed(df, {**keys, **measures}, strict)


CLEANERS = {
    "dim_customers": customers,
    "dim_products": products,
    "dim_date": dates,
    "dim_channels": channels,
    "fact_sales": sales,
    "fact_user_activity": activity,
}
