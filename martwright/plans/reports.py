"""All reports by name over a loaded warehouse.

    tables = open_warehouse(spark, "/data/warehouse")
    report(tables, "sales/monthly").show()
    report(tables, "products/top", limit=5).show()
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from martwright.operators import scd
from martwright.plans import advanced, history, live, load, sales, views
from martwright.sources import schemas
from martwright.sources import tables as store
from martwright.streaming import events as ev

RFM_AS_OF = dt.date(2024, 12, 31)  # fixed value: reference day of recency unless one is given

Tables = Mapping[str, DataFrame]


def open_warehouse(spark: SparkSession, root: str) -> Tables:
    """Every table the reports read; those never written are empty."""
    return {
        **store.read_warehouse(spark, root),
        **store.read_warehouse(spark, root, {"stream_windows": schemas.STREAM_WINDOWS}),
        **{f"{table}_history": history.open_history(spark, root, table) for table in schemas.HISTORY},
        **live.read_live(spark, root),
    }


def _star(t: Tables, *names: str) -> list[DataFrame]:
    return [t[name] for name in names]


CUSTOMERS, PRODUCTS, DATES, CHANNELS = "dim_customers", "dim_products", "dim_date", "dim_channels"
SALES, ACTIVITY = "fact_sales", "fact_user_activity"

REPORTS = {
    "overview": lambda t: sales.overview(*_star(t, SALES, CUSTOMERS, PRODUCTS, ACTIVITY)),
    "sales/monthly": lambda t: sales.monthly_sales(*_star(t, SALES, DATES)),
    "sales/by-category": lambda t: sales.sales_by_category(*_star(t, SALES, PRODUCTS)),
    "sales/by-channel": lambda t: sales.sales_by_channel(*_star(t, SALES, CHANNELS)),
    "sales/by-country": lambda t, limit=None: sales.sales_by_country(*_star(t, SALES, CUSTOMERS), limit),
    "sales/daily-pattern": lambda t: sales.daily_pattern(*_star(t, SALES, DATES)),
    "products/top": lambda t, limit=10: sales.top_products(*_star(t, SALES, PRODUCTS), limit),
    "products/by-category": lambda t: views.products_by_category(load.view(t, "v_product_performance"), t[PRODUCTS]),
    "products/margin-analysis": lambda t: load.view(t, "v_product_performance"),
    "customers/segments": lambda t, tiers=sales.TIERS: sales.customer_segments(*_star(t, CUSTOMERS, SALES), tiers),
    "customers/summary": lambda t: load.view(t, "v_customer_summary"),
    "customers/lifetime-value": lambda t: advanced.clv(*_star(t, CUSTOMERS, SALES, DATES), limit=None),
    "customers/by-country": lambda t: sales.customers_by_country(t[CUSTOMERS]),
    "activity/engagement": lambda t: sales.engagement_by_channel(*_star(t, ACTIVITY, CHANNELS)),
    "advanced/monthly-trend": lambda t: advanced.monthly_trend(*_star(t, SALES, DATES)),
    "advanced/cohort-analysis": lambda t: advanced.cohort_retention(*_star(t, CUSTOMERS, SALES, DATES)),
    "advanced/rfm": lambda t, as_of=RFM_AS_OF: advanced.rfm(*_star(t, CUSTOMERS, SALES, DATES), as_of),
    "advanced/rfm-summary": lambda t, as_of=RFM_AS_OF: advanced.rfm_summary(
        advanced.rfm(*_star(t, CUSTOMERS, SALES, DATES), as_of)),
    "advanced/market-basket": lambda t, **options: advanced.market_basket(*_star(t, SALES, PRODUCTS), **options),
    "advanced/pareto": lambda t: advanced.pareto(*_star(t, SALES, CUSTOMERS)),
    "advanced/decomposition": lambda t: advanced.ts_decompose(*_star(t, SALES, DATES)),
    "advanced/clv": lambda t, limit=50: advanced.clv(*_star(t, CUSTOMERS, SALES, DATES), limit=limit),
    "advanced/channel-attribution": lambda t: advanced.channel_attribution(*_star(t, SALES, CHANNELS)),
    "advanced/forecast": lambda t, horizon=3: advanced.revenue_forecast(*_star(t, SALES, DATES), horizon),
    "advanced/churn-risk": lambda t, as_of=RFM_AS_OF: advanced.churn_risk(*_star(t, CUSTOMERS, SALES, DATES), as_of),
    "advanced/stream-windows": lambda t: ev.stream_windows_latest(t["stream_windows"]),
    "advanced/scd-history": lambda t, customer_id: scd.scd_history(t["dim_customers_history"], "customer_id", customer_id),
    "live/crypto": lambda t: live.crypto_ranked(t["api_crypto_prices"]),
    "live/crypto/summary": lambda t: live.crypto_summary(t["api_crypto_prices"]),
    "live/countries": lambda t: live.countries_ranked(t["api_countries"]),
    "live/countries/by-region": lambda t: live.countries_by_region(t["api_countries"]),
    "live/weather": lambda t: live.weather_current(t["api_weather"]),
    "live/exchange-rates": lambda t, only=None: live.exchange_rates(t["api_exchange_rates"], only),
    "live/github": lambda t: live.github_ranked(t["api_github_trending"]),
    "live/github/by-language": lambda t: live.github_by_language(t["api_github_trending"]),
    "live/ingestion-log": lambda t: live.ingestion_log(t["api_ingestion_log"]),
}


def report(tables: Tables, name: str, **options) -> DataFrame:
    return REPORTS[name](tables, **options)
