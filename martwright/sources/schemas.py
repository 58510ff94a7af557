"""Declared schemas as DDL text: nothing in this package relies on inference."""

from __future__ import annotations

import re


def names(ddl: str) -> list[str]:
    """Column names of a DDL text, nested types left out."""
    flat = re.sub(r"\([^)]*\)", "", ddl)
    while re.search(r"<[^<>]*>", flat):
        flat = re.sub(r"<[^<>]*>", "", flat)
    return [column.split()[0] for column in flat.split(",")]


# The given tables. Declaring them saves a job per table that would read the file footers.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string"),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

# Warehouse tables, dimensions before facts (the load order).
STAR = {
    "dim_customers": (
        "customer_id bigint, first_name string, last_name string, email string, country string, city string, "
        "age_group string, signup_date date"),
    "dim_products": (
        "product_id bigint, product_name string, category string, subcategory string, "
        "unit_price decimal(18,2), cost_price decimal(18,2)"),
    "dim_date": (
        "date_id bigint, full_date date, year int, quarter int, month int, month_name string, week int, "
        "day_of_week int, day_name string, is_weekend int"),
    "dim_channels": "channel_id bigint, channel_name string, channel_type string",
    "fact_sales": (
        "sale_id bigint, customer_id bigint, product_id bigint, date_id bigint, channel_id bigint, quantity int, "
        "unit_price decimal(16,6), discount decimal(8,6), total_amount decimal(18,2), profit decimal(18,2)"),
    "fact_user_activity": (
        "activity_id bigint, customer_id bigint, date_id bigint, channel_id bigint, session_duration_sec int, "
        "pages_viewed int, actions_taken int, bounce int"),
}

# Landing file of each warehouse table.
STAR_FILES = {
    "dim_customers": "dim_customers.csv",
    "dim_products": "dim_products.csv",
    "dim_date": "dim_dates.csv",
    "dim_channels": "dim_channels.csv",
    "fact_sales": "fact_sales.csv",
    "fact_user_activity": "fact_user_activity.csv",
}

# Landing JSON. Maps must be declared: their keys are data, not structure.
RAW_CRYPTO = (
    "id string, symbol string, name string, current_price double, market_cap double, total_volume double, "
    "price_change_24h double, price_change_percentage_24h double, high_24h double, low_24h double, "
    "circulating_supply double, market_cap_rank int, last_updated string")
RAW_COUNTRIES = (
    "name struct<common:string,official:string>, capital array<string>, region string, subregion string, "
    "population bigint, area double, languages map<string,string>, currencies map<string,struct<name:string>>, "
    "flag string, latlng array<double>, timezones array<string>")
RAW_WEATHER = (
    "latitude double, longitude double, location_id int, "
    "current struct<time:string,temperature_2m:double,wind_speed_10m:double,relative_humidity_2m:double,weather_code:int>")
RAW_EXCHANGE_RATES = "amount double, base string, date string, rates map<string,double>"
RAW_GITHUB = (
    "items array<struct<name:string,full_name:string,description:string,language:string,stargazers_count:bigint,"
    "forks_count:bigint,open_issues_count:bigint,watchers_count:bigint,created_at:string,updated_at:string,"
    "html_url:string>>")

# Live tables flattened from the landing JSON.
LIVE = {
    "api_crypto_prices": (
        "id string, symbol string, name string, current_price_usd double, market_cap double, total_volume double, "
        "price_change_24h double, price_change_pct_24h double, high_24h double, low_24h double, "
        "circulating_supply double, rank int, last_updated string, ingested_at timestamp"),
    "api_countries": (
        "name string, official_name string, capital string, region string, subregion string, population bigint, "
        "area double, languages string, currencies string, flag_emoji string, latitude double, longitude double, "
        "timezone string, ingested_at timestamp"),
    "api_weather": (
        "city string, country string, latitude double, longitude double, temperature_c double, wind_speed_kmh double, "
        "humidity_pct double, weather_code int, weather_desc string, measured_at string, ingested_at timestamp"),
    "api_exchange_rates": (
        "base_currency string, target_currency string, rate double, rate_date string, ingested_at timestamp"),
    "api_github_trending": (
        "repo_name string, full_name string, description string, language string, stars bigint, forks bigint, "
        "open_issues bigint, watchers bigint, created_at string, updated_at string, html_url string, "
        "ingested_at timestamp"),
}
INGESTION_LOG = (
    "source string, status string, records_count bigint, error_message string, started_at timestamp, "
    "completed_at timestamp")

EVENT = (
    "event_id string, event_type string, customer_id bigint, event_time timestamp, processing_time timestamp, "
    "channel string, metadata struct<page:string,session_id:string,value:double>")
STREAM_EVENTS = (
    "event_id string, event_type string, customer_id bigint, event_time timestamp, processing_time timestamp, "
    "channel string, page string, session_id string, value double")
STREAM_WINDOWS = (
    "window_start timestamp, total_events bigint, total_revenue double, unique_customers bigint, page_views bigint, "
    "purchases bigint, add_to_cart bigint, searches bigint")

VERSION = "effective_from timestamp, effective_to timestamp, is_current int, version int, change_type string"
HISTORY = {table: f"{STAR[table]}, {VERSION}" for table in ("dim_customers", "dim_products")}
CHANGE_LOG = (
    "table_name string, record_id string, change_type string, changed_fields string, old_values string, "
    "new_values string, changed_at timestamp")

QUALITY_REPORT = (
    "audit_timestamp string, total_checks bigint, passed bigint, warnings bigint, failures bigint, "
    "checks array<struct<timestamp:string,category:string,check:string,status:string,severity:string,details:string>>, "
    "profiles map<string,struct<count:bigint,min:double,max:double,mean:double,median:double,std:double,"
    "total:double,skewness:double>>")
LINEAGE = (
    "dag_id string, lineage array<struct<dag_id:string,task_id:string,description:string,status:string,attempt:int,"
    "start_time:string,end_time:string,duration_sec:double,error:string>>")
