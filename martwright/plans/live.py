"""Landed API documents flattened to live tables, and the reports over them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.functions.numeric import half_up, mean, ratio
from martwright.sources import schemas
from martwright.sources import tables as store

# Fixed values ---------------------------------------------------------------------------------

# The cities of a weather request, in request order: name, country, latitude, longitude.
CITIES = [
    ("New York", "US", 40.71, -74.01),
    ("London", "UK", 51.51, -0.13),
    ("Tokyo", "JP", 35.68, 139.69),
    ("Sydney", "AU", -33.87, 151.21),
    ("Paris", "FR", 48.86, 2.35),
    ("Berlin", "DE", 52.52, 13.40),
    ("Mumbai", "IN", 19.08, 72.88),
    ("Toronto", "CA", 43.65, -79.38),
    ("Colombo", "LK", 6.93, 79.85),
    ("Dubai", "AE", 25.20, 55.27),
    ("Singapore", "SG", 1.35, 103.82),
    ("Sao Paulo", "BR", -23.55, -46.63),
    ("Cairo", "EG", 30.04, 31.24),
    ("Seoul", "KR", 37.57, 126.98),
    ("Moscow", "RU", 55.76, 37.62),
]
# WMO weather codes.
WEATHER_CODES = {
    0: "Clear sky", 1: "Mainly clear", 2: "Partly cloudy", 3: "Overcast",
    45: "Foggy", 48: "Rime fog",
    51: "Light drizzle", 53: "Moderate drizzle", 55: "Dense drizzle",
    61: "Slight rain", 63: "Moderate rain", 65: "Heavy rain",
    71: "Slight snow", 73: "Moderate snow", 75: "Heavy snow",
    80: "Slight showers", 81: "Moderate showers", 82: "Violent showers",
    95: "Thunderstorm", 96: "Thunderstorm with hail",
}
MAJOR_CURRENCIES = ["EUR", "GBP", "JPY", "AUD", "CAD", "CHF", "CNY", "INR", "KRW", "BRL", "SGD", "NZD", "MXN", "ZAR", "SEK"]

# Flattening -----------------------------------------------------------------------------------


def _at(at: dt.datetime) -> Column:
    return F.lit(at).cast("timestamp").alias("ingested_at")


def _or(value: Column | str, default) -> Column:
    return F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(default))


def flatten_crypto(raw: DataFrame, at: dt.datetime) -> DataFrame:
    return raw.select(
        "id", "symbol", "name", F.col("current_price").alias("current_price_usd"), "market_cap", "total_volume",
        "price_change_24h", F.col("price_change_percentage_24h").alias("price_change_pct_24h"), "high_24h", "low_24h",
        "circulating_supply", F.col("market_cap_rank").alias("rank"), "last_updated", _at(at))


def flatten_countries(raw: DataFrame, at: dt.datetime) -> DataFrame:
    """Names, lists and maps as text; missing parts become empty text or zero."""
    currency = F.transform(
        F.map_entries("currencies"),
        lambda e: F.concat(F.coalesce(e["value"]["name"], F.lit("")), F.lit(" ("), e["key"], F.lit(")")))
    return raw.select(
        _or("name.common", "").alias("name"),
        _or("name.official", "").alias("official_name"),
        _or(F.array_join("capital", ", "), "").alias("capital"),
        _or("region", "").alias("region"),
        _or("subregion", "").alias("subregion"),
        _or("population", 0).cast("bigint").alias("population"),
        _or("area", 0.0).alias("area"),
        _or(F.array_join(F.map_values("languages"), ", "), "").alias("languages"),
        _or(F.array_join(currency, ", "), "").alias("currencies"),
        _or("flag", "").alias("flag_emoji"),
        _or(F.get("latlng", F.lit(0)), 0.0).alias("latitude"),
        _or(F.get("latlng", F.lit(1)), 0.0).alias("longitude"),
        _or(F.get("timezones", F.lit(0)), "").alias("timezone"),
        _at(at),
    )


def flatten_weather(raw: DataFrame, at: dt.datetime) -> DataFrame:
    """One row per city. The n-th answer belongs to the n-th city; answers beyond the list are left out.

    The answer carries its place as `location_id`, which the first one lacks.
    """
    spark = raw.sparkSession
    cities = spark.createDataFrame(
        [(i, *city) for i, city in enumerate(CITIES)],
        "position int, city string, country string, latitude double, longitude double")
    texts = F.create_map(*[F.lit(v) for pair in WEATHER_CODES.items() for v in pair])
    code = _or("current.weather_code", 0)
    return (
        raw.select(_or("location_id", 0).alias("position"), "current")
        .join(F.broadcast(cities), "position")  # the fixed list above
        .select(
            "city",
            "country",
            "latitude",
            "longitude",
            F.col("current.temperature_2m").alias("temperature_c"),
            F.col("current.wind_speed_10m").alias("wind_speed_kmh"),
            F.col("current.relative_humidity_2m").alias("humidity_pct"),
            code.alias("weather_code"),
            F.coalesce(F.try_element_at(texts, code), F.concat(F.lit("Code "), code.cast("string"))).alias("weather_desc"),
            _or("current.time", at.strftime("%Y-%m-%dT%H:%M")).alias("measured_at"),
            _at(at),
        )
    )


def flatten_exchange_rates(raw: DataFrame, at: dt.datetime) -> DataFrame:
    """One row per currency of the rates map; the base is US dollars unless the document names one."""
    return raw.select(
        _or("base", "USD").alias("base_currency"),
        F.explode("rates").alias("target_currency", "rate"),
        _or("date", at.strftime("%Y-%m-%d")).alias("rate_date"),
        _at(at),
    )


def flatten_github(raw: DataFrame, at: dt.datetime) -> DataFrame:
    return raw.select(F.inline("items")).select(
        F.col("name").alias("repo_name"), "full_name",
        F.substring(_or("description", ""), 1, 200).alias("description"), "language",
        F.col("stargazers_count").alias("stars"), F.col("forks_count").alias("forks"),
        F.col("open_issues_count").alias("open_issues"), F.col("watchers_count").alias("watchers"),
        "created_at", "updated_at", "html_url", _at(at))


# Ingestion ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Source:
    """One landed source: its label in the log, where its files lie, and how they become a table."""

    label: str
    files: str
    ddl: str
    table: str
    flatten: Callable[[DataFrame, dt.datetime], DataFrame]


SOURCES = (
    Source("CoinGecko", "crypto_*.json", schemas.RAW_CRYPTO, "api_crypto_prices", flatten_crypto),
    Source("REST Countries", "countries_*.json", schemas.RAW_COUNTRIES, "api_countries", flatten_countries),
    Source("Open-Meteo", "weather_*.json", schemas.RAW_WEATHER, "api_weather", flatten_weather),
    Source("Frankfurter", "exchange_rates_*.json", schemas.RAW_EXCHANGE_RATES, "api_exchange_rates", flatten_exchange_rates),
    Source("GitHub", "github_*.json", schemas.RAW_GITHUB, "api_github_trending", flatten_github),
)


def ingest(spark: SparkSession, landing: str, root: str, sources: Sequence[Source] = SOURCES) -> DataFrame:
    """Replace each live table by the newest landing run of its source, of one file or many, and log the outcome.

    A source that fails is logged with its error and keeps its old table; the others go on.
    """
    outcomes = []
    for source in sources:
        started = dt.datetime.now(dt.timezone.utc)
        status, rows, problem = "SUCCESS", 0, None
        try:
            files = store.latest_run(store.landed_files(spark, f"{landing.rstrip('/')}/{source.files}"))
            if not files:
                raise FileNotFoundError(f"nothing landed as {source.files}")
            table = source.flatten(store.read_json_landing(spark, files, source.ddl), started)
            snapshot = started.strftime("%Y%m%d%H%M%S%f")
            rows = store.write_snapshot(
                table, root, source.table, snapshot, schemas.names(schemas.LIVE[source.table]))
            store.commit(spark, root, snapshot, [source.table])
        except Exception as error:  # isolated per source: the log carries the reason
            status, rows, problem = "FAILED", 0, str(error)
        outcomes.append((source.label, status, rows, problem, started, dt.datetime.now(dt.timezone.utc)))
    log = spark.createDataFrame(outcomes, schemas.INGESTION_LOG)
    store.append(log.coalesce(1), f"{root.rstrip('/')}/api_ingestion_log")
    return log


def read_live(spark: SparkSession, root: str) -> Mapping[str, DataFrame]:
    """The live tables and the log; those never ingested are empty."""
    log = store.read_parquet(spark, f"{root.rstrip('/')}/api_ingestion_log", schemas.INGESTION_LOG)
    return {**store.read_warehouse(spark, root, schemas.LIVE), "api_ingestion_log": log}


# Reports --------------------------------------------------------------------------------------


def crypto_ranked(crypto: DataFrame, limit: int = 30) -> DataFrame:
    return crypto.select(
        "name", "symbol", "current_price_usd", "market_cap", "total_volume", "price_change_24h", "price_change_pct_24h",
        "high_24h", "low_24h", "circulating_supply", "rank", "last_updated").orderBy("rank", "name").limit(limit)


def crypto_summary(crypto: DataFrame) -> DataFrame:
    change = F.col("price_change_pct_24h")
    return crypto.agg(
        F.count("*").alias("total_coins"),
        half_up(F.sum("market_cap"), 0).alias("total_market_cap"),
        half_up(F.sum("total_volume"), 0).alias("total_volume_24h"),
        half_up(F.avg(change), 2).alias("avg_change_pct"),
        F.count_if(change > 0).alias("gainers"),
        F.count_if(change <= 0).alias("losers"),
    )


def countries_ranked(countries: DataFrame) -> DataFrame:
    return (
        countries.filter(F.col("population") > 0)
        .select("name", "capital", "region", "subregion", "population", "area", "languages", "currencies", "flag_emoji",
                "latitude", "longitude")
        .orderBy(F.desc("population"), "name")
    )


def countries_by_region(countries: DataFrame) -> DataFrame:
    return (
        countries.filter((F.col("region") != "") & (F.col("population") > 0))
        .groupBy("region")
        .agg(
            F.count("*").alias("country_count"),
            F.sum("population").alias("total_population"),
            half_up(F.sum("area"), 0).alias("total_area"),
            mean(F.sum("population"), F.count("population"), 0).alias("avg_population"),
        )
        .orderBy(F.desc("total_population"))
    )


def weather_current(weather: DataFrame) -> DataFrame:
    return weather.select(
        "city", "country", "temperature_c", "wind_speed_kmh", "humidity_pct", "weather_desc", "measured_at").orderBy(
        "city", "measured_at", "country", "temperature_c", "wind_speed_kmh", "humidity_pct", "weather_desc")


def exchange_rates(rates: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    chosen = rates.filter(F.col("target_currency").isin(list(only))) if only else rates
    return chosen.select("target_currency", "rate", "rate_date").orderBy("target_currency", "rate_date", "rate")


def github_ranked(repos: DataFrame) -> DataFrame:
    return repos.select(
        "repo_name", "full_name", "description", "language", "stars", "forks", "open_issues", "watchers", "html_url"
    ).orderBy(F.desc("stars"), "full_name")


def github_by_language(repos: DataFrame) -> DataFrame:
    """Grouped by the language as landed; a missing one is labelled afterwards."""
    return (
        repos.groupBy("language")
        .agg(
            F.count("*").alias("repo_count"),
            F.sum("stars").alias("total_stars"),
            F.sum("forks").alias("total_forks"),
            half_up(ratio(F.sum("stars"), F.count("stars")), 0).alias("avg_stars"),
        )
        .withColumn("language", _or("language", "Unknown"))
        .orderBy(F.desc("total_stars"))
    )


def ingestion_log(log: DataFrame) -> DataFrame:
    return log.orderBy(F.desc("started_at"))


def lineage_summary(lineage: DataFrame) -> DataFrame:
    return lineage.select(
        "task_id", "description", "status", "attempt", F.coalesce("duration_sec", F.lit(0.0)).alias("duration_sec"), "error")
