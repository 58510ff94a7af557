import datetime as dt
import json

import pytest
from conftest import rows

from martwright.plans import live
from martwright.sources import schemas
from martwright.sources import tables as store

AT = dt.datetime(2024, 5, 1, 12, 0)
CRYPTO = [{"id": f"c{i}", "symbol": f"s{i}", "name": f"n{i}", "current_price": i + 0.5, "market_cap": 10.0 * i, "total_volume": 1.0,
           "price_change_24h": 0.1, "price_change_percentage_24h": p, "market_cap_rank": 3 - i}
          for i, p in enumerate([1.5, 0, None])]
COUNTRIES = [
    {"name": {"common": "Aland", "official": "Land of A"}, "capital": ["A1", "A2"], "region": "Europe", "population": 10, "area": 2.5,
     "languages": {"x": "Xish", "y": "Yish"}, "currencies": {"AAA": {"name": "Aa"}, "BBB": {}}, "latlng": [1.5, 2.5], "timezones": ["UTC", "UTC+1"]},
    {"name": {"common": "Bare"}, "population": 0, "capital": [], "languages": {}, "currencies": {}, "latlng": [7.0]},
]
WEATHER = [{"latitude": 1.0, "longitude": 2.0, "current": {"time": "2024-05-01T11:00", "temperature_2m": 15.5, "weather_code": 2}}] + [
    {"location_id": i, "current": {"temperature_2m": float(i), "weather_code": 1000 + i}} for i in range(1, 18)]
RATES = {"amount": 1.0, "base": "USD", "date": "2024-05-01", "rates": {"EUR": 0.9, "JPY": 150, "XXX": 2.5}}
GITHUB = {"items": [{"name": "a", "full_name": "o/a", "description": "d" * 300, "language": "Go", "stargazers_count": 5, "forks_count": 1},
                    {"name": "b", "full_name": "o/b", "description": None, "language": None, "stargazers_count": 9, "forks_count": 2}]}


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    for name, doc in {"crypto_20240501_120000": CRYPTO, "countries_20240501_120000": COUNTRIES, "weather_20240501_120000": WEATHER,
                      "exchange_rates_20240501_120000": RATES, "github_20240501_120000": GITHUB}.items():
        (folder / f"{name}.json").write_text(json.dumps(doc, indent=2), encoding="utf-8")
    return folder


@pytest.fixture
def tables(spark, landing, tmp_path):
    live.ingest(spark, str(landing), str(tmp_path / "live"))
    return live.read_live(spark, str(tmp_path / "live"))


def test_all_sources_succeed(spark, tables):
    log = {r.source: (r.status, r.records_count) for r in tables["api_ingestion_log"].collect()}
    assert log == {"CoinGecko": ("SUCCESS", 3), "REST Countries": ("SUCCESS", 2), "Open-Meteo": ("SUCCESS", 15),
                   "Frankfurter": ("SUCCESS", 3), "GitHub": ("SUCCESS", 2)}
    for name, ddl in schemas.LIVE.items():
        assert tables[name].schema == spark.createDataFrame([], ddl).schema


def test_crypto(tables):
    assert [r.name for r in live.crypto_ranked(tables["api_crypto_prices"], 2).collect()] == ["n2", "n1"]
    s = live.crypto_summary(tables["api_crypto_prices"]).first()
    assert (s.total_coins, s.total_market_cap, s.avg_change_pct, s.gainers, s.losers) == (3, 30.0, 0.75, 1, 1)


def test_countries(tables):
    got = {r.name: r for r in tables["api_countries"].collect()}
    a, b = got["Aland"], got["Bare"]
    assert (a.capital, a.languages, a.currencies, a.timezone, a.latitude, a.longitude) == ("A1, A2", "Xish, Yish", "Aa (AAA),  (BBB)", "UTC", 1.5, 2.5)
    assert (b.official_name, b.capital, b.region, b.languages, b.currencies, b.latitude, b.longitude, b.timezone) == ("", "", "", "", "", 7.0, 0.0, "")
    assert live.countries_ranked(tables["api_countries"]).count() == 1
    assert rows(live.countries_by_region(tables["api_countries"])) == [("Europe", 1, 10, 3.0, 10.0)]


def test_weather_follows_the_city_list(tables):
    got = {r.city: r for r in live.weather_current(tables["api_weather"]).collect()}
    assert len(got) == len(live.CITIES) == 15
    assert (got["New York"].temperature_c, got["New York"].weather_desc, got["New York"].measured_at) == (15.5, "Partly cloudy", "2024-05-01T11:00")
    assert (got["Tokyo"].temperature_c, got["Tokyo"].weather_desc) == (2.0, "Code 1002")
    assert got["Tokyo"].measured_at  # falls back to the time of ingestion


def test_a_single_weather_object(spark, tmp_path):
    (tmp_path / "w.json").write_text(json.dumps(WEATHER[0]))
    got = live.flatten_weather(store.read_json_landing(spark, str(tmp_path / "w.json"), schemas.RAW_WEATHER), AT).collect()
    assert [r.city for r in got] == ["New York"]


def test_rates_and_repos(tables):
    assert rows(live.exchange_rates(tables["api_exchange_rates"], live.MAJOR_CURRENCIES)) == [("EUR", 0.9, "2024-05-01"), ("JPY", 150.0, "2024-05-01")]
    assert live.exchange_rates(tables["api_exchange_rates"]).count() == 3
    repos = live.github_ranked(tables["api_github_trending"]).collect()
    assert [(r.repo_name, len(r.description)) for r in repos] == [("b", 0), ("a", 200)]
    assert rows(live.github_by_language(tables["api_github_trending"])) == [("Go", 1, 5, 1, 5.0), ("Unknown", 1, 9, 2, 9.0)]


def test_a_failing_source_keeps_its_table(spark, landing, tmp_path):
    root = str(tmp_path / "live")
    live.ingest(spark, str(landing), root)
    broken = [live.SOURCES[0], live.Source("Gone", "gone_*.json", schemas.RAW_CRYPTO, "api_countries", live.flatten_crypto), live.SOURCES[3]]
    log = {r.source: r for r in live.ingest(spark, str(landing), root, broken).collect()}
    assert log["Gone"].status == "FAILED" and log["Gone"].error_message and log["Frankfurter"].status == "SUCCESS"
    tables = live.read_live(spark, root)
    assert tables["api_countries"].count() == 2
    assert live.ingestion_log(tables["api_ingestion_log"]).first().source == "Frankfurter"
    assert tables["api_ingestion_log"].count() == 8


def test_newest_file_is_taken(spark, landing, tmp_path):
    (landing / "exchange_rates_20240601_000000.json").write_text(json.dumps({**RATES, "date": "2024-06-01", "rates": {"EUR": 1.1}}))
    live.ingest(spark, str(landing), str(tmp_path / "live"), [live.SOURCES[3]])
    assert rows(live.exchange_rates(live.read_live(spark, str(tmp_path / "live"))["api_exchange_rates"])) == [("EUR", 1.1, "2024-06-01")]


def test_nothing_ingested_yet(spark, tmp_path):
    tables = live.read_live(spark, str(tmp_path / "none"))
    assert live.crypto_ranked(tables["api_crypto_prices"]).count() == 0
    assert live.ingestion_log(tables["api_ingestion_log"]).count() == 0


def test_lineage(spark, tmp_path):
    task = {"dag_id": "d", "task_id": "t1", "description": "x", "status": "success", "attempt": 1, "duration_sec": 0.5, "error": None}
    (tmp_path / "lineage.json").write_text(json.dumps({"dag_id": "d", "lineage": [task, {**task, "task_id": "t2", "status": "failed", "duration_sec": None, "error": "boom"}]}, indent=2))
    got = rows(live.lineage_summary(store.read_lineage(spark, str(tmp_path / "lineage.json"))))
    assert got == [("t1", "x", "success", 1, 0.5, None), ("t2", "x", "failed", 1, 0.0, "boom")]


def test_a_run_may_land_in_several_files(spark, tmp_path):
    for name, code in {"20240501_120000": "OLD", "20240502_120000_part1": "EUR", "20240502_120000_part2": "GBP"}.items():
        doc = {"amount": 1.0, "base": "USD", "date": "2024-05-02", "rates": {code: 0.9}}
        (tmp_path / f"exchange_rates_{name}.json").write_text(json.dumps(doc))
    log = live.ingest(spark, str(tmp_path), str(tmp_path / "w")).collect()
    assert {r.source: (r.status, r.records_count) for r in log}["Frankfurter"] == ("SUCCESS", 2)
    assert {r.status for r in log if r.source != "Frankfurter"} == {"FAILED"}  # nothing landed
    rates = live.read_live(spark, str(tmp_path / "w"))["api_exchange_rates"]
    assert sorted(r.target_currency for r in rates.collect()) == ["EUR", "GBP"]
