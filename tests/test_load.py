import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows

from martwright.plans import history, load, reports, sales
from martwright.sources import schemas
from martwright.sources import tables as store
from martwright.streaming import run

CSVS = {
    "dim_customers.csv": """customer_id,first_name,last_name,email,country,city,age_group,signup_date
1, ann ,o'neil,ANN@X.ORG,france,paris,18-24,2024-01-05
2,bob,"ray, jr",bob@x.org,germany,bonn,25-34,2024-02-05
x,bad,key,c@x.org,italy,rome,25-34,2024-02-05
""",
    "dim_products.csv": "product_id,product_name,category,subcategory,unit_price,cost_price\n1, lamp ,home,light,10.005,4\n",
    "dim_dates.csv": "date_id,full_date,year,quarter,month,month_name,week,day_of_week,day_name,is_weekend\n1,2024-01-06,2024,1,1,January,1,5,Saturday,1\n",
    "dim_channels.csv": "channel_type,channel_name,channel_id\nOnline,Web,1\n",
    "fact_sales.csv": """sale_id,customer_id,product_id,date_id,channel_id,quantity,unit_price,discount,total_amount,profit
1,1,1,1,1,3,10.00,0.10,999,5
2,2,1,1,1,two,10.00,0,20,5
""",
    "fact_user_activity.csv": "activity_id,customer_id,date_id,channel_id,session_duration_sec,pages_viewed,actions_taken,bounce\n1,1,1,1,30,2,1,0\n",
}


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for name, text in CSVS.items():
        (folder / name).write_text(text, encoding="utf-8")
    return folder


def test_load(spark, landing, tmp_path):
    root = str(tmp_path / "warehouse")
    log = load.load_star(spark, str(landing), root)
    counts = {(r.phase, r.table_name): r.rows for r in log.collect()}
    assert counts["extracted", "dim_customers"] == 3 and counts["loaded", "dim_customers"] == 2
    assert counts["quarantined", "fact_sales"] == 1 and counts["loaded", "fact_sales"] == 1
    tables = store.read_warehouse(spark, root)
    assert {t: df.schema for t, df in tables.items()} == {t: spark.createDataFrame([], ddl).schema for t, ddl in schemas.STAR.items()}
    assert rows(tables["dim_customers"], "first_name", "last_name", "email", "city") == [
        ("Ann", "O'Neil", "ann@x.org", "Paris"), ("Bob", "Ray, Jr", "bob@x.org", "Bonn")]
    sale = tables["fact_sales"].first()
    assert (float(sale.total_amount), float(sale.profit)) == (27.0, 5.0)  # recomputed, and trusted
    assert float(tables["dim_products"].first().unit_price) == 10.01
    store.register_views(tables)
    assert spark.sql("SELECT sum(total_amount) AS t FROM fact_sales JOIN dim_channels USING (channel_id)").first().t == sale.total_amount
    assert sales.sales_by_channel(tables["fact_sales"], tables["dim_channels"]).first().revenue == 27.0
    checks = {r.check: r.value for r in load.validate(spark, root).collect()}
    assert checks["Sales count"] == 1.0 and checks["Total revenue"] == 27.0 and checks["Orphan sales (should be 0)"] == 0.0


def test_reload_replaces_and_failure_keeps(spark, landing, tmp_path):
    root = str(tmp_path / "warehouse")
    load.load_star(spark, str(landing), root)
    (landing / "fact_sales.csv").write_text(CSVS["fact_sales.csv"].replace("two", "2"))
    load.load_star(spark, str(landing), root)
    assert store.read_table(spark, root, "fact_sales", schemas.STAR["fact_sales"]).count() == 2
    (landing / "fact_user_activity.csv").write_text(CSVS["fact_user_activity.csv"].replace(",30,", ",long,"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        load.load_star(spark, str(landing), root, strict=True)
    assert store.read_table(spark, root, "fact_user_activity", schemas.STAR["fact_user_activity"]).count() == 1
    log = spark.read.parquet(f"{root}/etl_run_log")
    assert log.filter("phase = 'failed'").count() == 1 and log.select("run_at").distinct().count() == 3


def test_nothing_loaded_yet(spark, tmp_path):
    tables = store.read_warehouse(spark, str(tmp_path / "none"))
    assert all(df.count() == 0 for df in tables.values()) and set(tables) == set(schemas.STAR)


def test_newest_commit_wins(spark, tmp_path):
    root, ddl = str(tmp_path), "a int"
    for snapshot in ("s1", "s2"):
        rows_written = store.write_snapshot(spark.range(len(snapshot) + int(snapshot[1])).selectExpr("cast(id AS int) a"), root, "t", snapshot)
        assert rows_written == 2 + int(snapshot[1])
        if snapshot == "s1":
            store.commit(spark, root, snapshot, ["t"])
    assert store.read_table(spark, root, "t", ddl).count() == 3  # s2 is written but not committed
    store.commit(spark, root, "s2", ["t"])
    assert store.read_table(spark, root, "t", ddl).count() == 4


def test_run_log_has_one_time_per_run():
    run = load.LoadRun(dt.datetime(2024, 1, 1))
    run.note("loaded", "t", 1)
    run.note("loaded", "u", 2)
    assert {e[0] for e in run.entries} == {dt.datetime(2024, 1, 1)}


def test_names_of_nested_ddl():
    assert schemas.names(schemas.RAW_COUNTRIES)[:4] == ["name", "capital", "region", "subregion"]
    assert schemas.names(schemas.STAR["fact_sales"])[-2:] == ["total_amount", "profit"]


def test_create_if_absent(spark, tmp_path):
    root = str(tmp_path / "w")
    assert set(store.create_if_absent(spark, root)) == set(schemas.STAR)
    assert store.create_if_absent(spark, root) == []
    assert store.read_warehouse(spark, root)["fact_sales"].count() == 0


def test_every_report_runs_on_a_loaded_warehouse(spark, landing, tmp_path):
    root = str(tmp_path / "warehouse")
    load.load_star(spark, str(landing), root)
    tables = reports.open_warehouse(spark, root)
    load.materialize_views(spark, tables, root)
    history.start(spark, root, "dim_customers", tables["dim_customers"], dt.datetime(2024, 1, 1))
    cells = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1, "web", "purchase", 2, Decimal("3.50"))], run.CELLS.rsplit(",", 1)[0])
    cells.write.parquet(f"{root}/sink/window_cells/batch=0")
    assert run.publish_windows(spark, f"{root}/sink", root) == 1
    tables = reports.open_warehouse(spark, root)
    with_input = {"advanced/scd-history": {"customer_id": 1}, "products/top": {"limit": 5}}
    empty = set()
    for name in reports.REPORTS:
        if reports.report(tables, name, **with_input.get(name, {})).count() == 0:
            empty.add(name)
    live_ones = {n for n in reports.REPORTS if n.startswith("live/") and n != "live/crypto/summary"}
    assert empty == live_ones | {"advanced/clv", "customers/lifetime-value",
                                 "advanced/market-basket", "advanced/forecast"}
    shown = reports.report(tables, "advanced/stream-windows").first()
    assert (shown.total_events, shown.total_revenue, shown.purchases) == (2, 3.5, 2)
    ddl = "year int, month int, month_name string, category string, channel_name string, total_orders bigint, total_revenue double"
    kept = store.read_table(spark, root, "v_monthly_sales", ddl).first()
    assert (kept.category, kept.total_orders, kept.total_revenue) == ("home", 1, 27.0)


def test_quotes_in_csv(spark, tmp_path):
    from martwright.sources import tables

    (tmp_path / "c.csv").write_text('id,name,kind\n1,"say ""hi"", you",Online\n2,"two\nlines",Direct\n')
    read = tables.read_csv(spark, str(tmp_path / "c.csv"), ["id", "name", "kind"], line_breaks=True)
    wanted = [("1", 'say "hi", you', "Online"), ("2", "two\nlines", "Direct")]
    assert sorted(map(tuple, read.drop("_corrupt").collect())) == wanted
    tables.write_csv(read, str(tmp_path / "out"))
    assert sorted(map(tuple, tables.read_csv(spark, str(tmp_path / "out"), ["id", "name", "kind"]).drop("_corrupt").collect())) == wanted
