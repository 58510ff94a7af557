"""CSV records with line breaks over many splits, malformed records, and values stored as landed."""

import csv
import random
from decimal import Decimal

import pytest
from conftest import rows

from martwright.operators import cleaning
from martwright.plans import load
from martwright.sources import csv_records, schemas
from martwright.sources import tables as store


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield spark
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_records_are_those_of_the_language_s_reader(small_splits, tmp_path, ending):
    rng = random.Random(2)
    for name in ("a.csv", "b.csv"):
        with open(tmp_path / name, "w", newline="", encoding="utf-8") as file:
            out = csv.writer(file, lineterminator=ending)
            out.writerow(["id", "t", "u"])
            for i in range(200):
                out.writerow([name + str(i), rng.choice(["x", 'a"b', "li\nne", 'two\n\nbreaks, "q"', "é\n", '"']), rng.choice(["u", "\n", "v,w"])])
    want = sorted(tuple(r) for name in ("a.csv", "b.csv") for r in csv.reader(open(tmp_path / name, newline="", encoding="utf-8")) if r[0] != "id")
    got = store.read_csv(small_splits, str(tmp_path), ["id", "t", "u"])
    assert rows(got.filter("_corrupt IS NULL"), "id", "t", "u") == sorted(want, key=repr) and got.filter("_corrupt IS NOT NULL").isEmpty()
    assert small_splits.read.text(str(tmp_path)).rdd.getNumPartitions() > 50


def test_malformed_records_and_a_missing_quote(small_splits, tmp_path, monkeypatch):
    monkeypatch.setattr(csv_records, "MOST_LINES", 5)
    (tmp_path / "a.csv").write_text('id,t\n1,a\n2\n3,b,c\n\n4,"d\ne"\n5,"open\n' + "6,f\n" * 8)
    for line_breaks in (True, False):
        got = store.read_csv(small_splits, str(tmp_path / "a.csv"), ["id", "t"], line_breaks).collect()
        good = sorted((r.id, r.t) for r in got if r._corrupt is None)
        assert (good == [("1", "a"), ("4", "d\ne")]) == line_breaks
        assert {"2", "3,b,c"} <= {r._corrupt for r in got}
    assert not rows(store.read_csv(small_splits, str(tmp_path / "a.csv"), ["t"]).filter("t = 'f' AND _corrupt IS NULL"))


def test_a_broken_customer_is_in_quarantine_and_not_in_the_table(spark, tmp_path):
    header = ",".join(schemas.names(schemas.STAR["dim_customers"]))
    (tmp_path / "c.csv").write_text(f'{header}\n1,Ann,"Li\nu",a@b.c,fr,paris,18,2024-01-01\n2,Bob\n')
    landed = store.read_csv(spark, str(tmp_path / "c.csv"), header.split(","))
    good, bad = cleaning.split(cleaning.customers(landed))
    assert rows(good, "customer_id", "last_name", "country") == [(1, "Li\nU", "Fr")]
    assert rows(bad, "problem", "_corrupt") == [("record", "2,Bob")] and (good.count(), bad.count()) == (1, 1)
    pieces = store.read_csv(spark, str(tmp_path / "c.csv"), header.split(","), line_breaks=False)
    good, bad = cleaning.split(cleaning.customers(pieces))
    assert good.count() == 0 and bad.count() == 3
    with pytest.raises(Exception, match="malformed record"):
        cleaning.split(cleaning.customers(landed, strict=True))[0].collect()


def test_price_and_discount_are_stored_as_landed(spark):
    columns = "sale_id customer_id product_id date_id channel_id quantity unit_price discount profit".split()
    landed = spark.createDataFrame(
        [(*"11111", "8", "10.005", "0.125", "1"), (*"21111", "1", "1.0000001", "0", "1"), (*"31111", "1", "1", "0.0000005", "1")],
        ", ".join(f"{c} string" for c in columns))
    good, bad = cleaning.split(cleaning.sales(landed))
    assert rows(good, "unit_price", "discount", "total_amount") == [(Decimal("10.005"), Decimal("0.125"), Decimal("70.04"))]
    assert rows(bad, "problem") == [("discount",), ("unit_price",)]
    assert [f.dataType.simpleString() for f in good.schema if f.name in ("unit_price", "discount")] == ["decimal(16,6)", "decimal(8,6)"]


def test_an_empty_file_and_one_of_a_header_alone(spark, tmp_path):
    (tmp_path / "h.csv").write_text("id,t\n")
    assert store.read_csv(spark, str(tmp_path / "h.csv"), ["id", "t"]).count() == 0


def test_a_load_keeps_lines_breaks_and_reports_broken_rows(spark, tmp_path):
    from test_load import CSVS

    folder, root = tmp_path / "raw", str(tmp_path / "w")
    folder.mkdir()
    for name, text in CSVS.items():
        (folder / name).write_text(text.replace('"ray, jr"', '"ray,\njr"') + ("7\n" if name == "fact_sales.csv" else ""), encoding="utf-8")
    log = {(r.phase, r.table_name): r.rows for r in load.load_star(spark, str(folder), root).collect()}
    assert log["loaded", "dim_customers"] == 2 and log["quarantined", "fact_sales"] == 2 and log["extracted", "fact_sales"] == 3
