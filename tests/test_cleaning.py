import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from martwright.functions.calendar import build_dim_date
from martwright.functions.numeric import first_digit, half_up, percent, sale_total
from martwright.functions.text import strip_ws, title_case
from martwright.operators import cleaning


@pytest.mark.parametrize("text", ["o'neil", "mary-jane", "x1y2z", "ÉCOLE d'été", "  two  words ", "ALL CAPS", "", "mc donald3rd"])
def test_title_case_matches_the_language_rule(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(title_case("t")).first()[0]
    assert got == text.title()


@pytest.mark.parametrize("text", ["\t a b \n", "  x", "x\r\n", " x ", "", "   "])
def test_strip_takes_any_white_space(spark, text):
    assert spark.createDataFrame([(text,)], "t string").select(strip_ws("t")).first()[0] == text.strip()


def test_rounding(spark):
    got = spark.range(1).select(
        half_up(F.lit(2.345), 2), half_up(F.lit(-2.5), 0), half_up(F.lit(-0.001), 2), half_up(F.lit(None).cast("double"), 2),
        percent(F.lit(1), F.lit(0)), percent(F.lit(1), F.lit(3))).first()
    assert list(got) == [2.35, -3.0, 0.0, None, None, 33.3]
    assert str(got[2]) == "0.0"


def test_sale_total_is_exact(spark):
    got = spark.createDataFrame([(3, Decimal("0.35"), Decimal("0.10"))], "q int, p decimal(18,2), d decimal(4,2)").select(
        sale_total("q", "p", "d")).first()[0]
    assert got == Decimal("0.95")  # 0.945 rounds half up


def test_first_digit(spark):
    df = spark.createDataFrame([("0.01",), ("0.00001",), ("1000000000",), ("305.2",), ("0",)], "t string")
    assert [r[0] for r in df.select(first_digit(F.col("t").cast("decimal(20,6)"))).collect()] == [1, 1, 1, 3, None]


def test_calendar(spark):
    days = build_dim_date(spark, dt.date(2023, 1, 1), dt.date(2024, 12, 31))
    assert days.count() == 731
    first = days.orderBy("date_id").first()
    assert (first.date_id, first.day_of_week, first.day_name, first.is_weekend, first.week, first.quarter) == (1, 6, "Sunday", 1, 52, 1)
    assert build_dim_date(spark, dt.date(2024, 1, 2), dt.date(2024, 1, 1)).count() == 0


def landed_sales(spark):
    return spark.createDataFrame(
        [("1", "1", "1", "1", "1", " 2 ", "9.99", "0.10", "5.00"),
         ("2", "1", "1", "1", "1", "x", "9.99", "0.10", "5.00"),
         ("k", "1", "1", "1", "1", "2", "", "0.10", "5.00")],
        "sale_id string, customer_id string, product_id string, date_id string, channel_id string, quantity string, "
        "unit_price string, discount string, profit string")


def test_bad_rows_go_to_quarantine(spark):
    good, bad = cleaning.split(cleaning.sales(landed_sales(spark)))
    assert rows(good, "sale_id", "quantity", "total_amount", "profit") == [(1, 2, Decimal("17.98"), Decimal("5.00"))]
    assert sorted(r.problem for r in bad.collect()) == ["quantity", "sale_id,unit_price"]


def test_strict_mode_fails_on_the_first_bad_row(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cleaning.split(cleaning.sales(landed_sales(spark), strict=True))[0].collect()


def test_customers(spark):
    df = spark.createDataFrame(
        [("1", "\tjohn ", "o'neil", " A@B.Com ", "united states", " new york", "25-34", "2024-01-31")],
        "customer_id string, first_name string, last_name string, email string, country string, city string, "
        "age_group string, signup_date string")
    got = cleaning.split(cleaning.customers(df))[0].first()
    assert tuple(got) == (1, "John", "O'Neil", "a@b.com", "United States", "New York", "25-34", dt.date(2024, 1, 31))


def test_amounts_are_rounded_once(spark):
    landed = spark.createDataFrame(
        [("1", "1", "1", "1", "1", "8", "100.00", "0.125", "1"), ("2", "1", "1", "1", "1", "3", "10.005", "0", "1")],
        "sale_id string, customer_id string, product_id string, date_id string, channel_id string, quantity string, unit_price string, "
        "discount string, profit string")
    good, bad = cleaning.split(cleaning.sales(landed))
    assert rows(good, "sale_id", "total_amount") == [(1, Decimal("700.00")), (2, Decimal("30.02"))] and bad.count() == 0


def test_a_customer_without_a_date_stays(spark):
    landed = spark.createDataFrame(
        [("1", "a", "b", "E@X", "c", "d", "e", "no date"), ("x", "a", "b", "c", "c", "d", "e", "2024-01-01")],
        "customer_id string, first_name string, last_name string, email string, country string, city string, age_group string, signup_date string")
    good, bad = cleaning.split(cleaning.customers(landed))
    assert rows(good, "customer_id", "signup_date") == [(1, None)] and rows(bad, "problem") == [("customer_id",)]
