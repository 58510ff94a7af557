import json
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from martwright.operators import quality as q
from martwright.plans import audit
from martwright.sources import schemas, star
from martwright.sources import tables as store


def one(df):
    assert df.count() == 1
    return df.first()


@pytest.mark.parametrize("missing, status, severity", [(0, "PASS", "INFO"), (4, "WARN", "MEDIUM"), (5, "FAIL", "HIGH")])
def test_completeness_bands(spark, missing, status, severity):
    df = spark.range(100).select(
        F.when(F.col("id") < missing, F.when(F.col("id") % 2 == 0, "")).otherwise("x").alias("name"),
        F.when(F.col("id") >= missing, F.col("id")).alias("n"))
    for check in q.completeness(df, "t", ["name", "n"]).collect():
        assert (check.status, check.severity) == (status, severity)
        assert check.details == f"{missing}/100 nulls ({float(missing)}%)"


def test_completeness_of_an_empty_table(spark):
    assert one(q.completeness(spark.createDataFrame([], "a string"), "t", ["a"])).details == "0/0 nulls (0.0%)"


def test_uniqueness_ignores_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    check = one(q.uniqueness(df, "t", "k"))
    assert (check.status, check.severity, check.details) == ("FAIL", "HIGH", "1 duplicates found")
    assert one(q.uniqueness(df.distinct(), "t", "k")).status == "PASS"


def test_orphans_count_rows_and_null_keys(spark):
    child = spark.createDataFrame([(1,), (1,), (9,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    check = one(q.referential_integrity(child, "c", "k", parent, "p", "id"))
    assert (check.status, check.severity, check.details) == ("FAIL", "CRITICAL", "3 orphan records")


def test_zscore(spark):
    df = spark.createDataFrame([(10,)] * 50 + [(1000,)], "v int")
    check = one(q.zscore_outliers(df, "v", "z"))
    assert (check.status, check.severity) == ("WARN", "MEDIUM") and check.details.startswith("1 outliers (mean=29s")
    flat = one(q.zscore_outliers(spark.createDataFrame([(5,)] * 4, "v int"), "v", "z"))
    assert (flat.status, flat.details) == ("PASS", "0 outliers (mean=5s, std=0s)")
    assert one(q.zscore_outliers(spark.createDataFrame([], "v int"), "v", "z")).status == "SKIPPED"


def test_concentration(spark):
    even = spark.createDataFrame([(1, Decimal(10))] * 5, "k int, amount decimal(18,2)")
    assert one(q.hhi(even, "amount", "h")).details == "HHI=2000 (>2500=concentrated, <1500=diverse)"
    assert one(q.hhi(even.limit(4), "amount", "h")).status == "WARN"  # exactly 2500
    assert one(q.hhi(even.withColumn("amount", F.lit(0).cast("decimal(18,2)")), "amount", "h")).status == "PASS"
    sizes = spark.createDataFrame([(50,), (150,)], "n int")
    assert (one(q.group_cv(sizes, "n", "c")).status, one(q.group_cv(sizes, "n", "c")).details) == ("WARN", "CV=50.0% across 2 categories")


def test_benford(spark):
    spread = [d * 10**e for d, n in zip(range(1, 10), (301, 176, 125, 97, 79, 67, 58, 51, 46)) for e in (1,) for _ in range(n)]
    df = spark.createDataFrame([(Decimal(v),) for v in spread], "v decimal(18,2)")
    assert one(q.benford(df, "v", "b")).status == "PASS"
    ones = spark.createDataFrame([(Decimal(1),)] * 9 + [(Decimal(-5),)], "v decimal(18,2)")
    assert one(q.benford(ones, "v", "b")).details == "Max digit deviation=0.6990 (threshold=0.05)"
    assert one(q.benford(ones.filter("v < 0"), "v", "b")).status == "SKIPPED"


def test_rules_and_emails(spark):
    df = spark.createDataFrame([("a@b.co",), ("no-at",), ("x@y",), (None,)], "email string")
    assert one(q.contains_at(df, "t")).details == "1 addresses without @"
    assert one(q.emails_valid(df, "t")).details == "3 malformed addresses"
    assert one(q.row_count_equals(df, "t", 4)).status == "PASS" and one(q.row_count_equals(df, "t", 5)).status == "FAIL"


def test_schema_drift():
    want = StructType([StructField("a", IntegerType()), StructField("b", StringType())])
    have = StructType([StructField("a", LongType()), StructField("c", StringType())])
    assert q.schema_drift(want, have) == [("b", "missing"), ("c", "unexpected"), ("a", "int became bigint")]
    assert q.schema_drift(want, want) == []


def test_distribution_drift(spark):
    a = spark.createDataFrame([("x",)] * 5 + [("y",)] * 5, "k string")
    b = spark.createDataFrame([("x",)] * 9 + [("z",)] * 1, "k string")
    assert all(r.psi == 0 for r in q.distribution_drift(a, a, "k").collect())
    got = {r.category: (r.n_before, r.n_after) for r in q.distribution_drift(a, b, "k").collect()}
    assert got == {"x": (5, 9), "y": (5, 0), "z": (0, 1)}


@pytest.fixture
def tables(spark):
    def table(name, data):
        text = ", ".join(f"{c} string" for c in schemas.names(schemas.STAR[name]))
        raw = spark.createDataFrame(data, text) if data else spark.createDataFrame([], text)
        types = spark.createDataFrame([], schemas.STAR[name]).schema
        return raw.select(*[F.col(f.name).cast(f.dataType) for f in types.fields])

    return {
        "dim_customers": table("dim_customers", [("1", "A", "B", "a@x.org", "FR", "Paris", "18-24", "2024-01-01"),
                                                 ("2", "C", "D", "a@x.org", "DE", "", "18-24", "2024-01-02")]),
        "dim_products": table("dim_products", [("1", "lamp", "home", "light", "10", "4"), ("2", "rug", "home", "floor", "5", "5")]),
        "dim_date": table("dim_date", [(str(i), f"2024-01-0{i}", "2024", "1", "1", "January", "1", str(i - 1), "d", "0") for i in range(1, 5)]),
        "dim_channels": table("dim_channels", [("1", "Web", "Online")]),
        "fact_sales": table("fact_sales", [("1", "1", "1", "1", "1", "2", "10", "0", "20", "12"),
                                           ("2", "7", "1", "2", "1", "0", "10", "0", "-1", "0"),
                                           ("2", "2", "2", "3", "1", "1", "5", "0", "5", "0")]),
        "fact_user_activity": table("fact_user_activity", [("1", "1", "1", "1", "30", "5", "0", "1"), ("2", "2", "1", "9", "60", "2", "1", "0")]),
    }


def test_audit_finds_every_injected_defect(tables):
    checks = {r.check: r for r in audit.audit(tables).collect()}
    assert len(checks) == 44
    bad = {name: (r.status, r.details) for name, r in checks.items() if r.status in ("WARN", "FAIL")}
    assert bad["dim_customers.city null check"] == ("FAIL", "1/2 nulls (50.0%)")
    assert bad["dim_customers.email uniqueness"] == ("FAIL", "1 duplicates found")
    assert bad["fact_sales.sale_id uniqueness"] == ("FAIL", "1 duplicates found")
    assert bad["fact_sales.customer_id -> dim_customers.customer_id"] == ("FAIL", "1 orphan records")
    assert bad["fact_user_activity.channel_id -> dim_channels.channel_id"] == ("FAIL", "1 orphan records")
    assert bad["No negative sale amounts"][0] == "FAIL" and bad["Positive sale quantities"][0] == "FAIL"
    assert bad["Product margin validation (cost < price)"] == ("WARN", "1 products with cost >= price")
    assert bad["Bounce sessions page view check (<= 3)"][0] == "WARN"
    assert bad["Sales date coverage"] == ("WARN", "3/4 dates covered (75.0%)")
    assert checks["Weekend sales ratio"].details == "0.0% of sales on weekends (expected ~28.6%)"


def test_report_round_trip(spark, tables, tmp_path):
    store.write_json_report(audit.report(tables, "2024-01-01T00:00:00"), f"{tmp_path}/reports/quality_report_1")
    store.write_json_report(audit.report(tables, "2024-01-02T00:00:00"), f"{tmp_path}/reports/quality_report_2")
    latest = store.read_quality_reports(spark, f"{tmp_path}/reports/*").first()
    assert latest.audit_timestamp == "2024-01-02T00:00:00" and latest.total_checks == len(latest.checks) == 44
    assert latest.passed + latest.warnings + latest.failures == 44
    assert latest.profiles["fact_sales.quantity"]["median"] == 1.0 and len(latest.profiles) == 6
    text = next((tmp_path / "reports" / "quality_report_1").glob("*.json")).read_text()
    assert json.loads(text)["checks"][0]["timestamp"] == "2024-01-01T00:00:00"


def test_validation_only_asks_for_a_figure(tables):
    got = {r.check: (r.value, r.status) for r in audit.post_load_validate(tables).collect()}
    assert got["Orphan sales (should be 0)"] == (1.0, "PASS")
    empty = {**tables, "fact_sales": tables["fact_sales"].limit(0)}
    got = {r.check: (r.value, r.status) for r in audit.post_load_validate(empty).collect()}
    assert got["Total revenue"] == (None, "WARN") and got["Sales count"] == (0.0, "PASS")


def test_summary(spark):
    checks = spark.createDataFrame([("a", "PASS"), ("a", "WARN"), ("b", "PASS")], "category string, status string")
    assert tuple(q.audit_summary(checks).first()) == (3, 2, 1, 0, 66.7)
    assert rows(q.checks_by_category(checks)) == [("a", 2), ("b", 1)]


def test_an_audit_reads_each_fact_few_times(spark):
    """Rules share scans: figures, keys and repeats are one read each; the quartiles take three of one column."""
    tables, reads = star.Star(spark, "/root/testdata/sf0.001").tables(), []

    def counted(table, source):
        def read(*columns):
            reads.append(table)
            return source(*columns) if callable(source) else source.select(*columns)
        return read

    checks = audit.audit({t: counted(t, source) for t, source in tables.items()})
    assert checks.count() == 44
    # Completeness is picked once more for its types only.
    assert reads.count("fact_sales") <= 5 and reads.count("fact_user_activity") <= 5
