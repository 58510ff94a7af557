"""The warehouse audit: which rules run over which tables."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.functions.numeric import half_up, ratio
from martwright.operators import quality as q
from martwright.session import cut
from martwright.sources.tables import pick

# The columns, keys and measures that the audit covers.
COMPLETE = {
    "dim_customers": ["first_name", "last_name", "email", "country", "city", "age_group"],
    "dim_products": ["product_name", "category", "subcategory", "unit_price", "cost_price"],
    "fact_sales": ["customer_id", "product_id", "date_id", "quantity", "total_amount", "profit"],
    "fact_user_activity": ["customer_id", "date_id", "session_duration_sec", "pages_viewed"],
}
UNIQUE = [
    ("dim_customers", "customer_id"),
    ("dim_customers", "email"),
    ("dim_products", "product_id"),
    ("fact_sales", "sale_id"),
    ("fact_user_activity", "activity_id"),
]
FOREIGN_KEYS = [
    ("fact_sales", "customer_id", "dim_customers"),
    ("fact_sales", "product_id", "dim_products"),
    ("fact_sales", "date_id", "dim_date"),
    ("fact_sales", "channel_id", "dim_channels"),
    ("fact_user_activity", "customer_id", "dim_customers"),
    ("fact_user_activity", "date_id", "dim_date"),
    ("fact_user_activity", "channel_id", "dim_channels"),
]
MEASURES = {
    "fact_sales": ["total_amount", "quantity", "profit", "discount"],
    "fact_user_activity": ["session_duration_sec", "pages_viewed"],
}
BENFORD = "Benford's Law compliance (sales amounts)"

# The rules on rows, by table: name, severity of a breach, outcome and wording.
RULES = {
    "fact_sales": [
        ("No negative sale amounts", None, "FAIL", "negative sales found"),
        ("Positive sale quantities", None, "FAIL", "zero/negative quantities"),
    ],
    "dim_products": [("Product margin validation (cost < price)", None, "WARN", "products with cost >= price")],
    "fact_user_activity": [
        ("Bounce sessions page view check (<= 3)", "MEDIUM", "WARN", "bounce sessions with >3 pages")],
}

Tables = Mapping[str, DataFrame]


def _broken() -> dict[str, tuple[list[str], list[Column]]]:
    """By table: the columns that its rules read, and what breaks each rule."""
    return {
        "fact_sales": (["total_amount", "quantity"], [F.col("total_amount") < 0, F.col("quantity") <= 0]),
        "dim_products": (["unit_price", "cost_price"], [F.col("cost_price") >= F.col("unit_price")]),
        "fact_user_activity": (["bounce", "pages_viewed"], [(F.col("bounce") == 1) & (F.col("pages_viewed") > 3)]),
    }


def _all(checks) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


class Shared:
    """What the families of one audit have in common, each worked out once and written.

    `figures` has one row per table with the sums that all families ask for, from one scan. `keys` has
    the rows (and amounts) per value of every foreign key of a table, from one more.
    """

    def __init__(self, tables: Tables, families: Collection[str]):
        self.tables, self.families = tables, set(families)
        self._figures: dict[str, DataFrame] = {}
        self._keys: dict[str, DataFrame] = {}

    def figures(self, table: str) -> DataFrame:
        if table not in self._figures:
            columns: list[str] = []
            wanted: dict[str, Column] = {}
            if "completeness" in self.families and table in COMPLETE:
                columns += COMPLETE[table]
                wanted |= q.completeness_figures(pick(self.tables, table, *COMPLETE[table]), COMPLETE[table])
            if "distribution" in self.families and table == "fact_sales":
                columns.append("total_amount")
                wanted |= q.benford_figures("_digit")
            if "outliers" in self.families and table == "fact_user_activity":
                columns.append("session_duration_sec")
                wanted |= q.zscore_figures("session_duration_sec")
            if "business_rules" in self.families and table in RULES:
                read, broken = _broken()[table]
                columns += read
                wanted |= {f"broken_{i}": F.count_if(violation) for i, violation in enumerate(broken)}
            rows = pick(self.tables, table, *dict.fromkeys(columns))
            if "digits" in wanted:
                rows = rows.withColumn("_digit", q.leading_digit("total_amount"))
            self._figures[table] = cut(q.figures_of(rows, wanted))
        return self._figures[table]

    def keys(self, table: str, key: str) -> DataFrame:
        """(id, n, amount) of one foreign key; the amount only where the table has sales."""
        if table not in self._keys:
            names = [k for child, k, _ in FOREIGN_KEYS if child == table]
            amount = ["total_amount"] if table == "fact_sales" and self.families & {"distribution"} else []
            cells = pick(self.tables, table, *names, *amount).select(
                *[F.col(k).cast("bigint").alias(k) for k in names], *amount).unpivot(amount, names, "key", "id")
            sums = [F.sum(a).alias("amount") for a in amount]
            self._keys[table] = cut(cells.groupBy("key", "id").agg(F.count("*").alias("n"), *sums))
        return self._keys[table].filter(F.col("key") == key).drop("key")


def _completeness(shared: Shared) -> list[DataFrame]:
    return [q.completeness_checks(shared.figures(t), t, columns) for t, columns in COMPLETE.items()]


def _uniqueness(shared: Shared) -> list[DataFrame]:
    return [q.uniqueness(pick(shared.tables, t, c), t, c) for t, c in UNIQUE]


def _referential_integrity(shared: Shared) -> list[DataFrame]:
    return [
        q.references(shared.keys(child, key), child, key, pick(shared.tables, parent, key), parent, key)
        for child, key, parent in FOREIGN_KEYS]


def _outliers(shared: Shared) -> list[DataFrame]:
    sessions = pick(shared.tables, "fact_user_activity", "session_duration_sec")
    return [
        q.iqr_outliers(pick(shared.tables, "fact_sales", "total_amount"), "total_amount", "Sales amount IQR outliers"),
        q.zscore_outliers(sessions, "session_duration_sec", "Session duration Z-score outliers (|z|>3)",
                          figures=shared.figures("fact_user_activity")),
    ]


def _category_cv(tables: Tables, by_product: DataFrame) -> DataFrame:
    products = pick(tables, "dim_products", "product_id", "category")
    sizes = by_product.join(products, F.col("id") == F.col("product_id")).groupBy("category").agg(F.sum("n").alias("n"))
    return q.group_cv(sizes, "n", "Category sales distribution (CV)")


def _hhi(tables: Tables, by_customer: DataFrame) -> DataFrame:
    customers = pick(tables, "dim_customers", "customer_id", "country")
    spent = by_customer.join(customers, F.col("id") == F.col("customer_id")).groupBy("country").agg(F.sum("amount").alias("amount"))
    return q.hhi(spent, "amount", "Revenue concentration (HHI index)")


def _distribution(shared: Shared) -> list[DataFrame]:
    return [
        _category_cv(shared.tables, shared.keys("fact_sales", "product_id")),
        _hhi(shared.tables, shared.keys("fact_sales", "customer_id")),
        q.benford_check(shared.figures("fact_sales"), BENFORD),
    ]


def _temporal(shared: Shared) -> list[DataFrame]:
    sold = shared.keys("fact_sales", "date_id")
    return [
        q.date_coverage(sold, pick(shared.tables, "dim_date", "date_id", "full_date")),
        q.weekend_ratio(sold, pick(shared.tables, "dim_date", "date_id", "is_weekend")),
    ]


def _business_rules(shared: Shared) -> list[DataFrame]:
    return [
        q.rule_check(shared.figures(table), f"broken_{i}", name, on_fail, details, severity)
        for table, rules in RULES.items() for i, (name, severity, on_fail, details) in enumerate(rules)]


FAMILIES = {
    "completeness": _completeness,
    "uniqueness": _uniqueness,
    "referential_integrity": _referential_integrity,
    "outliers": _outliers,
    "distribution": _distribution,
    "temporal": _temporal,
    "business_rules": _business_rules,
}


def audit(tables: Tables, families: Collection[str] = tuple(FAMILIES)) -> DataFrame:
    """All checks of the named families, in their order."""
    shared = Shared(tables, families)
    return _all(check for name in FAMILIES if name in families for check in FAMILIES[name](shared))


def completeness(tables: Tables) -> DataFrame:
    return audit(tables, ["completeness"])


def uniqueness(tables: Tables) -> DataFrame:
    return audit(tables, ["uniqueness"])


def referential_integrity(tables: Tables) -> DataFrame:
    return audit(tables, ["referential_integrity"])


def outliers(tables: Tables) -> DataFrame:
    return audit(tables, ["outliers"])


def business_rules(tables: Tables) -> DataFrame:
    return audit(tables, ["business_rules"])


def category_cv(tables: Tables) -> DataFrame:
    return _category_cv(tables, q.rows_by_key(pick(tables, "fact_sales", "product_id"), "product_id"))


def hhi_concentration(tables: Tables) -> DataFrame:
    spent = pick(tables, "fact_sales", "customer_id", "total_amount").groupBy(F.col("customer_id").alias("id"))
    return _hhi(tables, spent.agg(F.sum("total_amount").alias("amount")))


def benford(tables: Tables) -> DataFrame:
    return q.benford(pick(tables, "fact_sales", "total_amount"), "total_amount", BENFORD)


def date_coverage(tables: Tables) -> DataFrame:
    sold = q.rows_by_key(pick(tables, "fact_sales", "date_id"), "date_id")
    return q.date_coverage(sold, pick(tables, "dim_date", "date_id", "full_date"))


def weekend_ratio(tables: Tables) -> DataFrame:
    sold = q.rows_by_key(pick(tables, "fact_sales", "date_id"), "date_id")
    return q.weekend_ratio(sold, pick(tables, "dim_date", "date_id", "is_weekend"))


def profiles(tables: Tables) -> DataFrame:
    return _all(q.profile_numeric(pick(tables, t, *columns), t, columns) for t, columns in MEASURES.items())


def post_load_validate(tables: Tables) -> DataFrame:
    """Counts and totals after a load; a figure passes when there is one at all."""
    customer_ids = pick(tables, "dim_customers", "customer_id")
    rows = F.count("*")
    of_sales = pick(tables, "fact_sales", "total_amount", "profit").agg(
        rows.alias("sales"), F.sum("total_amount").alias("revenue"), F.sum("profit").alias("profit"))
    of_activity = pick(tables, "fact_user_activity", "session_duration_sec").agg(
        rows.alias("activities"),
        half_up(ratio(F.sum("session_duration_sec"), F.count("session_duration_sec")), 0).alias("duration"))
    figures = {
        "Customers count": customer_ids.agg(rows).scalar(),
        "Products count": pick(tables, "dim_products", "product_id").agg(rows).scalar(),
        "Sales count": F.col("sales"),
        "Activities count": of_activity.select("activities").scalar(),
        "Total revenue": F.col("revenue"),
        "Total profit": F.col("profit"),
        "Orphan sales (should be 0)":
            q.orphans(q.rows_by_key(pick(tables, "fact_sales", "customer_id"), "customer_id"), customer_ids, "customer_id").scalar(),
        "Avg session duration": of_activity.select("duration").scalar(),
    }
    listed = F.array(*[
        F.struct(F.lit(name).alias("check"), value.cast("double").alias("value")) for name, value in figures.items()])
    return of_sales.select(F.inline(listed)).withColumn("status", F.when(F.col("value").isNull(), "WARN").otherwise("PASS"))


def report(tables: Tables, at: str) -> DataFrame:
    """One row with the whole audit: totals, checks and profiles, ready for a JSON sink.

    The nested lists hold one entry per rule and per profiled column.
    """
    checks = audit(tables).withColumn("timestamp", F.lit(at))
    listed = checks.agg(
        F.lit(at).alias("audit_timestamp"),
        F.count("*").alias("total_checks"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "WARN").alias("warnings"),
        F.count_if(F.col("status") == "FAIL").alias("failures"),
        F.collect_list(F.struct("timestamp", *q.CHECK)).alias("checks"))
    stats = ["count", "min", "max", "mean", "median", "std", "total", "skewness"]
    described = profiles(tables).agg(F.map_from_entries(F.collect_list(F.struct("column", F.struct(*stats)))))
    return listed.withColumn("profiles", described.scalar())
