"""Data-quality rules as DataFrames of check rows.

Every rule returns (category, check, status, severity, details). A rule that rests on sums over a table
comes in two parts, the aggregates (`..._figures`) and the check on their row, so that an audit works out
the figures of all rules in one scan. Rules on a key take the rows per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from martwright.functions.numeric import first_digit, half_up, percent, ratio
from martwright.functions.text import blank
from martwright.operators.quantiles import MEDIAN, QUARTILES, describe

CHECK = ["category", "check", "status", "severity", "details"]


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _check(category: str, name: Column | str, status: Column, severity: Column | str, details: Column) -> list[Column]:
    as_column = lambda v: F.lit(v) if isinstance(v, str) else v
    return [
        F.lit(category).alias("category"), as_column(name).alias("check"), status.alias("status"),
        as_column(severity).alias("severity"), details.alias("details"),
    ]


def _fixed(value: Column, places: int) -> Column:
    """Text with a fixed number of digits, rounded half up."""
    return F.format_string(f"%.{places}f", half_up(value, places))


def completeness_figures(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """Aggregates that `completeness_checks` needs, to be worked out with those of other rules."""
    text = {c for c in columns if isinstance(df.schema[c].dataType, StringType)}
    missing = {f"missing_{c}": F.count_if(blank(c) if c in text else F.col(c).isNull()) for c in columns}
    return {"rows": F.count("*"), **missing}


def completeness_checks(figures: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    listed = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"missing_{c}").alias("missing")) for c in columns])
    cells = figures.select("rows", F.inline(listed))
    pct = F.coalesce(percent("missing", "rows", 2), F.lit(0.0))
    status = F.when(pct == 0, "PASS").when(pct < 5, "WARN").otherwise("FAIL")
    severity = F.when(pct == 0, "INFO").when(pct < 5, "MEDIUM").otherwise("HIGH")
    return cells.select(*_check(
        "Completeness", _text(f"{table}.", F.col("column"), " null check"), status, severity,
        _text(F.col("missing"), "/", F.col("rows"), " nulls (", pct, "%)")))


def completeness(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """NULL or blank share per column: none passes, below 5 % warns."""
    return completeness_checks(figures_of(df, completeness_figures(df, columns)), table, columns)


def figures_of(df: DataFrame, figures: dict[str, Column]) -> DataFrame:
    """One row with the named aggregates."""
    return df.agg(*[value.alias(name) for name, value in figures.items()])


def uniqueness(df: DataFrame, table: str, column: str) -> DataFrame:
    """Repeats of a column's non-NULL values."""
    repeats = F.count(column) - F.countDistinct(column)
    found = df.agg(repeats.alias("n"))
    return found.select(*_check(
        "Uniqueness", f"{table}.{column} uniqueness", F.when(F.col("n") == 0, "PASS").otherwise("FAIL"),
        F.when(F.col("n") > 0, "HIGH").otherwise("INFO"), _text(F.col("n"), " duplicates found")))


def rows_by_key(child: DataFrame, key: str) -> DataFrame:
    """(id, n): rows per value of a key, so that a key with a third of all rows goes on as one row."""
    return child.groupBy(F.col(key).alias("id")).agg(F.count("*").alias("n"))


def orphans(keys: DataFrame, parent: DataFrame, parent_key: str) -> DataFrame:
    """Number of child rows without a parent, as `n`, from the rows per key. A NULL key has no parent."""
    lost = keys.select("id", "n").join(parent.select(F.col(parent_key).alias("id")), "id", "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def referential_integrity(child: DataFrame, child_table: str, child_key: str,
                          parent: DataFrame, parent_table: str, parent_key: str) -> DataFrame:
    return references(rows_by_key(child, child_key), child_table, child_key, parent, parent_table, parent_key)


def references(keys: DataFrame, child_table: str, child_key: str,
               parent: DataFrame, parent_table: str, parent_key: str) -> DataFrame:
    """The check of `referential_integrity` from the rows per key."""
    return orphans(keys, parent, parent_key).select(*_check(
        "Referential Integrity", f"{child_table}.{child_key} -> {parent_table}.{parent_key}",
        F.when(F.col("n") == 0, "PASS").otherwise("FAIL"),
        F.when(F.col("n") > 0, "CRITICAL").otherwise("INFO"), _text(F.col("n"), " orphan records")))


def _valid(df: DataFrame, column: str) -> Column:
    """A number as a double without NaN."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def iqr_bounds(df: DataFrame, column: str, k: float = 1.5) -> DataFrame:
    """One row: rows, quartiles v[n/4] and v[3n/4], fences and the number of values beyond them."""
    quartiles = describe(df, {column: (F.col(column), QUARTILES)})[column].at
    q1, q3 = (F.lit(float(quartiles[q].value) if quartiles else None).cast("double") for q in ("q1", "q3"))
    low, high = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
    value = _valid(df, column)
    return df.agg(
        F.count(value).alias("rows"),
        q1.alias("q1"), q3.alias("q3"), low.alias("lower_bound"), high.alias("upper_bound"),
        F.count_if((value < low) | (value > high)).alias("outliers"))


def iqr_outliers(df: DataFrame, column: str, name: str, k: float = 1.5) -> DataFrame:
    """Values outside the quartile fences; an empty column is skipped."""
    pct = percent("outliers", "rows", 2)
    status = F.when(F.col("rows") == 0, "SKIPPED").when(pct > 5, "WARN").otherwise("PASS")
    details = _text(
        F.col("outliers"), " outliers (", pct, "%), bounds=[", _fixed(F.col("lower_bound"), 2), ", ",
        _fixed(F.col("upper_bound"), 2), "]")
    return iqr_bounds(df, column, k).select(*_check(
        "Outliers", name, status, F.when(pct > 5, "MEDIUM").otherwise("INFO"), F.coalesce(details, F.lit("no rows"))))


def zscore_figures(column: str) -> dict[str, Column]:
    value = F.col(column).cast("double")
    return {"known": F.count(value), "mean": F.avg(value), "std": F.stddev_pop(value)}


def zscore_outliers(df: DataFrame, column: str, name: str, z: float = 3.0, figures: DataFrame | None = None) -> DataFrame:
    """Values more than `z` population deviations from the mean; a constant column has none."""
    value = F.col(column).cast("double")
    stats = figures if figures is not None else figures_of(df, zscore_figures(column))
    mean, std = (stats.select(c).scalar() for c in ("mean", "std"))
    beyond = F.count_if(F.abs(ratio(value - mean, F.nullif(std, F.lit(0.0)))) > z)
    found = df.agg(F.count(value).alias("rows"), mean.alias("mean"), std.alias("std"), beyond.alias("outliers"))
    status = F.when(F.col("rows") == 0, "SKIPPED").when(F.col("outliers") > F.col("rows") * 0.01, "WARN").otherwise("PASS")
    details = _text(F.col("outliers"), " outliers (mean=", _fixed(F.col("mean"), 0), "s, std=", _fixed(F.col("std"), 0), "s)")
    return found.select(*_check("Outliers", name, status, "MEDIUM", F.coalesce(details, F.lit("no rows"))))


def group_cv(sizes: DataFrame, size: str, name: str) -> DataFrame:
    """Coefficient of variation of group sizes, below 50 % passes."""
    found = sizes.agg(
        F.count("*").alias("groups"), F.coalesce(ratio(F.stddev_pop(size), F.avg(size)) * 100.0, F.lit(0.0)).alias("cv"))
    return found.select(*_check(
        "Distribution", name, F.when(F.col("cv") < 50, "PASS").otherwise("WARN"), "MEDIUM",
        _text("CV=", _fixed(F.col("cv"), 1), "% across ", F.col("groups"), " categories")))


def hhi(shares: DataFrame, amount: str, name: str) -> DataFrame:
    """Herfindahl index of group amounts, below 2500 passes."""
    value = F.col(amount).cast("double")
    whole = shares.agg(F.sum(amount).cast("double")).scalar()
    index = F.sum(F.pow(ratio(value, whole), F.lit(2.0))) * 10000.0
    found = shares.agg(F.coalesce(F.when(whole > 0, index), F.lit(0.0)).alias("hhi"))
    return found.select(*_check(
        "Distribution", name, F.when(F.col("hhi") < 2500, "PASS").otherwise("WARN"), "INFO",
        _text("HHI=", _fixed(F.col("hhi"), 0), " (>2500=concentrated, <1500=diverse)")))


def leading_digit(column: str) -> Column:
    """First digit of a positive value."""
    return F.when(F.col(column) > 0, first_digit(column))


def benford_figures(digit: str) -> dict[str, Column]:
    """Counts of a column with `leading_digit`, which is worked out once for all nine of them."""
    return {"digits": F.count(digit), **{f"digit_{d}": F.count_if(F.col(digit) == d) for d in range(1, 10)}}


def benford_check(figures: DataFrame, name: str) -> DataFrame:
    gaps = [F.abs(ratio(f"digit_{d}", "digits") - F.log10(F.lit(1 + 1 / d))) for d in range(1, 10)]
    found = figures.select("digits", F.greatest(*gaps).alias("gap"))
    status = F.when(F.col("digits") == 0, "SKIPPED").when(F.col("gap") < 0.05, "PASS").otherwise("WARN")
    details = _text("Max digit deviation=", _fixed(F.col("gap"), 4), " (threshold=0.05)")
    return found.select(*_check("Distribution", name, status, "INFO", F.coalesce(details, F.lit("no rows"))))


def benford(df: DataFrame, column: str, name: str) -> DataFrame:
    """Largest gap between the first-digit shares of positive values and log10(1 + 1/d)."""
    return benford_check(figures_of(df.select(leading_digit(column).alias("digit")), benford_figures("digit")), name)


def date_coverage(sold: DataFrame, dates: DataFrame, name: str = "Sales date coverage") -> DataFrame:
    """Share of calendar days with sales, above 90 % passes; `sold` has the rows per date id."""
    covered = sold.join(dates, F.col("id") == F.col("date_id")).agg(F.countDistinct("full_date").alias("covered"))
    found = covered.withColumn("days", dates.agg(F.count("*")).scalar())
    pct = percent("covered", "days")
    return found.select(*_check(
        "Temporal", name, F.when(pct > 90, "PASS").otherwise("WARN"), "MEDIUM",
        _text(F.col("covered"), "/", F.col("days"), " dates covered (", F.coalesce(pct, F.lit(0.0)), "%)")))


def weekend_ratio(sold: DataFrame, dates: DataFrame, name: str = "Weekend sales ratio") -> DataFrame:
    """Share of rows on weekends; `sold` has the rows per date id."""
    by_date = sold.join(dates.select("date_id", "is_weekend"), F.col("id") == F.col("date_id"))
    pct = percent(F.sum(F.when(F.col("is_weekend") == 1, F.col("n")).otherwise(0)), F.sum("n"))
    return by_date.agg(pct.alias("pct")).select(*_check(
        "Temporal", name, F.lit("PASS"), "INFO",
        _text(F.coalesce(F.col("pct").cast("string"), F.lit("no")), "% of sales on weekends (expected ~28.6%)")))


def rule(df: DataFrame, name: str, violation: Column, on_fail: str, details: str,
         severity: str | None = None, category: str = "Business Rules") -> DataFrame:
    """Rows that break a rule. Without a fixed `severity` a breach is HIGH and none is INFO."""
    return rule_check(df.agg(F.count_if(violation).alias("n")), "n", name, on_fail, details, severity, category)


def rule_check(figures: DataFrame, broken: str, name: str, on_fail: str, details: str,
               severity: str | None = None, category: str = "Business Rules") -> DataFrame:
    """The check of `rule` from a column with the number of rows that break it."""
    n = F.col(broken)
    level = severity or F.when(n > 0, "HIGH").otherwise("INFO")
    return figures.select(*_check(category, name, F.when(n == 0, "PASS").otherwise(on_fail), level, _text(n, f" {details}")))


def emails_valid(df: DataFrame, table: str, column: str = "email") -> DataFrame:
    """Addresses that lack a name, an @ or a domain with a dot."""
    bad = ~F.coalesce(F.col(column).rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$"), F.lit(False))
    return rule(df, f"{table}.{column} address format", bad, "FAIL", "malformed addresses")


def contains_at(df: DataFrame, table: str, column: str = "email") -> DataFrame:
    return rule(df, f"{table}.{column} contains @", ~F.col(column).like("%@%"), "FAIL", "addresses without @")


def row_count_equals(df: DataFrame, table: str, expected: int) -> DataFrame:
    found = df.agg(F.count("*").alias("n"))
    return found.select(*_check(
        "Row Count", f"{table} has {expected} rows", F.when(F.col("n") == expected, "PASS").otherwise("FAIL"),
        F.when(F.col("n") == expected, "INFO").otherwise("HIGH"), _text(F.col("n"), " rows")))


def profile_numeric(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Count, range, mean, median, deviation, total and skewness per column.

    Deviation and skewness are taken about the mean rounded to 2 digits. A column without values has
    count 0 and no figures.
    """
    known = describe(df, {c: (F.col(c), MEDIAN) for c in columns})
    number = lambda v: F.lit(None if v is None else float(v)).cast("double")

    def figures(column: str) -> Column:
        of = known[column]
        middle = [of.at[m].value if of.at else None for m in MEDIAN]
        count, mean = F.lit(of.count).cast("bigint"), half_up(ratio(number(of.total), F.lit(of.count)), 2)
        distance = _valid(df, column) - mean
        std = F.sqrt(ratio(F.sum(F.pow(distance, F.lit(2.0))), count))
        third = ratio(F.sum(F.pow(distance, F.lit(3.0))), count)
        skewness = half_up(ratio(third, F.pow(F.nullif(std, F.lit(0.0)), F.lit(3.0))), 3)
        return F.struct(
            F.lit(f"{table}.{column}").alias("column"),
            count.alias("count"),
            half_up(number(of.min)).alias("min"),
            half_up(number(of.max)).alias("max"),
            mean.alias("mean"),
            half_up((number(middle[0]) + number(middle[1])) / 2).alias("median"),
            half_up(std).alias("std"),
            half_up(number(of.total)).alias("total"),
            F.when(count > 0, F.coalesce(skewness, F.lit(0.0))).alias("skewness"),
        )

    return df.agg(F.array(*[figures(c) for c in columns]).alias("listed")).select(F.inline("listed"))


def checks_by_category(checks: DataFrame) -> DataFrame:
    return checks.groupBy("category").agg(F.count("*").alias("checks"))


def audit_summary(checks: DataFrame) -> DataFrame:
    """Totals by status and the share of passed checks."""
    passed = F.count_if(F.col("status") == "PASS")
    return checks.agg(
        F.count("*").alias("total_checks"),
        passed.alias("passed"),
        F.count_if(F.col("status") == "WARN").alias("warnings"),
        F.count_if(F.col("status") == "FAIL").alias("failures"),
        F.coalesce(percent(passed, F.count("*")), F.lit(0.0)).alias("score"),
    )


def schema_drift(expected: StructType, actual: StructType) -> list[tuple[str, str]]:
    """(column, problem) for columns that are missing, new or of another type."""
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    have = {f.name: f.dataType.simpleString() for f in actual.fields}
    problems = [(c, "missing") for c in want if c not in have]
    problems += [(c, "unexpected") for c in have if c not in want]
    problems += [(c, f"{want[c]} became {have[c]}") for c in want if c in have and want[c] != have[c]]
    return problems


def distribution_drift(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Population stability index between the category shares of two snapshots, per category.

    A category that one side lacks counts as half a row there.
    """
    def sizes(df: DataFrame, out: str) -> DataFrame:
        return df.groupBy(F.col(key).alias("category")).agg(F.count("*").alias(out))

    def share(n: str, df: DataFrame) -> Column:
        return ratio(F.coalesce(F.col(n).cast("double"), F.lit(0.5)), df.agg(F.count("*")).scalar())

    p, q = share("n_before", before), share("n_after", after)
    both = sizes(before, "n_before").join(sizes(after, "n_after"), "category", "full_outer")
    return both.select(
        "category", F.coalesce("n_before", F.lit(0)).alias("n_before"), F.coalesce("n_after", F.lit(0)).alias("n_after"),
        half_up((q - p) * F.log(ratio(q, p)), 6).alias("psi"))
