"""Every registered query: name -> function of (session, folder of parquet tables)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.operators import cleaning, keyed, quality, scd
from martwright.plans import advanced, audit, history, live, load, monthly, sales, views
from martwright.session import scratch_path
from martwright.sources import evolution, schemas
from martwright.sources import tables as store
from martwright.sources.star import ARRIVAL_MOD, Star, as_stream_event, with_repeats
from martwright.streaming import events as ev
from martwright.streaming import run

SEGMENT_TIERS = (3000000, 2000000, 1500000)  # spent, for platinum, gold and silver
AS_OF = dt.date(2001, 8, 1)  # reference day of recency, after the last order
MOST_FILES = 1 << 20  # more than land at a time

Query = Callable[[Star], DataFrame]


def _sales_queries() -> dict[str, Query]:
    def summary(s: Star, fan_out: bool = True) -> DataFrame:
        return views.customer_summary_view(
            s.customers(), s.sales("customer_id", "sale_id", "total_amount_cents"), s.activity(), fan_out)

    def performance(s: Star) -> DataFrame:
        return views.product_performance_view(
            s.products(), s.sales("product_id", "sale_id", "quantity", "total_amount_cents", "profit_cents"))

    money = ("sale_id", "total_amount_cents")
    return {
        "v_monthly_sales": lambda s: views.monthly_sales_view(
            s.sales("date_id", "product_id", "channel_id", "quantity", "profit_cents", *money), s.calendar(), s.products(), s.channels()),
        "v_customer_summary": summary,
        "v_customer_summary_true_value": lambda s: summary(s, fan_out=False),
        "v_product_performance": performance,
        "products_by_category": lambda s: views.products_by_category(performance(s), s.products()),
        "overview": lambda s: sales.overview(s.sales("total_amount_cents", "profit_cents"), s.customers(), s.products(), s.activity()),
        "monthly_sales": lambda s: sales.monthly_sales(s.sales("date_id", "customer_id", "profit_cents", *money), s.calendar()),
        "sales_by_category": lambda s: sales.sales_by_category(s.sales("product_id", "profit_cents", *money), s.products()),
        "sales_by_channel": lambda s: sales.sales_by_channel(s.sales("channel_id", *money), s.channels()),
        "sales_by_country": lambda s: sales.sales_by_country(s.sales("customer_id", *money), s.customers()),
        "sales_by_country_top": lambda s: sales.sales_by_country(s.sales("customer_id", *money), s.customers(), limit=10),
        "daily_pattern": lambda s: sales.daily_pattern(s.sales("date_id", *money), s.calendar()),
        "top_products": lambda s: sales.top_products(s.sales("product_id", "quantity", "profit_cents", *money), s.products()),
        "customer_segments": lambda s: sales.customer_segments(s.customers(), s.sales("customer_id", *money), SEGMENT_TIERS),
        "customer_segments_view": lambda s: sales.customer_segments_view(summary(s), SEGMENT_TIERS),
        "engagement_by_channel": lambda s: sales.engagement_by_channel(s.activity(), s.channels()),
        "customers_by_country": lambda s: sales.customers_by_country(s.customers()),
    }


def _advanced_queries() -> dict[str, Query]:
    buys = ("customer_id", "date_id", "sale_id", "total_amount_cents")

    def rfm(s: Star) -> DataFrame:
        return advanced.rfm(s.customers(), s.sales(*buys), s.calendar(), AS_OF)

    def pareto(s: Star) -> DataFrame:
        return advanced.pareto(s.sales("customer_id", "total_amount_cents"), s.customers())

    return {
        "monthly_trend": lambda s: advanced.monthly_trend(s.sales("date_id", "total_amount_cents", "profit_cents"), s.calendar()),
        "cohort_retention": lambda s: advanced.cohort_retention(
            s.customers(signup=True), s.sales("customer_id", "date_id"), s.calendar()),
        "rfm": rfm,
        "rfm_summary": lambda s: advanced.rfm_summary(rfm(s)),
        "market_basket": lambda s: advanced.market_basket(
            s.sales("customer_id", "date_id", "product_id", "sale_id"), s.products(), rows=s.raw("lineitem").count()),
        "pareto": pareto,
        "pareto_sampled": lambda s: advanced.pareto_sampled(pareto(s)),
        "ts_decompose": lambda s: advanced.ts_decompose(s.sales("date_id", "total_amount_cents"), s.calendar()),
        "clv": lambda s: advanced.clv(s.customers(), s.sales(*buys), s.calendar()),
        "clv_all": lambda s: advanced.clv(s.customers(), s.sales(*buys), s.calendar(), limit=None),
        "channel_attribution": lambda s: advanced.channel_attribution(
            s.sales("channel_id", "customer_id", "sale_id", "total_amount_cents", "profit_cents"), s.channels()),
        "revenue_forecast": lambda s: advanced.revenue_forecast(s.sales("date_id", "total_amount_cents", "profit_cents"), s.calendar()),
        "churn_risk": lambda s: advanced.churn_risk(s.customers(), s.sales("customer_id", "date_id"), s.calendar(), AS_OF),
    }


def _quality_queries() -> dict[str, Query]:
    def of_star(check: Callable[..., DataFrame]) -> Query:
        return lambda s: check(s.tables())

    def emails(s: Star) -> DataFrame:
        customers = s.customers()
        return quality.contains_at(customers, "dim_customers").unionByName(quality.emails_valid(customers, "dim_customers"))

    def drift(s: Star) -> DataFrame:
        lines, middle = s.raw("lineitem"), F.lit(dt.datetime(1998, 6, 1))
        before, after = lines.filter(F.col("l_shipdate") < middle), lines.filter(F.col("l_shipdate") >= middle)
        return quality.distribution_drift(before, after, "l_returnflag")

    def reported(s: Star) -> DataFrame:
        """The checks of an audit, written as a JSON report and read back as the newest one of a folder."""
        folder = scratch_path(s.spark, "reports")
        store.write_json_report(audit.report(s.tables(), "2024-01-02T00:00:00"), f"{folder}/quality_report_20240102")
        newest = store.read_quality_reports(s.spark, f"{folder}/*")
        return newest.select(F.inline("checks")).select(*quality.CHECK)

    return {
        "completeness": of_star(audit.completeness),
        "completeness_documents": lambda s: quality.completeness(
            s.raw("documents"), "documents", ["text", "lang", "source", "n_chars"]),
        "uniqueness": of_star(audit.uniqueness),
        "referential_integrity": of_star(audit.referential_integrity),
        "referential_integrity_labels": lambda s: quality.referential_integrity(
            s.raw("labels"), "labels", "doc_id", s.raw("documents"), "documents", "doc_id"),
        "iqr_bounds": lambda s: quality.iqr_bounds(s.sales("total_amount"), "total_amount"),
        "outliers": of_star(audit.outliers),
        "category_cv": of_star(audit.category_cv),
        "hhi_concentration": of_star(audit.hhi_concentration),
        "benford": of_star(audit.benford),
        "date_coverage": of_star(audit.date_coverage),
        "weekend_ratio": of_star(audit.weekend_ratio),
        "business_rules": of_star(audit.business_rules),
        "email_rules": emails,
        "profile_numeric": of_star(audit.profiles),
        "quality_report_json": reported,
        "audit": of_star(audit.audit),
        "audit_summary": lambda s: quality.audit_summary(audit.audit(s.tables())),
        "checks_by_category": lambda s: quality.checks_by_category(audit.audit(s.tables())),
        "post_load_validate": of_star(audit.post_load_validate),
        "distribution_drift": drift,
    }


def _landed_customers(s: Star) -> DataFrame:
    """Customers as messy text, the way a landing file has them."""
    return s.customers(signup=True).select(
        F.col("customer_id").cast("string").alias("customer_id"),
        F.concat(F.lit(" \t"), F.lower("age_group"), F.lit(" o'"), F.upper("first_name"), F.lit("  ")).alias("first_name"),
        F.concat(F.upper("country"), F.lit("-"), F.lower("city"), F.lit("\n")).alias("last_name"),
        F.concat(F.lit("  "), F.upper("email")).alias("email"),
        F.lower("country").alias("country"),
        F.upper("city").alias("city"),
        "age_group",
        F.col("signup_date").cast("string").alias("signup_date"),
    )


def _landed_sales(s: Star) -> DataFrame:
    """Sales as text; the returned lines lack a usable quantity."""
    part = s.raw("part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    text = lambda c: F.col(c).cast("string")
    return s.raw("lineitem").join(part, "l_partkey", "left").select(
        text("l_orderkey").alias("sale_id"), text("l_suppkey").alias("customer_id"), text("l_partkey").alias("product_id"),
        text("l_linenumber").alias("date_id"), F.lit("1").alias("channel_id"),
        F.when(F.col("l_returnflag") == "R", "x").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("quantity"),
        F.concat(F.lit(" "), text("p_retailprice")).alias("unit_price"), text("l_discount").alias("discount"),
        text("l_tax").alias("profit"))


def _load_queries() -> dict[str, Query]:
    def clean_customers(s: Star) -> DataFrame:
        return cleaning.split(cleaning.customers(_landed_customers(s)))[0]

    def clean_sales(s: Star, side: int) -> DataFrame:
        return cleaning.split(cleaning.sales(_landed_sales(s)))[side]

    def derived(s: Star) -> DataFrame:
        lines = s.sales("sale_id", "product_id", "quantity", "unit_price", "discount")
        cost = s.products().select("product_id", "cost_price")
        return cleaning.derive_sale_amounts(lines.join(cost, "product_id", "left"))

    def full_refresh(s: Star) -> DataFrame:
        root = scratch_path(s.spark, "warehouse")
        log = load.load_tables(s.spark, s.tables(), root).frame(s.spark)
        return log.select("phase", "table_name", "rows")

    def materialized(s: Star) -> DataFrame:
        root = scratch_path(s.spark, "warehouse")
        return load.materialize_views(s.spark, s.tables(), root).frame(s.spark).select("phase", "table_name", "rows")

    def in_months(s: Star, *tables: str) -> str:
        """A warehouse after a first load of all months, of one with half its sales, and a second load of that month alone."""
        root, days = scratch_path(s.spark, "warehouse"), s.dates()
        facts = {t: store.pick(s.tables(), t, *schemas.names(monthly.FACTS[t])) for t in tables or monthly.FACTS}
        changed = facts["fact_sales"].join(days.filter("year = 1998 AND month = 2").select("date_id"), "date_id", "left_semi")
        first = facts["fact_sales"].join(days.filter("year = 1998 AND month = 2 AND day_of_week > 2").select("date_id"), "date_id", "left_anti")
        monthly.load_months(s.spark, root, {**facts, "fact_sales": first}, days)
        monthly.load_months(s.spark, root, {"fact_sales": changed}, days)
        return root

    def kept_up(name: str) -> Query:
        return lambda s: monthly.view(s.spark, in_months(s), s.tables(), name)

    def reach(s: Star) -> DataFrame:
        """Exact distinct customers by month, by channel and in all, and whether the merged sketches are within their error."""
        root, by = in_months(s, "fact_sales"), (monthly.MONTH, "channel_id")
        sold = monthly.read_months(s.spark, root, "fact_sales")

        def level(*keys: str) -> DataFrame:
            exact = sold.groupBy(*keys).agg(F.countDistinct("customer_id").alias("exact"))
            about = monthly.reach(s.spark, root, *keys)
            both = exact.join(about, list(keys)) if keys else exact.withColumn("customers", about.scalar())
            within = F.abs(F.col("customers") - F.col("exact")) <= F.ceil(F.col("exact") * monthly.REACH_ERROR)
            return both.select(
                *[(F.col(k) if k in keys else F.lit(None)).cast("bigint").alias(k) for k in by], F.col("exact").alias("unique_customers"), within.alias("within_error"))

        return level(by[0]).unionByName(level(by[1])).unionByName(level())

    def loaded(s: Star) -> str:
        """A warehouse loaded from CSV files of all tables."""
        landing, root = scratch_path(s.spark, "landing"), scratch_path(s.spark, "warehouse")
        tables = s.tables()
        for table, ddl in schemas.STAR.items():
            store.write_csv(store.pick(tables, table, *schemas.names(ddl)), f"{landing}/{schemas.STAR_FILES[table]}")
        load.load_star(s.spark, landing, root)
        return root

    def from_csv(s: Star) -> DataFrame:
        return load.validate(s.spark, loaded(s))

    def run_log(s: Star) -> DataFrame:
        """What the log of a load says, read back."""
        return store.read_parquet(s.spark, f"{loaded(s)}/etl_run_log", load.RUN_LOG).select("phase", "table_name", "rows")

    def created(s: Star) -> DataFrame:
        """Rows of all tables after tables were declared that were loaded before, and some that were not."""
        root = scratch_path(s.spark, "warehouse")
        load.load_tables(s.spark, s.tables(), root)
        ddls = {**schemas.STAR, "stream_windows": schemas.STREAM_WINDOWS}
        store.create_if_absent(s.spark, root, ddls)
        counts = [df.agg(F.lit(t).alias("table_name"), F.count("*").alias("rows")) for t, df in store.read_warehouse(s.spark, root, ddls).items()]
        return reduce(DataFrame.unionByName, counts)

    def quarantined_customers(s: Star) -> DataFrame:
        """Customers whose names have line breaks; a third is cut off in the second field, some have no number for an id."""
        columns = schemas.names(schemas.STAR["dim_customers"])
        landing, number = scratch_path(s.spark, "landing"), F.col("customer_id")
        people = s.customers(signup=True).select(*columns)
        broken = people.filter(number % 3 == 0).select(F.concat_ws(",", "customer_id", "first_name").alias("value"))
        header = s.spark.createDataFrame([(",".join(columns),)], "value string")
        header.withColumn("at", F.lit(0)).unionByName(broken.withColumn("at", F.lit(1))).coalesce(1).sortWithinPartitions("at").select(
            "value").write.text(landing)
        shown = F.when((number % 3 == 1) & (number % 5 == 0), F.concat(F.lit("x"), number)).otherwise(number.cast("string"))
        people.filter(number % 3 > 0).withColumns({
            "customer_id": shown, "last_name": F.concat("last_name", F.lit("\n"), "last_name")}).write.mode("append").options(**store.CSV).csv(landing)
        landed = store.read_csv(s.spark, landing, columns)
        return cleaning.split(cleaning.customers(landed))[1].select("problem", "customer_id", "email")

    def evolving(s: Star) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Customers landed in three files' schemas: whole credits, credits with a point and a city, credits as text."""
        landing, number = scratch_path(s.spark, "landing"), F.col("customer_id")
        shapes = {
            "v0": [number.alias("customer_id"), F.col("email"), number.alias("credit")],
            "v1": [number.alias("customer_id"), F.col("email"), (number + F.lit("0.5").cast("decimal(2,1)")).alias("credit"), F.lit("Rome").alias("city")],
            "v2": [number.alias("customer_id"), F.col("email"), F.concat(number, F.lit(" EUR")).alias("credit")]}
        for k, (version, columns) in enumerate(shapes.items()):
            s.customers().filter(number % 3 == k).select(F.to_json(F.struct(*columns)).alias("value")).write.text(f"{landing}/{version}")
        return evolution.read_evolving(s.spark, f"{landing}/*", "customer_id bigint, email string, credit double, phone string")

    def evolving_versions(s: Star) -> DataFrame:
        return evolving(s)[2].select(F.regexp_extract("file", "/(v[0-9])/[^/]*$", 1).alias("version"), F.col("column").alias("field"), "verdict").distinct()

    def evolving_quarantine(s: Star) -> DataFrame:
        return evolving(s)[1].select(F.get_json_object("value", "$.customer_id").cast("bigint").alias("customer_id"), "problem")

    return {
        "landed_schema_versions": evolving_versions,
        "landed_in_declared_schema": lambda s: evolving(s)[0],
        "landed_in_other_schema": evolving_quarantine,
        "build_dim_date": lambda s: s.dates(),
        "clean_customers": clean_customers,
        "clean_sales": lambda s: clean_sales(s, 0),
        "quarantined_sales": lambda s: clean_sales(s, 1),
        "derive_sale_amounts": derived,
        "full_refresh_load": full_refresh,
        "etl_run_log": run_log,
        "create_if_absent": created,
        "materialize_views": materialized,
        **{f"kept_{name}": kept_up(name) for name in load.VIEWS},
        "approximate_reach": reach,
        "load_star_from_csv": from_csv,
        "read_back_sales": lambda s: store.read_table(s.spark, loaded(s), "fact_sales", schemas.STAR["fact_sales"]),
        "quarantined_customers": quarantined_customers,
    }


def _history_queries() -> dict[str, Query]:
    start = dt.datetime(1990, 1, 1)
    tracked = ["first_name", "last_name", "email", "country", "city", "age_group"]

    def initial(s: Star) -> DataFrame:
        return scd.scd2_init(s.customers(), start)

    def changes(s: Star) -> DataFrame:
        """Every order reports a change of its customer; some fields are left out."""
        status = F.col("o_orderstatus")
        return s.raw("orders").select(
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("timestamp").alias("changed_at"),
            F.when(status == "F", F.col("o_orderpriority")).alias("city"),
            F.when(status != "P", status).alias("age_group"),
            "o_orderkey",
        )

    def applied(s: Star) -> tuple[DataFrame, DataFrame]:
        return scd.scd2_apply(initial(s), changes(s), "customer_id", tracked, "changed_at", tie_break=["o_orderkey"])

    def stored(s: Star) -> str:
        """A warehouse that holds the history of customers after all changes."""
        root, dim = scratch_path(s.spark, "warehouse"), s.customers()
        history.start(s.spark, root, "dim_customers", dim, start)
        history.apply(s.spark, root, "dim_customers", changes(s), "customer_id", tracked, "changed_at", ["o_orderkey"],
                      initial(s).schema)
        return root

    def spliced(s: Star) -> str:
        """The same warehouse from two batches whose changes lie between one another."""
        root, every, odd = scratch_path(s.spark, "warehouse"), changes(s), F.col("o_orderkey") % 2
        history.start(s.spark, root, "dim_customers", s.customers(), start)
        for some in (every.filter(odd == 1), every.filter(odd == 0)):
            history.apply(s.spark, root, "dim_customers", some, "customer_id", tracked, "changed_at", ["o_orderkey"], initial(s).schema)
        return root

    def versions(s: Star) -> DataFrame:
        return history.open_history(s.spark, stored(s), "dim_customers", initial(s).schema)

    def joined(s: Star) -> DataFrame:
        facts = s.raw("orders").select("o_orderkey", F.col("o_custkey").alias("customer_id"),
                                       F.col("o_orderdate").cast("timestamp").alias("ordered_at"))
        return scd.scd_join_as_of(facts, versions(s), "customer_id", "ordered_at")

    return {
        "scd2_initial_load": initial,
        "scd2_initial_load_products": lambda s: scd.scd2_init(
            s.products().withColumns({c: F.col(c).cast("double") for c in ("unit_price", "cost_price")}), start),
        "scd2_apply_changes": lambda s: applied(s)[0],
        "scd_change_log": lambda s: applied(s)[1],
        "stored_change_log": lambda s: history.change_log(s.spark, stored(s)),
        "scd2_late_applied": lambda s: history.open_history(s.spark, spliced(s), "dim_customers", initial(s).schema),
        "spliced_change_log": lambda s: history.change_log(s.spark, spliced(s)),
        "scd_current": lambda s: scd.scd_current(versions(s)),
        "scd_history": lambda s: scd.scd_history(versions(s), "customer_id", 1),
        "scd_as_of": lambda s: scd.scd_as_of(versions(s), dt.datetime(1998, 1, 1)),
        "scd_join_as_of": joined,
        "scd1_apply": lambda s: scd.scd1_apply(s.customers(), changes(s).withColumn(
            "changed_at", F.struct("changed_at", "o_orderkey")), "customer_id", tracked, "changed_at"),
        "scd3_apply": lambda s: scd.scd3_apply(s.customers(), changes(s).withColumn(
            "changed_at", F.struct("changed_at", "o_orderkey")), "customer_id", tracked, "changed_at").drop(
                *[f"previous_{c}" for c in tracked if c not in ("city", "age_group")]),
    }


def _event_queries() -> dict[str, Query]:
    order = ["arrival", "event_id"]

    def unique(s: Star) -> DataFrame:
        return ev.dedup_events(s.stream_events(), order="arrival")

    def windows(s: Star, size: str = "10 seconds", slide: str | None = None) -> DataFrame:
        return ev.window_aggregate(unique(s), size, slide)

    def cells(s: Star) -> DataFrame:
        return ev.window_cells(unique(s), "1 hour")

    def late(s: Star) -> DataFrame:
        return ev.late_events(unique(s), order)

    def upserted(s: Star) -> DataFrame:
        def of(*channels: str) -> DataFrame:
            return ev.window_aggregate(unique(s).filter(F.col("channel").isin(*channels)), "1 hour")

        return keyed.upsert(of("web", "api"), of("mobile"), ["window_start"], "window_start")

    def inserted(s: Star) -> DataFrame:
        target = unique(s).filter(F.col("channel") == "web")
        return keyed.insert_ignore(target, s.stream_events(), ["event_id"], "arrival")

    def stream(s: Star) -> DataFrame:
        """The events file as a stream, sent like `Star.stream_events`."""
        # A pattern of one name: the table may be a file or a folder of files.
        source = s.spark.readStream.schema(schemas.TABLES["events"]).parquet(f"{s.folder}/events.parque[t]")
        return with_repeats(as_stream_event(source)).withColumn("event_id", F.col("event_id").cast("string"))

    def in_batches(s: Star, read, copies_slot: int | None = None) -> DataFrame:
        """All results of a stream of four micro-batches. Events land in order of arrival, a quarter after the other, copies quarters
        later; the stream takes up each quarter, of any number of files, when it has landed, and goes on from its checkpoint."""
        folder, sink, quarter = scratch_path(s.spark, "events"), scratch_path(s.spark, "stream"), ARRIVAL_MOD // 2
        sent = s.stream_events().withColumn("event_id", F.col("event_id").cast("string"))
        ddl = schemas.STREAM_EVENTS + ", arrival bigint"
        for k in range(4):
            sent.filter(F.floor(F.col("arrival") / F.lit(quarter)).cast("int") == k if k < 3 else F.col("arrival") >= 3 * quarter).write.mode(
                "append").parquet(folder)
            source = ev.event_source(s.spark, folder, ddl, files_per_batch=MOST_FILES, file_format="parquet")
            run.run_all(source, sink, f"{sink}/checkpoint", size="10 minutes", order=order, copies_slot=copies_slot).awaitTermination()
        return read(s.spark, sink)

    def streamed(s: Star, start, read, *args, **options) -> DataFrame:
        sink = scratch_path(s.spark, "stream")
        start(stream(s), sink, f"{sink}/checkpoint", *args, **options).awaitTermination()
        return read(s.spark, sink)

    def published(s: Star) -> DataFrame:
        def read(spark: SparkSession, sink: str) -> DataFrame:
            run.publish_windows(spark, sink, f"{sink}/warehouse")
            return store.read_table(spark, f"{sink}/warehouse", "stream_windows", schemas.STREAM_WINDOWS)

        return streamed(s, run.run_windows, read, size="10 minutes", order=order)

    return {
        "dedup_events": unique,
        "window_aggregate": windows,
        "window_aggregate_sliding": lambda s: windows(s, "2 hours", "1 hour"),
        "events_by_type": lambda s: ev.window_breakdown(cells(s), "event_type"),
        "events_by_channel": lambda s: ev.window_breakdown(cells(s), "channel"),
        "minute_bucket": lambda s: unique(s).groupBy(ev.minute_bucket("event_time", 25).alias("window_start")).agg(
            F.count("*").alias("events")),
        "late_events": late,
        "all_windows": lambda s: ev.all_windows(windows(s, "1 minute")),
        "stream_windows_latest": lambda s: ev.stream_windows_latest(windows(s)),
        "stream_summary": lambda s: ev.stream_summary(s.stream_events(), unique(s), late(s), windows(s)),
        "insert_ignore": inserted,
        "upsert_replace": upserted,
        "stream_events_sink": lambda s: streamed(s, run.run_events, run.read_events, order=order),
        "stream_events_sink_bounded": lambda s: in_batches(s, run.read_events),
        "stream_events_by_slot": lambda s: in_batches(s, run.read_events, 86400),
        "stream_windows_by_slot": lambda s: in_batches(s, run.read_windows, 86400),
        "stream_windows_in_batches": lambda s: in_batches(s, run.read_windows),
        "stream_lateness_in_batches": lambda s: in_batches(s, run.read_lateness),
        "window_maps": lambda s: ev.window_maps(cells(s)).select(
            "window_start", *[F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias(c) for c in ("events_by_type", "channels")]),
        "stream_windows_sink": lambda s: streamed(s, run.run_windows, run.read_windows, size="10 minutes", order=order),
        "stored_stream_windows": published,
        "stream_lateness": lambda s: streamed(s, run.run_lateness, run.read_lateness, order),
    }


def _as_landed(rows: DataFrame, ddl: str, **fields: Column) -> DataFrame:
    """Documents written as JSON text and read back with the landing schema."""
    return rows.select(F.from_json(F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()])), ddl).alias("_doc")).select("_doc.*")


def _live_queries() -> dict[str, Query]:
    at = dt.datetime(2024, 1, 1)
    c = F.col

    def coin() -> dict[str, Column]:
        price, size = c("p_retailprice"), c("p_size").cast("double")
        change = (c("p_partkey") % 21 - 10).cast("double")
        return dict(
            id=c("p_partkey").cast("string"), symbol=c("p_brand"), name=c("p_name"),
            current_price=price, market_cap=size * 1000.0, total_volume=size * 10.0, price_change_24h=change,
            price_change_percentage_24h=change / 4.0, high_24h=price, low_24h=price, circulating_supply=size,
            market_cap_rank=(c("p_partkey") + 1).cast("int"), last_updated=c("p_type"))

    def crypto(s: Star) -> DataFrame:
        return live.flatten_crypto(_as_landed(s.raw("part"), schemas.RAW_CRYPTO, **coin()), at)

    def land(rows: DataFrame, key: str, record: Column, path: str, around: str = "%s") -> None:
        """Records as JSON files of one page each; a page holds the array of the records of 500 keys."""
        page = F.floor(c(key) / 500).alias("page")
        pages = rows.groupBy(page).agg(F.to_json(F.collect_list(record)).alias("records"))
        pages.select("page", F.format_string(around, "records").alias("value")).write.partitionBy("page").text(path)

    def ingested(s: Star) -> Mapping[str, DataFrame]:
        """Live tables after two landing runs, of which the second counts, and a source that landed nothing."""
        landing, root = scratch_path(s.spark, "landing"), scratch_path(s.spark, "live")
        record = F.struct(*[v.alias(k) for k, v in coin().items()])
        land(s.raw("part").withColumn("p_retailprice", F.lit(0.0)), "p_partkey", record, f"{landing}/crypto_20240101_120000.json")
        land(s.raw("part"), "p_partkey", record, f"{landing}/crypto_20240102_120000.json")
        live.ingest(s.spark, landing, root, [source for source in live.SOURCES if source.label in ("CoinGecko", "GitHub")])
        return live.read_live(s.spark, root)

    def logged(s: Star) -> DataFrame:
        return live.ingestion_log(ingested(s)["api_ingestion_log"]).select(
            "source", "status", "records_count", c("error_message").isNotNull().alias("failed"), (c("completed_at") >= c("started_at")).alias("in_order"))

    def countries(s: Star) -> DataFrame:
        rows = s.raw("customer").join(s.raw("nation"), c("c_nationkey") == c("n_nationkey")).join(
            s.raw("region"), c("n_regionkey") == c("r_regionkey"))
        some = c("c_custkey") % 4 != 0
        return live.flatten_countries(_as_landed(
            rows, schemas.RAW_COUNTRIES,
            name=F.struct(c("c_name").alias("common"), c("n_name").alias("official")),
            capital=F.when(some, F.array("c_mktsegment", "n_name")),
            region=F.when(some, c("r_name")), subregion=c("n_name"),
            population=F.floor(c("c_acctbal")).cast("bigint"), area=F.floor(c("c_acctbal") / 10).cast("double"),
            languages=F.when(some, F.create_map(F.lit("a"), c("c_mktsegment"))),
            currencies=F.when(some, F.create_map(c("r_name"), F.struct(c("n_name").alias("name")))),
            flag=c("c_mktsegment"), latlng=F.when(some, F.array(c("c_nationkey").cast("double"))),
            timezones=F.when(some, F.array("r_name", "n_name"))), at)

    def weather(s: Star) -> DataFrame:
        code = F.get_json_object("props", "$.k").cast("int")
        place = F.nullif((c("user_id") % 20).cast("int"), F.lit(0))
        current = F.struct(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"), c("value").alias("temperature_2m"),
            (c("value") / 2).alias("wind_speed_10m"), code.cast("double").alias("relative_humidity_2m"), code.alias("weather_code"))
        return live.flatten_weather(_as_landed(
            s.raw("events"), schemas.RAW_WEATHER, latitude=c("value"), longitude=c("value"), location_id=place, current=current), at)

    def rates(s: Star) -> DataFrame:
        code = F.upper(F.substring("event_type", 1, 3))
        return live.flatten_exchange_rates(_as_landed(
            s.raw("events"), schemas.RAW_EXCHANGE_RATES, amount=F.lit(1.0), base=F.lit("USD"), date=F.date_format("ts", "yyyy-MM-dd"),
            rates=F.create_map(code, c("value"), F.lit("EUR"), c("value") * 2)), at)

    def github(s: Star) -> DataFrame:
        item = F.struct(
            c("doc_id").cast("string").alias("name"), F.concat_ws("/", "source", c("doc_id").cast("string")).alias("full_name"),
            c("text").alias("description"), F.nullif(c("lang"), F.lit("en")).alias("language"),
            c("n_chars").alias("stargazers_count"), (c("n_chars") % 97).alias("forks_count"), (c("doc_id") % 7).alias("open_issues_count"),
            c("doc_id").alias("watchers_count"), c("source").alias("created_at"), c("source").alias("updated_at"),
            c("source").alias("html_url"))
        return live.flatten_github(_as_landed(s.raw("documents"), schemas.RAW_GITHUB, items=F.array(item)), at)

    def task() -> Column:
        return F.struct(
            F.lit("nightly").alias("dag_id"), c("o_orderkey").cast("string").alias("task_id"), c("o_orderpriority").alias("description"),
            c("o_orderstatus").alias("status"), F.lit(1).alias("attempt"), F.lit(None).cast("string").alias("start_time"),
            F.lit(None).cast("string").alias("end_time"), F.when(c("o_orderstatus") != "P", c("o_totalprice")).alias("duration_sec"),
            F.lit(None).cast("string").alias("error"))

    def lineage(s: Star) -> DataFrame:
        docs = _as_landed(s.raw("orders"), schemas.LINEAGE, dag_id=F.lit("nightly"), lineage=F.array(task()))
        return live.lineage_summary(docs.select(F.inline("lineage")))

    def landed_lineage(s: Star) -> DataFrame:
        """The same run records, by way of files that hold up to 500 of them."""
        path = scratch_path(s.spark, "lineage")
        land(s.raw("orders"), "o_orderkey", task(), path, '{"dag_id": "nightly", "lineage": %s}')
        return live.lineage_summary(store.read_lineage(s.spark, path))

    return {
        "flatten_crypto": crypto,
        "flatten_countries": countries,
        "flatten_weather": weather,
        "flatten_exchange_rates": rates,
        "flatten_github": github,
        "crypto_ranked": lambda s: live.crypto_ranked(crypto(s)),
        "crypto_summary": lambda s: live.crypto_summary(crypto(s)),
        "countries_ranked": lambda s: live.countries_ranked(countries(s)),
        "countries_by_region": lambda s: live.countries_by_region(countries(s)),
        "weather_current": lambda s: live.weather_current(weather(s)),
        "exchange_rates": lambda s: live.exchange_rates(rates(s)),
        "exchange_rates_major": lambda s: live.exchange_rates(rates(s), live.MAJOR_CURRENCIES),
        "github_ranked": lambda s: live.github_ranked(github(s)),
        "github_by_language": lambda s: live.github_by_language(github(s)),
        "lineage_summary": lineage,
        "read_lineage": landed_lineage,
        "ingested_crypto": lambda s: ingested(s)["api_crypto_prices"].drop("ingested_at"),
        "ingestion_log": logged,
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: query(Star(spark, folder))

    groups = (_sales_queries, _advanced_queries, _quality_queries, _load_queries, _history_queries, _event_queries, _live_queries)
    return {name: bind(query) for group in groups for name, query in group().items()}
