"""Full-refresh load of the warehouse: extract, clean, write, validate, log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from martwright.operators import cleaning
from martwright.plans import views
from martwright.plans.audit import post_load_validate
from martwright.session import cut
from martwright.sources import schemas
from martwright.sources import tables as store

RUN_LOG = "run_at timestamp, phase string, table_name string, rows bigint, error string"


@dataclass
class LoadRun:
    """Row counts by phase and table, as the run log records them."""

    at: dt.datetime = field(default_factory=lambda: dt.datetime.now(dt.timezone.utc))
    entries: list[tuple] = field(default_factory=list)

    def note(self, phase: str, table: str, rows: int | None, error: str | None = None) -> None:
        self.entries.append((self.at, phase, table, rows, error))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.entries, RUN_LOG)


def load_tables(spark: SparkSession, tables: Mapping[str, DataFrame], root: str, run: LoadRun | None = None,
                quarantine: Mapping[str, DataFrame] | None = None) -> LoadRun:
    """Replace the whole warehouse: dimensions, then facts, visible in one commit."""
    run = run or LoadRun()
    snapshot = run.at.strftime("%Y%m%d%H%M%S%f")
    for table, ddl in schemas.STAR.items():
        rows = store.write_snapshot(store.typed(store.pick(tables, table, *schemas.names(ddl)), ddl), root, table, snapshot)
        run.note("loaded", table, rows)
    for table, bad in (quarantine or {}).items():
        rows = store.write_snapshot(bad, root, f"{table}_quarantine", snapshot)
        run.note("quarantined", table, rows)
    store.commit(spark, root, snapshot, [*schemas.STAR, *[f"{t}_quarantine" for t in quarantine or {}]])
    return run


def load_star(spark: SparkSession, raw_folder: str, root: str, strict: bool = False, line_breaks: bool = True) -> DataFrame:
    """Load the six landing CSVs into the warehouse and return the run's row counts.

    Rows that do not cast and malformed records go to `<table>_quarantine`; with `strict` the first one fails the load.
    Each file is parsed and cleaned once; good and bad rows are taken from what that gave.
    A failed load is logged and leaves the committed warehouse as it was.
    """
    run = LoadRun()
    try:
        good, bad = {}, {}
        for table, landed in store.read_csv_star(spark, raw_folder, line_breaks).items():
            good[table], rejected = cleaning.split(cut(cleaning.CLEANERS[table](landed, strict)))
            if not strict:
                bad[table] = rejected
        load_tables(spark, good, root, run, bad)
        loaded = {t: n for _, phase, t, n, _ in run.entries if phase == "loaded"}
        rejected = {t: n for _, phase, t, n, _ in run.entries if phase == "quarantined"}
        for table in schemas.STAR:
            run.note("extracted", table, loaded[table] + rejected.get(table, 0))
    except Exception as error:
        run.note("failed", "", None, str(error))
        raise
    finally:
        store.append(run.frame(spark).coalesce(1), f"{root.rstrip('/')}/etl_run_log")
    return run.frame(spark)


VIEWS = ("v_monthly_sales", "v_customer_summary", "v_product_performance")


def view(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    """One of the semantic views over warehouse tables."""
    t = lambda table: store.pick(tables, table, *schemas.names(schemas.STAR[table]))
    if name == "v_monthly_sales":
        return views.monthly_sales_view(t("fact_sales"), t("dim_date"), t("dim_products"), t("dim_channels"))
    if name == "v_customer_summary":
        return views.customer_summary_view(t("dim_customers"), t("fact_sales"), t("fact_user_activity"))
    if name == "v_product_performance":
        return views.product_performance_view(t("dim_products"), t("fact_sales"))
    raise KeyError(name)


def materialize_views(spark: SparkSession, tables: Mapping[str, DataFrame], root: str) -> LoadRun:
    """Write the three views as tables of one commit, to be refreshed after a load."""
    run = LoadRun()
    snapshot = run.at.strftime("%Y%m%d%H%M%S%f")
    for name in VIEWS:
        run.note("materialized", name, store.write_snapshot(view(tables, name), root, name, snapshot))
    store.commit(spark, root, snapshot, VIEWS)
    return run


def validate(spark: SparkSession, root: str) -> DataFrame:
    """The post-load figures of the committed warehouse."""
    return post_load_validate(store.read_warehouse(spark, root))
