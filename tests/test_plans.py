"""Shapes of physical plans that matter at scale; nothing here looks at results."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tidemart.operators import inventory, kpis, quality, sessions
from tidemart.plans.queries import QUERIES
from tidemart.session import fresh_dir

RELATIONAL = [
    "stg_transactions", "dim_customers", "dim_products_abc", "fct_orders", "agg_daily_revenue",
    "agg_funnel", "cohort_retention_calendar", "cohort_matrix", "sessions_by_gap", "sessions_by_id",
    "inventory_ledger", "inventory_snapshot", "order_pricing_check", "kpi_top_categories",
    "seed_dim_customers", "seed_agg_daily_revenue", "seed_agg_cohort_retention",
    "silver_transactions_latest", "contract_violations_clickstream", "contract_uuid_formats",
]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_cross_products_and_no_python(spark, sf_dir, name):
    plan = _plan(QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython"):
        assert operator not in plan


@pytest.mark.parametrize("name", ["sessions_by_gap", "cohort_retention_calendar", "agg_daily_revenue"])
def test_rows_are_reduced_before_the_first_shuffle(spark, sf_dir, name):
    """Reading upwards from the events or orders scan, an aggregation comes before the exchange."""
    lines = _plan(QUERIES[name](spark, sf_dir)).splitlines()
    source = "events.parquet" if "sessions" in name else "orders.parquet"
    scans = [i for i, line in enumerate(lines) if "FileScan" in line and source in line]
    below = [line for line in reversed(lines[: scans[-1]]) if "Exchange" in line or "partial_" in line or "Aggregate" in line]
    assert "Aggregate" in below[0]


def test_customer_metrics_do_not_read_the_lines(spark, sf_dir):
    plan = _plan(QUERIES["dim_customers"](spark, sf_dir))
    assert "lineitem.parquet" not in plan
    read = re.findall(r"ReadSchema: (struct<o_[^ ]*>)", plan)
    assert read and all("o_orderpriority" not in r for r in read)


def test_date_filter_reaches_the_scan(spark):
    path = fresh_dir(spark, "t-plan")
    spark.createDataFrame(
        [(dt.date(2025, 1, 1), 1)], "order_date date, total_amount int"
    ).write.parquet(path)
    trend = kpis.revenue_trend(spark.read.parquet(path), dt.date(2025, 1, 5))
    assert "GreaterThanOrEqual(order_date,2024-12-29)" in _plan(trend)


def test_ledger_never_broadcasts_its_carried_rows(spark, sf_dir):
    assert "BroadcastHashJoin" not in _plan(QUERIES["inventory_ledger"](spark, sf_dir))


def test_windows_of_the_ledger_run_per_chunk(spark):
    moves = spark.range(10).select(
        F.lit(1).alias("product_id"), F.lit("WH1").alias("warehouse_id"),
        F.timestamp_seconds("id").alias("timestamp"), "id", F.lit(1).alias("quantity_change"),
    )
    plan = _plan(inventory.stock_ledger(moves, ["timestamp", "id"]))
    specs = re.findall(r"windowspecdefinition\(([^)]*)", plan)
    on_movements = [s for s in specs if "timestamp" in s]
    assert on_movements and all("__chunk0" in s for s in on_movements)


def test_user_window_sees_cells_only(spark):
    events = spark.range(10).select(
        F.lit(1).alias("user_id"), F.timestamp_seconds("id").alias("timestamp"),
        F.col("id").alias("event_id"), F.lit("page_view").alias("event_type"),
        F.lit("m").alias("device_type"), F.lit("X").alias("country"),
    )
    lines = _plan(sessions.sessionize_by_gap(events, 60)).splitlines()
    window = max(i for i, line in enumerate(lines) if "Window" in line)
    assert any("Aggregate(key" in line and "cell" in line for line in lines[window:])


@pytest.mark.parametrize("name", ["kpi_active_sessions", "kpi_conversion_today"])
def test_session_figures_read_recent_events_only(spark, sf_dir, name):
    """The lower bound, known when the query runs, is a condition on the stored column at the scan."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = _plan(QUERIES[name](spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [x for x in plan.splitlines() if "FileScan" in x and "user_id" in x]
    assert scans and all("ts#" in re.search(r"DataFilters: \[(.*?)\]", x)[1] and ">=" in x for x in scans)


def test_daily_stock_needs_no_ledger(spark, sf_dir):
    plan = _plan(QUERIES["inventory_snapshot"](spark, sf_dir))
    assert "SortAggregate" not in plan and "Join" not in plan


def test_continuity_takes_closing_rows_from_its_window(spark):
    rows = spark.range(10).select(
        F.lit(1).alias("product_id"), F.lit("WH1").alias("warehouse_id"), F.timestamp_seconds("id").alias("timestamp"),
        "id", F.col("id").alias("quantity_before"), F.col("id").alias("quantity_after"),
    )
    plan = _plan(inventory.broken_links(rows, ["timestamp", "id"]))
    assert "Aggregate" not in plan


def test_column_tests_read_each_table_once(spark, sf_dir, tmp_path):
    names = {t for t, _ in quality.NOT_NULL}
    columns = {t: [c for x, c in quality.NOT_NULL if x == t] for t in names}
    for name, own in columns.items():
        spark.range(5).select(*[F.col("id").alias(c) for c in own]).write.parquet(f"{tmp_path}/{name}")
    tables = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in names}
    assert _plan(quality.column_tests(tables)).count("FileScan") == len(names)
