"""Cohort retention by month of first order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.functions.calendar import month_start, months_apart
from tidemart.functions.columns import as_col
from tidemart.functions.numeric import safe_pct
from tidemart.functions.text import month_label

LAST_PERIOD = 11


def user_months(orders: DataFrame, timestamp: str) -> DataFrame:
    """Distinct (user, active month) with the user's cohort month.

    Orders collapse to user-months before the per-user window, so the window sees
    at most one row per calendar month even for a user with a third of all orders.
    """
    months = orders.select("user_id", month_start(timestamp).alias("active_month")).distinct()
    return months.withColumn(
        "cohort_month", F.min("active_month").over(W.partitionBy("user_id"))
    )


def agg_cohort_retention(
    orders: DataFrame, period: str = "calendar", last_period: int = LAST_PERIOD
) -> DataFrame:
    """Active users per cohort and period, cohort size, retention rate.

    ``period="calendar"`` counts calendar months; ``"30day"`` divides the days
    between month starts by 30 and leaves the fraction.
    """
    months = user_months(orders, "order_timestamp")
    if period == "calendar":
        number = months_apart("active_month", "cohort_month")
    elif period == "30day":
        number = F.datediff("active_month", "cohort_month").cast("double") / 30
    else:
        raise ValueError("period is 'calendar' or '30day'")
    counts = (
        months.withColumn("period_number", number)
        .filter(F.col("period_number").between(0, last_period))
        .groupBy("cohort_month", "period_number")
        .agg(F.count("user_id").alias("active_users"))
    )
    # One row per (cohort, period) from here on.
    size = F.first("active_users").over(W.partitionBy("cohort_month").orderBy("period_number"))
    return counts.withColumn("cohort_size", size).withColumn(
        "retention_rate", safe_pct("active_users", "cohort_size")
    )


def cohort_matrix(retention: DataFrame, last_period: int = LAST_PERIOD) -> DataFrame:
    """Months as rows, periods as columns "Month 0", "Month 1", ..."""
    periods = list(range(last_period + 1))
    wide = (
        retention.groupBy(month_label("cohort_month").alias("cohort_month"))
        .pivot("period_number", periods)
        .agg(F.first("retention_rate"))
    )
    return wide.select("cohort_month", *[as_col(str(p)).alias(f"Month {p}") for p in periods])


def retention_curve(retention: DataFrame) -> DataFrame:
    """Mean retention per period over the cohorts that reached it."""
    rate = F.col("retention_rate").cast("decimal(9,2)")
    return retention.groupBy("period_number").agg(
        F.round(F.sum(rate).cast("double") / F.count(rate), 6).alias("avg_retention"),
        F.count(F.lit(1)).alias("cohorts"),
    )
