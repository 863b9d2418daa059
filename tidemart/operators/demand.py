"""Demand series: daily rollup, calendar and lag features, splits, rule forecast.

Windows without a partition appear only on the daily rollup, which has one row
per calendar day whatever the size of the order table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.functions.calendar import is_weekend, weekday_monday0
from tidemart.functions.columns import AsOf, as_day, null_as_zero
from tidemart.functions.numeric import non_negative, ratio

# The two feature lists, lags, horizons and the weekend factor.
DAILY_FEATURES = (
    "day_of_week", "month", "quarter", "is_weekend", "lag_1", "lag_7", "lag_14",
    "rolling_7", "rolling_30", "avg_order_value", "cancellation_rate_pct",
)
CATEGORY_FEATURES = (
    "day_of_week", "month", "lag_7", "lag_14", "avg_order_value", "cancellation_rate_pct",
)
LAGS = (1, 7, 14)
ROLLINGS = (7, 30)
RECENT_DAYS = 30
DAYS_AHEAD = 7
WEEKEND_FACTOR = 1.3
SPLITS = 3
TEST_SHARE = 0.2


def daily_demand(daily_revenue: DataFrame) -> DataFrame:
    """Categories summed to days; the two rates are plain means over the categories."""
    def mean(column: str) -> Column:
        # A decimal sum does not depend on the order in which tasks add up.
        return F.round(ratio(F.sum(F.col(column).cast("decimal(22,8)")), F.count(column)), 6)

    rolled = daily_revenue.groupBy("order_date").agg(
        F.sum("total_orders").alias("total_orders"),
        F.sum("gross_revenue").cast("decimal(28,2)").alias("gross_revenue"),
        mean("avg_order_value").alias("avg_order_value"),
        mean("cancellation_rate_pct").alias("cancellation_rate_pct"),
    )
    return null_as_zero(rolled)


def calendar_features(df: DataFrame, day: str = "order_date") -> DataFrame:
    return (
        df.withColumn("day_of_week", weekday_monday0(day))
        .withColumn("month", F.month(day))
        .withColumn("quarter", F.quarter(day))
        .withColumn("is_weekend", is_weekend(day).cast("int"))
    )


def daily_features(daily: DataFrame, include_today: bool = False) -> DataFrame:
    """Eleven features per day; days without a full history are dropped.

    Rolling means end on the day before, so they do not contain the target;
    ``include_today=True`` ends them on the day itself.
    """
    in_time = W.orderBy("order_date")
    target = F.col("total_orders")
    out = calendar_features(daily)
    for n in LAGS:
        out = out.withColumn(f"lag_{n}", F.lag(target, n).over(in_time))
    for n in ROLLINGS:
        span = in_time.rowsBetween(1 - n, 0) if include_today else in_time.rowsBetween(-n, -1)
        full = F.count(target).over(span) == n
        mean = F.sum(target).over(span).cast("double") / n
        out = out.withColumn(f"rolling_{n}", F.when(full, F.round(mean, 6)))
    return out.select("order_date", "total_orders", "gross_revenue", *DAILY_FEATURES).na.drop()


def category_features(daily_revenue: DataFrame) -> DataFrame:
    """Six features per (day, category); lags stay inside the category, missing ones are 0."""
    in_time = W.partitionBy("primary_category").orderBy("order_date")
    out = calendar_features(daily_revenue)
    for n in (7, 14):
        out = out.withColumn(f"lag_{n}", F.lag("total_orders", n, 0).over(in_time))
    return out.select("order_date", "primary_category", "total_orders", *CATEGORY_FEATURES).na.drop(
        subset=["total_orders", *CATEGORY_FEATURES]
    )


def recent_days(daily: DataFrame, days: int = RECENT_DAYS) -> DataFrame:
    """The newest days (top-k by date)."""
    return daily.orderBy(F.desc("order_date")).limit(days)


def recent_with_lags(daily: DataFrame, days: int = RECENT_DAYS) -> DataFrame:
    """The newest days with lags 7 and 14; missing lags take the mean of the window."""
    recent = calendar_features(recent_days(daily, days))
    in_time = W.orderBy("order_date")  # at most `days` rows
    everything = W.partitionBy()
    mean = F.round(F.avg("total_orders").over(everything), 6)
    return recent.select(
        "order_date",
        "total_orders",
        "day_of_week",
        "month",
        *[
            F.coalesce(F.lag("total_orders", n).over(in_time).cast("double"), mean).alias(f"lag_{n}")
            for n in (7, 14)
        ],
        "avg_order_value",
        "cancellation_rate_pct",
    )


def future_days(df: DataFrame, as_of: AsOf, days_ahead: int = DAYS_AHEAD) -> DataFrame:
    """One row per coming day, from a one-row frame."""
    first = F.date_add(as_day(as_of), 1)
    last = F.date_add(as_day(as_of), days_ahead)
    return df.withColumn("forecast_date", F.explode(F.sequence(first, last)))


def rule_forecast(daily: DataFrame, as_of: AsOf, days_ahead: int = DAYS_AHEAD) -> DataFrame:
    """Mean of the recent days, raised on weekends."""
    level = recent_days(daily).agg(F.avg("total_orders").alias("level"))
    factor = F.when(is_weekend("forecast_date"), F.lit(WEEKEND_FACTOR)).otherwise(F.lit(1.0))
    return future_days(level, as_of, days_ahead).select(
        "forecast_date",
        F.round(non_negative(F.col("level") * factor), 1).alias("predicted_orders"),
    )


def expanding_folds(daily: DataFrame, splits: int = SPLITS) -> DataFrame:
    """Rows labelled train or test per fold; every fold trains on all earlier days.

    With n days each test block has n div (splits + 1) days and the blocks end at
    the last day.
    """
    numbered = daily.withColumn("__i", F.row_number().over(W.orderBy("order_date")) - 1).withColumn(
        "__n", F.count(F.lit(1)).over(W.partitionBy())
    )
    block = F.floor(F.col("__n") / (splits + 1))
    folds = numbered.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(splits))))
    starts = F.col("__n") - (F.lit(splits + 1) - F.col("fold")) * block
    role = F.when(F.col("__i") < starts, "train").when(F.col("__i") < starts + block, "test")
    return folds.withColumn("role", role).filter(F.col("role").isNotNull()).drop("__i", "__n")


def chronological_split(df: DataFrame, test_share: float = TEST_SHARE) -> DataFrame:
    """Label the newest share of the days "test"; a day is never split.

    The cut is a position among the distinct days, one row per calendar day.
    """
    days = df.select("order_date").distinct()
    in_time = W.orderBy("order_date")
    n = F.count(F.lit(1)).over(W.partitionBy())
    is_test = F.row_number().over(in_time) > n - F.ceil(n * test_share)
    roles = days.select("order_date", F.when(is_test, "test").otherwise("train").alias("role"))
    return df.join(roles, "order_date")
