"""Dashboard figures over transactions and sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.columns import AsOf, as_day
from tidemart.functions.numeric import ratio

TREND_DAYS = 7
TOP_CATEGORIES = 8


def recent_orders(as_of: AsOf, days: int = TREND_DAYS) -> Column:
    return F.col("order_date") >= F.date_sub(as_day(as_of), days)


def orders_today(orders: DataFrame, as_of: AsOf) -> DataFrame:
    return orders.filter(F.col("order_date") == as_day(as_of)).agg(F.count(F.lit(1)).alias("value"))


def revenue_today(orders: DataFrame, as_of: AsOf) -> DataFrame:
    today = (F.col("order_date") == as_day(as_of)) & (F.col("status") == "delivered")
    return orders.filter(today).agg(F.sum("total_amount").cast("decimal(22,2)").alias("value"))


def active_sessions(sessions: DataFrame, now) -> DataFrame:
    """Sessions started in the hour before ``now``."""
    moment = now if isinstance(now, F.Column) else F.lit(now).cast("timestamp")
    started = F.col("start_time") > moment - F.expr("INTERVAL 1 HOUR")
    return sessions.filter(started).agg(F.count(F.lit(1)).alias("value"))


def conversion_today(sessions: DataFrame, as_of: AsOf) -> DataFrame:
    today = F.col("session_date") == as_day(as_of)
    converted = F.count_if("converted") * 100.0
    rate = ratio(converted, F.count(F.lit(1)))
    return sessions.filter(today).agg(F.round(rate, 2).alias("value"))


def revenue_trend(orders: DataFrame, as_of: AsOf, days: int = TREND_DAYS) -> DataFrame:
    return (
        orders.filter(recent_orders(as_of, days))
        .groupBy(F.col("order_date").alias("time"))
        .agg(F.sum("total_amount").cast("decimal(22,2)").alias("revenue"))
    )


def top_categories(
    orders: DataFrame, as_of: AsOf, days: int = TREND_DAYS, k: int = TOP_CATEGORIES
) -> DataFrame:
    return (
        orders.filter(recent_orders(as_of, days))
        .groupBy(F.col("primary_category").alias("metric"))
        .agg(F.count(F.lit(1)).alias("value"))
        .orderBy(F.desc("value"), F.asc_nulls_last("metric"))
        .limit(k)
    )
