"""Customer dimension: order metrics, lifetime value, churn flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.calendar import day_start, elapsed_days
from tidemart.functions.columns import AsOf
from tidemart.functions.numeric import exact_mean, ratio

CHURN_DAYS = 90
NEVER_ORDERED_DAYS = 9999.0
CLV_YEARS = 3


def order_metrics(orders: DataFrame) -> DataFrame:
    """Per user: order counts, revenue, first and last order time."""
    return orders.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("total_amount").alias("total_revenue"),
        exact_mean("total_amount").alias("avg_order_value"),
        F.min("order_timestamp").alias("first_order_date"),
        F.max("order_timestamp").alias("last_order_date"),
        F.count_if(F.col("status") == "delivered").alias("completed_orders"),
        F.count_if(F.col("status") == "cancelled").alias("cancelled_orders"),
    )


def dim_customers(
    users: DataFrame, orders: DataFrame, as_of: AsOf, churn_days: int = CHURN_DAYS
) -> DataFrame:
    """All users with their order metrics; users without orders count as not churned."""
    now = day_start(as_of)
    rate = ratio("total_revenue", elapsed_days(now, "first_order_date")) * 365
    metrics = (
        order_metrics(orders)
        .withColumn("days_since_last_order", elapsed_days(now, "last_order_date"))
        .withColumn("annual_revenue_rate", F.round(rate, 2))
    )
    zero = F.lit(0)
    money_zero = F.lit(0).cast("decimal(22,2)")
    return users.join(metrics, "user_id", "left").select(
        "user_id",
        "email",
        "name",
        "country",
        "tier",
        "signup_date",
        F.coalesce("total_orders", zero).alias("total_orders"),
        F.coalesce("total_revenue", money_zero).alias("total_revenue"),
        F.coalesce("avg_order_value", F.lit(0.0)).alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
        F.coalesce("completed_orders", zero).alias("completed_orders"),
        F.coalesce("cancelled_orders", zero).alias("cancelled_orders"),
        F.coalesce("days_since_last_order", F.lit(NEVER_ORDERED_DAYS)).alias("days_since_last_order"),
        F.coalesce("annual_revenue_rate", F.lit(0.0)).alias("annual_revenue_rate"),
        F.coalesce(F.round(F.col("annual_revenue_rate") * CLV_YEARS, 2), F.lit(0.0)).alias(
            "predicted_clv_3yr"
        ),
        F.coalesce(F.col("days_since_last_order") > churn_days, F.lit(False)).alias("is_churned"),
    )


def churned_customers(customers: DataFrame) -> DataFrame:
    return customers.filter("is_churned")
