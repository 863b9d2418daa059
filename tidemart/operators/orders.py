"""Order fact table and daily revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.calendar import month_start, week_start
from tidemart.functions.numeric import ratio, safe_pct


def fct_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with the customer's tier and churn flag.

    Every order placed on the day of the user's first order counts as a first
    order.  Orders of unknown users stay, without customer attributes.
    """
    known = customers.select(
        "user_id", F.col("tier").alias("customer_tier"), "is_churned", "first_order_date"
    )
    first_day = F.col("first_order_date").cast("date")
    return orders.join(known, "user_id", "left").select(
        "order_id",
        "user_id",
        "order_timestamp",
        "order_date",
        week_start("order_timestamp").alias("order_week"),
        month_start("order_timestamp").alias("order_month"),
        "total_amount",
        "item_count",
        "primary_category",
        "payment_method",
        "status",
        "country",
        "city",
        "customer_tier",
        "is_churned",
        F.coalesce(first_day == F.col("order_date"), F.lit(False)).alias("is_first_order"),
    )


def agg_daily_revenue(facts: DataFrame) -> DataFrame:
    """Revenue KPIs per day and category.

    Rows are reduced to one per (day, category, user, order) and then to one per
    (day, category, user), so the distinct orders and users become plain counts: no
    Expand of the fact rows, a busy day or user is reduced map-side, and an order
    that is stored twice counts once.
    """
    days = ("order_date", "primary_category")
    per_order = facts.groupBy(*days, "user_id", "order_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("total_amount").alias("priced"),
        F.max("is_first_order").alias("is_new"),
        F.sum("total_amount").alias("gross"),
        F.sum(F.when(F.col("status") == "delivered", F.col("total_amount"))).alias("net"),
        F.count_if(F.col("status") == "cancelled").alias("cancelled"),
    )
    per_user = per_order.groupBy(*days, "user_id").agg(
        F.count("order_id").alias("orders"),
        F.max("is_new").alias("is_new"),
        *[F.sum(c).alias(c) for c in ("rows", "priced", "gross", "net", "cancelled")],
    )
    return per_user.groupBy(*days).agg(
        F.sum("orders").alias("total_orders"),
        F.count("user_id").alias("unique_customers"),
        F.count(F.when(F.col("is_new"), F.col("user_id"))).alias("new_customers"),
        F.sum("gross").cast("decimal(22,2)").alias("gross_revenue"),
        F.sum("net").cast("decimal(22,2)").alias("net_revenue"),
        ratio(F.sum("gross"), F.sum("priced")).alias("avg_order_value"),
        safe_pct(F.sum("cancelled"), F.sum("rows")).alias("cancellation_rate_pct"),
    )


def latest_order_day(facts: DataFrame) -> DataFrame:
    """Newest order date; is_ready is false when there are no orders at all."""
    return facts.agg(F.max("order_date").alias("latest_order_date")).withColumn(
        "is_ready", F.col("latest_order_date").isNotNull()
    )
