"""Cleaned silver tables and their staging projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.numeric import safe_pct
from tidemart.functions.text import status_from_event


def stg_users(users: DataFrame) -> DataFrame:
    return users.select(F.col("id").alias("user_id"), "email", "name", "signup_date", "country", "tier")


def stg_products(products: DataFrame) -> DataFrame:
    margin = F.col("base_price") - F.col("cost_price")
    return products.select(
        F.col("id").alias("product_id"),
        F.col("name").alias("product_name"),
        "category",
        "subcategory",
        "brand",
        "base_price",
        "cost_price",
        margin.alias("gross_margin"),
        safe_pct(margin, "base_price").alias("margin_pct"),
        "supplier_id",
    )


def stg_transactions(transactions: DataFrame) -> DataFrame:
    """Rename the event time and drop rows that lack a status or an order id.

    A stored order_date is kept as it is, so that filters on it reach the scan.
    """
    day = F.col("order_date") if "order_date" in transactions.columns else F.col("timestamp").cast("date")
    usable = F.col("status").isNotNull() & F.col("order_id").isNotNull()
    rest = [c for c in transactions.columns if c not in ("order_id", "user_id", "timestamp", "order_date")]
    return transactions.filter(usable).select(
        "order_id",
        "user_id",
        F.col("timestamp").alias("order_timestamp"),
        day.alias("order_date"),
        *rest,
    )


def stg_sessions(sessions: DataFrame) -> DataFrame:
    usable = F.col("start_time").isNotNull() & F.col("session_id").isNotNull()
    return sessions.filter(usable).withColumn("session_date", F.col("start_time").cast("date"))


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """Keep the newest row of each key, as an aggregation that combines map-side.

    Rows compare by the ``newest`` columns and then by all others, so the survivor
    is the same in every run.  Copies of one key may be a third of the input; a
    window would gather them in one task, ``max`` leaves one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest]
    kept = df.groupBy(*keys).agg(F.max(F.struct(*newest, *rest)).alias("row"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"row.{c}").alias(c) for c in df.columns])


def flatten_orders(orders: DataFrame) -> DataFrame:
    """Order events with nested items and address as flat transactions.

    A null or empty item list counts as 0 items with no category.
    """
    return orders.select(
        "order_id",
        "user_id",
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        F.col("timestamp").cast("date").alias("order_date"),
        F.col("total_amount").cast("decimal(12,2)").alias("total_amount"),
        F.coalesce(F.size("items"), F.lit(0)).alias("item_count"),
        F.get("items", F.lit(0)).getField("category").alias("primary_category"),
        "payment_method",
        F.coalesce("status", status_from_event("event_type")).alias("status"),
        F.col("shipping_address.country").alias("country"),
        F.col("shipping_address.city").alias("city"),
    )


def silver_transactions(orders: DataFrame) -> DataFrame:
    """Flat transactions, one row per order: the newest event wins."""
    return latest_per_key(flatten_orders(orders), ["order_id"], ["timestamp"])
