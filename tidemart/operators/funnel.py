"""Daily conversion funnel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.numeric import safe_pct


def agg_funnel(sessions: DataFrame) -> DataFrame:
    """Sessions per step and step-to-step rates by day.

    Rows are reduced to one per (day, session) first, map-side, so a session that is
    stored twice counts once and the distinct counts need no Expand.
    """
    steps = ("page_views", "products_viewed", "add_to_cart_count")
    unique = sessions.groupBy("session_date", "session_id").agg(
        *[F.max(F.col(c) > 0).alias(c) for c in steps], F.max("converted").alias("converted")
    )
    known = F.col("session_id").isNotNull()
    daily = unique.groupBy("session_date").agg(
        F.count("session_id").alias("total_sessions"),
        F.count_if(known & F.col("page_views")).alias("page_view_sessions"),
        F.count_if(known & F.col("products_viewed")).alias("product_view_sessions"),
        F.count_if(known & F.col("add_to_cart_count")).alias("add_to_cart_sessions"),
        F.count_if(known & F.col("converted")).alias("converted_sessions"),
    )
    return daily.select(
        "*",
        safe_pct("product_view_sessions", "total_sessions").alias("product_view_rate"),
        safe_pct("add_to_cart_sessions", "product_view_sessions").alias("cart_rate"),
        safe_pct("converted_sessions", "add_to_cart_sessions").alias("checkout_conversion_rate"),
        safe_pct("converted_sessions", "total_sessions").alias("overall_conversion_rate"),
    )
