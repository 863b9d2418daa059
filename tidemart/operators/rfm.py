"""Recency, frequency, monetary scores and segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.columns import AsOf, as_day, with_one_row
from tidemart.functions.numeric import safe_pct
from tidemart.operators.ranking import with_global_ntiles

TILES = 5


def rfm_raw(orders: DataFrame, as_of: AsOf) -> DataFrame:
    """Per user: last order, days since, orders, delivered revenue (null when none).

    Reads staging orders rather than the fact: the fact keeps every order row,
    so the numbers agree and the customer join is not needed.  One distinct count
    is two map-side-combined steps, by (user, order) and by user.
    """
    return orders.groupBy("user_id").agg(
        F.max("order_date").alias("last_order_date"),
        F.datediff(as_day(as_of), F.max("order_date")).alias("recency_days"),
        F.count_distinct("order_id").alias("frequency"),
        F.sum(F.when(F.col("status") == "delivered", F.col("total_amount"))).alias("monetary"),
    )


def segment_column() -> F.Column:
    """First matching rule wins; the order of the rules is part of their meaning."""
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    # Segment names and score thresholds.
    rules = [
        ((r >= 4) & (f >= 4) & (m >= 4), "Champions"),
        ((r >= 3) & (f >= 3) & (m >= 3), "Loyal Customers"),
        ((r >= 4) & (f <= 2), "Recent Customers"),
        ((r >= 3) & (m >= 4), "Potential Loyalists"),
        ((r <= 2) & (f >= 3) & (m >= 3), "At Risk"),
        ((r <= 2) & (f >= 2), "Cannot Lose Them"),
        ((r <= 2) & (f <= 2) & (m <= 2), "Lost"),
    ]
    return first_match(rules, "Hibernating")


def first_match(rules, default: str):
    chosen = F.lit(default)
    for condition, label in reversed(rules):
        chosen = F.when(condition, F.lit(label)).otherwise(chosen)
    return chosen


def agg_rfm_scores(orders: DataFrame, as_of: AsOf, null_monetary: str = "zero") -> DataFrame:
    """RFM scores and segment per user; ties are ordered by user id.

    ``null_monetary`` places users without delivered revenue: "zero" ranks them
    lowest, "last" ranks them above everybody, as a plain ascending sort with
    nulls last does.
    """
    raw = rfm_raw(orders, as_of)
    if null_monetary == "zero":
        spend = F.coalesce("monetary", F.lit(0).cast("decimal(22,2)"))
    elif null_monetary == "last":
        spend = F.col("monetary")
    else:
        raise ValueError("null_monetary is 'zero' or 'last'")
    scored = with_global_ntiles(
        raw,
        "user_id",
        {"r_score": -F.col("recency_days"), "f_score": F.col("frequency"), "m_score": spend},
        TILES,
    )
    return scored.select(
        "user_id",
        "last_order_date",
        "recency_days",
        "frequency",
        F.coalesce("monetary", F.lit(0)).cast("decimal(22,2)").alias("monetary"),
        "r_score",
        "f_score",
        "m_score",
        (F.col("r_score") + F.col("f_score") + F.col("m_score")).alias("rfm_total"),
        segment_column().alias("rfm_segment"),
    )


def with_tier(scores: DataFrame, customers: DataFrame) -> DataFrame:
    return scores.join(customers.select("user_id", "tier"), "user_id")


def segment_summary(scores: DataFrame) -> DataFrame:
    """Customers, their share, and revenue per segment."""
    per_segment = scores.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("monetary").cast("decimal(28,2)").alias("revenue")
    )
    everyone = per_segment.agg(F.sum("customers").alias("all_customers"))
    return (
        with_one_row(per_segment, everyone)
        .withColumn("customer_pct", safe_pct("customers", "all_customers"))
        .drop("all_customers")
    )


def segments_for(scores: DataFrame, user_ids: DataFrame) -> DataFrame:
    """Segment and scores for a batch of user ids."""
    wanted = user_ids.select("user_id").distinct()
    return scores.join(wanted, "user_id").select(
        "user_id", "rfm_segment", "r_score", "f_score", "m_score", "monetary"
    )
