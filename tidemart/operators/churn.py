"""Churn features, rule-based scores and the at-risk list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.columns import AsOf, as_day
from tidemart.functions.numeric import ratio, safe_pct

# The model's feature columns, in order.
FEATURES = (
    "days_since_last_order",
    "total_orders",
    "total_revenue",
    "avg_order_value",
    "cancellation_rate",
    "r_score",
    "f_score",
    "m_score",
    "rfm_total",
    "avg_session_duration",
    "avg_products_viewed",
    "total_sessions_30d",
)
# The label is "more than 90 days since the last order"; these columns restate it.
LEAKING_FEATURES = ("days_since_last_order", "r_score", "rfm_total")

# Scoring thresholds.
CHURN_DAYS = 90
RISK_THRESHOLD = 0.60
RULE_PROBABILITY = 0.85
AT_RISK_PROBABILITY = 0.90
AT_RISK_LIMIT = 20
RECENT_SESSION_DAYS = 30


def session_stats(sessions: DataFrame, as_of: AsOf, days: int = RECENT_SESSION_DAYS) -> DataFrame:
    """Per user: mean session length, mean products viewed, recent sessions."""
    recent = F.col("session_date") >= F.date_sub(as_day(as_of), days)
    return sessions.groupBy("user_id").agg(
        ratio(F.sum("duration_seconds"), F.count("duration_seconds")).alias("avg_session_duration"),
        ratio(F.sum("products_viewed"), F.count("products_viewed")).alias("avg_products_viewed"),
        F.count_if(recent).alias("total_sessions_30d"),
    )


def agg_churn_features(
    customers: DataFrame, scores: DataFrame, sessions: DataFrame, as_of: AsOf
) -> DataFrame:
    """Twelve features and the churn label for every user with an order.

    All three inputs have one row per user, so both joins are one-to-one.
    """
    active = customers.filter(F.col("total_orders") > 0)
    rfm = scores.select("user_id", "r_score", "f_score", "m_score", "rfm_total", "rfm_segment")
    joined = active.join(rfm, "user_id", "left").join(
        session_stats(sessions, as_of), "user_id", "left"
    )
    return joined.select(
        "user_id",
        "days_since_last_order",
        "total_orders",
        "total_revenue",
        "avg_order_value",
        safe_pct("cancelled_orders", "total_orders").alias("cancellation_rate"),
        "r_score",
        "f_score",
        "m_score",
        "rfm_total",
        "rfm_segment",
        F.coalesce("avg_session_duration", F.lit(0.0)).alias("avg_session_duration"),
        F.coalesce("avg_products_viewed", F.lit(0.0)).alias("avg_products_viewed"),
        F.coalesce("total_sessions_30d", F.lit(0)).alias("total_sessions_30d"),
        F.col("is_churned").alias("label"),
    )


def rule_probability(days: Column, churn_days: int = CHURN_DAYS) -> Column:
    """Score used while no model is available."""
    return F.when(days > churn_days, F.lit(RULE_PROBABILITY)).otherwise(F.lit(0.0))


def risk_response(features: DataFrame, probability: Column, threshold: float = RISK_THRESHOLD) -> DataFrame:
    return features.withColumn("__p", probability).select(
        "user_id",
        F.round("__p", 4).alias("churn_probability"),
        (F.col("__p") > threshold).alias("is_at_risk"),
        "rfm_segment",
        F.col("days_since_last_order").cast("double").alias("days_since_last_order"),
    )


def churn_rule_scores(features: DataFrame, user_ids: DataFrame | None = None) -> DataFrame:
    """Rule-based scores for all users, or for a batch of user ids."""
    if user_ids is not None:
        features = features.join(user_ids.select("user_id").distinct(), "user_id")
    return risk_response(features, rule_probability(F.col("days_since_last_order")))


def at_risk_customers(
    features: DataFrame, customers: DataFrame, limit: int = AT_RISK_LIMIT
) -> DataFrame:
    """The churned customers who have been away longest (top-k report)."""
    churned = customers.filter("is_churned").select("user_id")
    listed = features.join(churned, "user_id").withColumn(
        "churn_probability", F.lit(AT_RISK_PROBABILITY)
    )
    return (
        listed.orderBy(F.desc("days_since_last_order"), F.asc("user_id"))
        .limit(limit)
        .select(
            "user_id",
            "churn_probability",
            F.lit(True).alias("is_at_risk"),
            "rfm_segment",
            F.col("days_since_last_order").cast("double").alias("days_since_last_order"),
        )
    )
