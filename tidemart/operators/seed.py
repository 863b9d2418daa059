"""Alternate gold model at order-line grain.

It differs from the default model on purpose: tiers come from spend, ABC classes
compare a product with revenue percentiles, cohorts use completed lines only,
and the recency tile gives 1 to the most recent customers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.calendar import day_start, month_start, months_apart, whole_days
from tidemart.functions.columns import AsOf, with_one_row
from tidemart.functions.numeric import ratio, safe_pct
from tidemart.operators.cohorts import LAST_PERIOD, user_months
from tidemart.operators.ranking import exact_quantiles, with_global_ntiles
from tidemart.operators.rfm import TILES, first_match

# Spend limits of the tiers, ABC percentiles, defaults of missing features.
TIERS = ((1000, "Platinum"), (400, "Gold"), (100, "Silver"))
LOWEST_TIER = "Bronze"
CLASS_A_QUANTILE = 0.80
CLASS_B_QUANTILE = 0.50
CHURN_DAYS = 90
MISSING_DAYS = 999
MISSING_SCORE = 1

_ZERO = "CAST(0 AS DECIMAL(22,2))"


def completed(transactions: DataFrame) -> DataFrame:
    return transactions.filter(F.col("status") == "completed")


def dim_customers(users: DataFrame, transactions: DataFrame, as_of: AsOf) -> DataFrame:
    """Users with completed-order count, lifetime value, spend tier and churn flag."""
    spend = completed(transactions).groupBy("user_id").agg(
        F.count("transaction_id").alias("orders"),
        F.sum("total_amount").alias("spent"),
        F.max("created_at").alias("last_order_date"),
    )
    value = F.coalesce("spent", F.expr(_ZERO))
    tier = first_match([(value > limit, name) for limit, name in TIERS], LOWEST_TIER)
    stale = F.col("last_order_date") < F.date_sub(day_start(as_of).cast("date"), CHURN_DAYS).cast("timestamp")
    return users.join(spend, users["id"] == spend["user_id"], "left").select(
        F.col("id").alias("user_id"),
        "email",
        "name",
        "signup_date",
        "country",
        F.coalesce("orders", F.lit(0)).alias("total_orders"),
        value.cast("decimal(22,2)").alias("lifetime_value"),
        "last_order_date",
        tier.alias("tier"),
        F.coalesce(stale, F.lit(False)).alias("is_churned"),
    )


def dim_products(products: DataFrame, transactions: DataFrame) -> DataFrame:
    """Products with completed sales, classed against revenue percentiles over all products."""
    sales = completed(transactions).groupBy("product_id").agg(
        F.count("transaction_id").alias("orders"), F.sum("total_amount").alias("revenue")
    )
    priced = products.join(sales, products["id"] == sales["product_id"], "left").select(
        F.col("id").alias("product_id"),
        "name",
        "category",
        "subcategory",
        "base_price",
        "cost_price",
        F.coalesce("orders", F.lit(0)).alias("total_orders"),
        F.coalesce("revenue", F.expr(_ZERO)).cast("decimal(22,2)").alias("total_revenue"),
    )
    limits = exact_quantiles(
        priced, "total_revenue", {"a_limit": CLASS_A_QUANTILE, "b_limit": CLASS_B_QUANTILE}
    )
    revenue = F.col("total_revenue").cast("double")
    return (
        with_one_row(priced, limits)
        .withColumn(
            "abc_class",
            F.when(revenue > F.col("a_limit"), "A").when(revenue > F.col("b_limit"), "B").otherwise("C"),
        )
        .drop("a_limit", "b_limit")
    )


def fct_orders(
    transactions: DataFrame, customers: DataFrame, product_dim: DataFrame, products: DataFrame
) -> DataFrame:
    """Order lines of known customers and products with category and tier."""
    tiers = customers.select("user_id", F.col("tier").alias("customer_tier"))
    known = product_dim.select("product_id")
    labels = products.select(F.col("id").alias("product_id"), "category", "subcategory")
    return (
        transactions.join(tiers, "user_id")
        .join(known, "product_id")
        .join(labels, "product_id")
        .select(
            "transaction_id", "user_id", "product_id", "category", "subcategory", "quantity",
            "unit_price", "total_amount", "status", "payment_method", "created_at", "customer_tier",
        )
    )


def agg_daily_revenue(transactions: DataFrame, products: DataFrame) -> DataFrame:
    """Completed lines per day and category.

    Lines are reduced per (day, category, user) first, so the distinct customer
    count is a plain count.
    """
    labels = products.select(F.col("id").alias("product_id"), "category")
    per_user = (
        completed(transactions)
        .join(labels, "product_id")
        .groupBy(F.col("created_at").cast("date").alias("revenue_date"), "category", "user_id")
        .agg(F.count("transaction_id").alias("n"), F.sum("total_amount").alias("amount"))
    )
    amount = F.sum("amount")
    return per_user.groupBy("revenue_date", "category").agg(
        F.sum("n").alias("total_orders"),
        amount.cast("decimal(22,2)").alias("total_revenue"),
        ratio(amount, F.sum("n")).alias("avg_order_value"),
        F.count("user_id").alias("unique_customers"),
    )


def agg_rfm_scores(transactions: DataFrame, as_of: AsOf) -> DataFrame:
    """RFM over completed lines; r_score 1 means most recent here."""
    raw = completed(transactions).groupBy("user_id").agg(
        F.max("created_at").alias("last_purchase"),
        F.count("transaction_id").alias("frequency"),
        F.sum("total_amount").cast("decimal(22,2)").alias("monetary"),
    ).withColumn("recency_days", whole_days(day_start(as_of), "last_purchase"))
    scored = with_global_ntiles(
        raw,
        "user_id",
        {
            "r_score": -F.unix_micros("last_purchase"),
            "f_score": F.col("frequency"),
            "m_score": F.col("monetary"),
        },
        TILES,
    )
    r, f = F.col("r_score"), F.col("f_score")
    # Segment names and score thresholds of this variant.
    segment = first_match(
        [
            ((r >= 4) & (f >= 4), "Champions"),
            ((r >= 3) & (f >= 3), "Loyal Customers"),
            ((r >= 4) & (f <= 2), "Recent Customers"),
            ((r <= 2) & (f >= 3), "At Risk"),
            ((r <= 2) & (f <= 2), "Lost"),
        ],
        "Potential Loyalists",
    )
    return scored.select(
        "user_id", "recency_days", "frequency", "monetary", "r_score", "f_score", "m_score",
        (r + f + F.col("m_score")).alias("rfm_total"),
        segment.alias("rfm_segment"),
    )


def agg_cohort_retention(transactions: DataFrame, last_period: int = LAST_PERIOD) -> DataFrame:
    """Retained users per cohort month and months since the first completed line.

    A cohort's size is its active users in month 0: everyone in it ordered then.
    """
    months = user_months(completed(transactions), "created_at").withColumn(
        "months_since_first", months_apart("active_month", "cohort_month")
    )
    counts = (
        months.filter(F.col("months_since_first").between(0, last_period))
        .groupBy("cohort_month", "months_since_first")
        .agg(F.count("user_id").alias("retained_users"))
    )
    sizes = counts.filter("months_since_first = 0").select(
        "cohort_month", F.col("retained_users").alias("cohort_size")
    )
    return counts.join(sizes, "cohort_month")


def agg_funnel(sessions: DataFrame) -> DataFrame:
    """Sums of the step counters per day; sessions need start_time and the step counters."""
    daily = sessions.groupBy(F.col("start_time").cast("date").alias("funnel_date")).agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.sum("products_viewed").alias("product_views"),
        F.sum("add_to_cart_count").alias("add_to_carts"),
        F.sum("checkout_initiated").alias("checkouts"),
        F.sum("purchased").alias("purchases"),
    )
    return daily.withColumn("conversion_rate", safe_pct("purchases", "total_sessions"))


def agg_churn_features(customers: DataFrame, scores: DataFrame, as_of: AsOf) -> DataFrame:
    days = whole_days(day_start(as_of), "last_order_date")
    return customers.join(scores, "user_id", "left").select(
        "user_id",
        "total_orders",
        "lifetime_value",
        F.coalesce(days, F.lit(MISSING_DAYS)).alias("days_since_last_order"),
        F.coalesce("recency_days", F.lit(MISSING_DAYS)).alias("recency_days"),
        F.coalesce("frequency", F.lit(0)).alias("frequency"),
        F.coalesce("monetary", F.expr(_ZERO)).cast("decimal(22,2)").alias("monetary"),
        *[F.coalesce(c, F.lit(MISSING_SCORE)).alias(c) for c in ("r_score", "f_score", "m_score")],
        "tier",
        F.col("is_churned").cast("int").alias("label"),
    )


def build_summary(
    customers: DataFrame, scores: DataFrame, daily_revenue: DataFrame, funnel: DataFrame
) -> DataFrame:
    """One row with the sizes of four gold tables, as scalar subqueries."""

    def rows(df: DataFrame) -> F.Column:
        return df.agg(F.count(F.lit(1))).scalar()

    spark = customers.sparkSession
    return spark.range(1).select(
        F.lit("ALL DONE").alias("status"),
        rows(customers).alias("customers"),
        rows(scores).alias("rfm_rows"),
        rows(daily_revenue).alias("daily_rev_rows"),
        rows(funnel).alias("funnel_rows"),
    )
