"""The table chain from silver to gold, for the default and the alternate model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.columns import AsOf
from tidemart.operators import churn, cohorts, customers, funnel, orders, products, rfm, seed, staging
from tidemart.sources.catalog import publish_table, publish_view


def build_staging(sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Staging views over users, products, transactions and sessions."""
    return {
        "stg_users": staging.stg_users(sources["users"]),
        "stg_products": staging.stg_products(sources["products"]),
        "stg_transactions": staging.stg_transactions(sources["transactions"]),
        "stg_sessions": staging.stg_sessions(sources["sessions"]),
    }


def build_gold(sources: dict[str, DataFrame], as_of: AsOf) -> dict[str, DataFrame]:
    """All gold tables of the default model as one chain of lazy frames."""
    stg = build_staging(sources)
    dim_customers = customers.dim_customers(stg["stg_users"], stg["stg_transactions"], as_of)
    facts = orders.fct_orders(stg["stg_transactions"], dim_customers)
    scores = rfm.agg_rfm_scores(stg["stg_transactions"], as_of)
    return {
        "dim_customers": dim_customers,
        "dim_products": products.dim_products(stg["stg_products"], stg["stg_transactions"]),
        "fct_orders": facts,
        "agg_daily_revenue": orders.agg_daily_revenue(facts),
        "agg_funnel": funnel.agg_funnel(stg["stg_sessions"]),
        "agg_rfm_scores": scores,
        "agg_cohort_retention": cohorts.agg_cohort_retention(stg["stg_transactions"]),
        "agg_churn_features": churn.agg_churn_features(
            dim_customers, scores, stg["stg_sessions"], as_of
        ),
    }


def build_seed(sources: dict[str, DataFrame], as_of: AsOf) -> dict[str, DataFrame]:
    """All gold tables of the line-grain model.

    sources: users, products, transactions (order lines), sessions.
    """
    lines, users, parts = sources["transactions"], sources["users"], sources["products"]
    dim_customers = seed.dim_customers(users, lines, as_of)
    dim_products = seed.dim_products(parts, lines)
    scores = seed.agg_rfm_scores(lines, as_of)
    return {
        "dim_customers": dim_customers,
        "dim_products": dim_products,
        "fct_orders": seed.fct_orders(lines, dim_customers, dim_products, parts),
        "agg_daily_revenue": seed.agg_daily_revenue(lines, parts),
        "agg_rfm_scores": scores,
        "agg_cohort_retention": seed.agg_cohort_retention(lines),
        "agg_funnel": seed.agg_funnel(sources["sessions"]),
        "agg_churn_features": seed.agg_churn_features(dim_customers, scores, as_of),
    }


# Stored order of the report tables.
STORED_ORDER = {
    "agg_daily_revenue": [("order_date", False)],
    "agg_funnel": [("session_date", False)],
    "agg_cohort_retention": [("cohort_month", True), ("period_number", True)],
}


def in_stored_order(name: str, df: DataFrame) -> DataFrame:
    """Report tables sorted as they are read; other tables stay as they are."""
    keys = STORED_ORDER.get(name)
    if not keys:
        return df
    return df.orderBy(*[F.col(c).asc() if up else F.col(c).desc() for c, up in keys])


def publish(sources: dict[str, DataFrame], as_of: AsOf, prefix: str = "") -> list[str]:
    """Register staging as views and write gold as tables; later models read what was written."""
    for name, df in build_staging(sources).items():
        publish_view(df, f"{prefix}{name}")
    spark = sources["users"].sparkSession
    written: list[str] = []

    def table(name: str, df: DataFrame) -> DataFrame:
        publish_table(in_stored_order(name, df), f"{prefix}{name}")
        written.append(f"{prefix}{name}")
        return spark.table(f"{prefix}{name}").drop("built_at")

    def view(name: str) -> DataFrame:
        return spark.table(f"{prefix}{name}")

    dims = table(
        "dim_customers",
        customers.dim_customers(view("stg_users"), view("stg_transactions"), as_of),
    )
    table("dim_products", products.dim_products(view("stg_products"), view("stg_transactions")))
    facts = table("fct_orders", orders.fct_orders(view("stg_transactions"), dims))
    table("agg_daily_revenue", orders.agg_daily_revenue(facts))
    table("agg_funnel", funnel.agg_funnel(view("stg_sessions")))
    scores = table("agg_rfm_scores", rfm.agg_rfm_scores(facts, as_of))
    table("agg_cohort_retention", cohorts.agg_cohort_retention(facts))
    table(
        "agg_churn_features", churn.agg_churn_features(dims, scores, view("stg_sessions"), as_of)
    )
    return written
