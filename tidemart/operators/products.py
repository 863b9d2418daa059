"""Product dimension with ABC classes by category revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.functions.numeric import ratio

CLASS_A_SHARE = 0.80
CLASS_B_SHARE = 0.95


def category_sales(orders: DataFrame) -> DataFrame:
    """Delivered orders and revenue per category."""
    return (
        orders.filter(F.col("status") == "delivered")
        .groupBy("primary_category")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum("total_amount").cast("decimal(22,2)").alias("total_revenue"),
        )
    )


def category_pareto(
    sales: DataFrame, a_share: float = CLASS_A_SHARE, b_share: float = CLASS_B_SHARE
) -> DataFrame:
    """Running revenue share per category, largest first, and its ABC class.

    The windows run over one row per category, a contract enumeration.
    """
    best_first = W.orderBy(F.desc_nulls_last("total_revenue"), F.asc_nulls_last("primary_category"))
    running = F.sum("total_revenue").over(best_first.rowsBetween(W.unboundedPreceding, W.currentRow))
    total = F.sum("total_revenue").over(W.partitionBy())
    share = ratio(F.col("running_total"), F.col("grand_total"))
    return (
        sales.withColumn("running_total", running.cast("decimal(28,2)"))
        .withColumn("grand_total", total.cast("decimal(28,2)"))
        .withColumn(
            "abc_class",
            F.when(share <= a_share, "A").when(share <= b_share, "B").otherwise("C"),
        )
    )


def dim_products(
    products: DataFrame,
    orders: DataFrame,
    a_share: float = CLASS_A_SHARE,
    b_share: float = CLASS_B_SHARE,
) -> DataFrame:
    """All products with the sales and class of their category; unsold categories are C."""
    ranked = category_pareto(category_sales(orders), a_share, b_share).select(
        "primary_category", "order_count", "total_revenue", "abc_class"
    )
    joined = products.join(ranked, F.col("category") == F.col("primary_category"), "left")
    return joined.select(
        *products.columns,
        F.coalesce("abc_class", F.lit("C")).alias("abc_class"),
        F.coalesce("order_count", F.lit(0)).alias("total_orders"),
        F.coalesce("total_revenue", F.lit(0).cast("decimal(22,2)")).alias("total_revenue"),
    )
