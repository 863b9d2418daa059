"""Order totals recomputed from their lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Coupon discount and tax rate.
COUPON_RATE = "0.10"
TAX_RATE = "0.08"


def price_orders(lines: DataFrame, orders: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """Subtotal, coupon discount, tax and total per order, against the stated total.

    lines: order_id, unit_price, quantity, discount_pct (fraction), all decimal or int.
    orders: order_id, coupon_code, stated_total.  Lines are summed map-side before
    the join, so an order with very many lines does not make the join skewed.
    """
    amount = F.col("unit_price") * F.col("quantity") * (F.lit(1) - F.col("discount_pct"))
    subtotals = lines.groupBy("order_id").agg(
        F.round(F.sum(amount.cast("decimal(22,4)")), 2).cast("decimal(18,2)").alias("subtotal")
    )
    zero = F.lit(0).cast("decimal(18,2)")

    def rated(column, rate: str):
        return F.round(column * F.lit(rate).cast("decimal(4,2)"), 2).cast("decimal(18,2)")

    priced = (
        orders.join(subtotals, "order_id", "left")
        .withColumn("subtotal", F.coalesce("subtotal", zero))
        .withColumn(
            "discount_amount",
            F.when(F.col("coupon_code").isNotNull(), rated(F.col("subtotal"), COUPON_RATE)).otherwise(zero),
        )
        .withColumn("tax_amount", rated(F.col("subtotal") - F.col("discount_amount"), TAX_RATE))
        .withColumn(
            "total_amount",
            (F.col("subtotal") - F.col("discount_amount") + F.col("tax_amount")).cast("decimal(18,2)"),
        )
    )
    gap = F.abs(F.col("total_amount") - F.col("stated_total"))
    return priced.withColumn("mismatch", gap > F.lit(tolerance).cast("decimal(6,2)")).select(
        "order_id", "subtotal", "discount_amount", "tax_amount", "total_amount", "stated_total", "mismatch"
    )


def item_lines(orders: DataFrame) -> DataFrame:
    """Lines of order events with nested items, ready for price_orders."""
    return orders.select("order_id", F.explode("items").alias("item")).select(
        "order_id",
        F.col("item.unit_price").cast("decimal(12,2)").alias("unit_price"),
        F.col("item.quantity").alias("quantity"),
        F.col("item.discount_pct").cast("decimal(4,2)").alias("discount_pct"),
    )
