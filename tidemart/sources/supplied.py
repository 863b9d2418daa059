"""The supplied tables as users, products, transactions, clickstream and stock movements.

Attributes the tables lack (coupon, device, city and so on) are derived from the
keys by fixed arithmetic, so that every run sees the same values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.text import padded_key
from tidemart.operators.sessions import assign_sessions
from tidemart.sources.catalog import Tables

# How the order status, the event type and the device are mapped.
ORDER_STATUS = {"F": "delivered", "O": "pending", "P": "cancelled"}
LINE_STATUS = {"F": "completed", "O": "pending", "P": "cancelled"}
EVENT_TYPES = {
    "error": "page_view",
    "view": "product_view",
    "click": "add_to_cart",
    "signup": "checkout_start",
    "purchase": "checkout_complete",
}
DEVICES = ("mobile", "desktop", "tablet")
PAYMENTS = {
    "1-URGENT": "credit_card",
    "2-HIGH": "debit_card",
    "3-MEDIUM": "paypal",
    "4-NOT SPECIFIED": "bank_transfer",
    "5-LOW": "crypto",
}
COUNTRIES = 25
CITIES = 100
WAREHOUSES = 5
SUPPLIERS = 20
SESSION_GAP_SECONDS = 6 * 3600


def recode(column: str, mapping: dict[str, str]) -> Column:
    """Map codes to labels; codes outside the mapping stay as they are."""
    result = F.col(column)
    for code, label in mapping.items():
        result = F.when(F.col(column) == code, F.lit(label)).otherwise(result)
    return result


def _money(column: str, precision: int = 12) -> Column:
    return F.col(column).cast(f"decimal({precision},2)")


def users(t: Tables) -> DataFrame:
    nation = t.nation.select("n_nationkey", F.col("n_name").alias("country"))
    return t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias(
            "email"
        ),
        F.col("c_name").alias("name"),
        F.date_sub(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int")).alias(
            "signup_date"
        ),
        "country",
        F.col("c_mktsegment").alias("tier"),
    )


def products(t: Tables) -> DataFrame:
    price = _money("p_retailprice", 10)
    cost = F.round(price * (F.col("p_size") + 40).cast("decimal(4,0)") * F.expr("0.01BD"), 2)
    return t.part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.concat(F.lit("size-"), F.floor(F.col("p_size") / 10).cast("string")).alias("subcategory"),
        F.col("p_brand").alias("brand"),
        price.alias("base_price"),
        cost.cast("decimal(10,2)").alias("cost_price"),
        padded_key("SUP", F.col("p_partkey") % SUPPLIERS + 1, 3).alias("supplier_id"),
    )


# Line number and part key in one number, so that the first line is a plain minimum.
# The step passes 64 bits, so it is a decimal literal and not a number of the driver's.
_LINE_STEP = "10000000000000000000BD"


def order_contents(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    """Item count and first item's category per order, without building item arrays.

    Lines combine map-side per order; the part lookup then runs on one row per
    order instead of one per line.  The first line is the smallest (number, part),
    taken as one decimal: a hash aggregation, where a struct would sort all lines.
    ``orders`` (order_id) limits the lines before they are aggregated.
    """
    lines = t.lineitem
    if orders is not None:
        lines = lines.join(orders, F.col("l_orderkey") == F.col("order_id"), "left_semi")
    step = F.expr(_LINE_STEP)
    place = (F.col("l_linenumber").cast("decimal(10,0)") * step + F.col("l_partkey").cast("decimal(19,0)")).cast(
        "decimal(38,0)"
    )
    per_order = lines.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("int").alias("item_count"),
        (F.min(place) % step).cast("bigint").alias("first_part"),
    )
    part = t.part.select("p_partkey", F.col("p_type").alias("primary_category"))
    return per_order.join(part, F.col("first_part") == F.col("p_partkey"), "left").select(
        "l_orderkey", "item_count", "primary_category"
    )


def order_headers(t: Tables) -> DataFrame:
    """Transactions without the columns that need the lines; enough for customer metrics."""
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        _money("o_totalprice").alias("total_amount"),
        recode("o_orderpriority", PAYMENTS).alias("payment_method"),
        recode("o_orderstatus", ORDER_STATUS).alias("status"),
        F.concat(F.lit("NATION_"), (F.col("o_orderkey") % COUNTRIES).cast("string")).alias("country"),
        F.concat(F.lit("CITY_"), (F.col("o_orderkey") % CITIES).cast("string")).alias("city"),
    )


def transactions(t: Tables, headers: DataFrame | None = None) -> DataFrame:
    """One row per order, as the silver transactions table.

    ``headers`` are the orders wanted, all by default; only their lines are aggregated.
    """
    contents = order_contents(t, None if headers is None else headers.select("order_id"))
    headers = order_headers(t) if headers is None else headers
    return headers.join(contents, headers.order_id == contents.l_orderkey, "left").select(
        "order_id",
        "user_id",
        "timestamp",
        "order_date",
        "total_amount",
        F.coalesce("item_count", F.lit(0)).alias("item_count"),
        "primary_category",
        "payment_method",
        "status",
        "country",
        "city",
    )


def clickstream(t: Tables) -> DataFrame:
    """Events with the clickstream columns; the session key is added by with_sessions."""
    k = F.get_json_object("props", "$.k").cast("int")
    return t.events.select(
        "event_id",
        "user_id",
        F.col("ts").cast("timestamp").alias("timestamp"),
        recode("event_type", EVENT_TYPES).alias("event_type"),
        k.alias("product_id"),
        F.element_at(
            F.array(*[F.lit(d) for d in DEVICES]), (F.col("event_id") % len(DEVICES) + 1).cast("int")
        ).alias("device_type"),
        F.concat(F.lit("NATION_"), (F.col("event_id") % COUNTRIES).cast("string")).alias("country"),
    )


def clickstream_with_sessions(t: Tables) -> DataFrame:
    return assign_sessions(clickstream(t), gap_seconds=SESSION_GAP_SECONDS)


def movements(t: Tables) -> DataFrame:
    """Order lines as stock movements: returned lines come in, all others go out."""
    quantity = F.col("l_quantity").cast("int")
    return t.lineitem.select(
        F.col("l_partkey").alias("product_id"),
        padded_key("WH", F.col("l_suppkey") % WAREHOUSES + 1, 3).alias("warehouse_id"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        F.when(F.col("l_returnflag") == "R", quantity).otherwise(-quantity).alias("quantity_change"),
    )


# Total order of the movements of one product in one warehouse.  Two lines that
# agree on all of it also agree on the change, so swapping them alters nothing.
MOVEMENT_ORDER = ("timestamp", "l_orderkey", "l_linenumber", "l_suppkey", "quantity_change")

# Orders per chunk of a day: a day on which one product moves very often is cut further.
ORDER_BLOCK = 1_000_000


def movement_chunk() -> list[Column]:
    """Day, then block of order numbers; both follow MOVEMENT_ORDER."""
    return [F.col("timestamp").cast("date"), F.floor(F.col("l_orderkey") / ORDER_BLOCK)]


def line_transactions(t: Tables) -> DataFrame:
    """One row per order line: the line-grain transactions of the alternate gold model."""
    quantity = F.col("l_quantity").cast("int")
    unit_price = (_money("l_extendedprice") / quantity).cast("decimal(10,2)")
    lines = t.lineitem.select(
        F.concat_ws(
            "-", padded_key("TXN-", "l_orderkey", 6), "l_linenumber", "l_partkey", "l_suppkey",
        ).alias("transaction_id"),
        "l_orderkey",
        F.col("l_partkey").alias("product_id"),
        quantity.alias("quantity"),
        unit_price.alias("unit_price"),
    )
    heads = t.orders.select(
        "o_orderkey",
        F.col("o_custkey").alias("user_id"),
        recode("o_orderstatus", LINE_STATUS).alias("status"),
        recode("o_orderpriority", PAYMENTS).alias("payment_method"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )
    return (
        lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
        .drop("l_orderkey", "o_orderkey")
        .withColumn(
            "total_amount",
            (F.col("quantity").cast("decimal(10,0)") * F.col("unit_price")).cast("decimal(12,2)"),
        )
    )


def orders_as_of(t: Tables) -> Column:
    """The day after the last order, as a scalar subquery (nothing runs on the driver)."""
    return t.orders.agg(F.date_add(F.max(F.col("o_orderdate").cast("date")), 1)).scalar()


def events_as_of(t: Tables) -> Column:
    return t.events.agg(F.date_add(F.max(F.col("ts").cast("date")), 1)).scalar()
