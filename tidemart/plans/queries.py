"""Every registered query: a function of (session, table folder) returning a frame."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.text import month_label, product_url, sku, status_from_event, uuid_text
from tidemart.operators import (
    churn, clustering, cohorts, contracts, customers, demand, drift, experiments, funnel,
    histogram, inventory, kpis, models, orders, pricing, products, quality, ranking, rfm, seed, staging,
)
from tidemart.operators import sessions as session_ops
from tidemart.plans import silver
from tidemart.plans.gold import build_gold
from tidemart.session import configure, cut_lineage, fresh_dir
from tidemart.sources import catalog, sinks, supplied
from tidemart.sources.catalog import Tables
from tidemart.streaming import compaction, ingest, late, quarantine, stateful
from tidemart import schemas

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
AVAILABLE_NOW = {"availableNow": True}
# Wire format of event times; microseconds, as the tables hold them.
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


class Shop:
    """The supplied tables shaped as sources, staging and gold frames, built on demand."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self.tables = Tables(spark, root)

    @cached_property
    def as_of(self) -> Column:
        return supplied.orders_as_of(self.tables)

    @cached_property
    def events_as_of(self) -> Column:
        return supplied.events_as_of(self.tables)

    @cached_property
    def users(self) -> DataFrame:
        return supplied.users(self.tables)

    @cached_property
    def products(self) -> DataFrame:
        return supplied.products(self.tables)

    @cached_property
    def transactions(self) -> DataFrame:
        return supplied.transactions(self.tables)

    @cached_property
    def lines(self) -> DataFrame:
        return supplied.line_transactions(self.tables)

    @cached_property
    def clickstream(self) -> DataFrame:
        return supplied.clickstream(self.tables)

    @cached_property
    def sessions(self) -> DataFrame:
        return session_ops.sessionize_by_gap(self.clickstream, supplied.SESSION_GAP_SECONDS)

    @cached_property
    def stg_users(self) -> DataFrame:
        return staging.stg_users(self.users)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.products)

    @cached_property
    def headers(self) -> DataFrame:
        """Staging orders without the item columns: the lines are not read."""
        return staging.stg_transactions(supplied.order_headers(self.tables))

    @cached_property
    def stg_transactions(self) -> DataFrame:
        return staging.stg_transactions(self.transactions)

    @cached_property
    def stg_sessions(self) -> DataFrame:
        return staging.stg_sessions(self.sessions)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return customers.dim_customers(self.stg_users, self.headers, self.as_of)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return orders.fct_orders(self.stg_transactions, self.dim_customers)

    @cached_property
    def daily_revenue(self) -> DataFrame:
        return orders.agg_daily_revenue(self.fct_orders)

    @cached_property
    def daily(self) -> DataFrame:
        return demand.daily_demand(self.daily_revenue)

    @cached_property
    def rfm_scores(self) -> DataFrame:
        return rfm.agg_rfm_scores(self.headers, self.as_of)

    @cached_property
    def retention(self) -> DataFrame:
        return cohorts.agg_cohort_retention(self.headers)

    @cached_property
    def churn_features(self) -> DataFrame:
        return churn.agg_churn_features(
            self.dim_customers, self.rfm_scores, self.stg_sessions, self.events_as_of
        )

    @cached_property
    def feature_table(self) -> DataFrame:
        """The churn features as a stored table, for work that reads them more than once."""
        return cut_lineage(self.churn_features)

    @cached_property
    def ledger(self) -> DataFrame:
        return inventory.stock_ledger(
            supplied.movements(self.tables),
            supplied.MOVEMENT_ORDER,
            chunk=supplied.movement_chunk(),
        )

    @cached_property
    def assigned(self) -> DataFrame:
        return experiments.assign_groups(self.stg_sessions, self.events_as_of)

    @cached_property
    def sources(self) -> dict[str, DataFrame]:
        return {
            "users": self.users,
            "products": self.products,
            "transactions": self.transactions,
            "sessions": self.sessions,
        }

    @cached_property
    def gold(self) -> dict[str, DataFrame]:
        return build_gold(self.sources, self.as_of)

    @cached_property
    def seed_customers(self) -> DataFrame:
        return seed.dim_customers(self.users, self.lines, self.as_of)

    @cached_property
    def seed_products(self) -> DataFrame:
        return seed.dim_products(self.products, self.lines)

    @cached_property
    def seed_scores(self) -> DataFrame:
        return seed.agg_rfm_scores(self.lines, self.as_of)

    @cached_property
    def seed_daily(self) -> DataFrame:
        return seed.agg_daily_revenue(self.lines, self.products)

    @cached_property
    def seed_funnel(self) -> DataFrame:
        return seed.agg_funnel(self.sessions)


def query(build: Callable[[Shop], DataFrame]) -> Callable[[Shop], DataFrame]:
    """Register a builder under its function name."""

    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Shop(configure(spark), sf_dir))

    QUERIES[build.__name__] = run
    return build


# --- sources and staging -------------------------------------------------------------


@query
def bronze_presence(s: Shop) -> DataFrame:
    names = ("orders", "events", "lineitem")
    return catalog.presence({n: s.tables[n] for n in names})


@query
def bronze_freshness(s: Shop) -> DataFrame:
    """From the listing of the tables' files, none of which is opened."""
    return catalog.listed_freshness(s.spark, {n: f"{s.root}/{n}.parquet" for n in ("orders", "events", "lineitem")})


@query
def stg_users(s: Shop) -> DataFrame:
    return s.stg_users


@query
def stg_products(s: Shop) -> DataFrame:
    return s.stg_products


@query
def stg_transactions(s: Shop) -> DataFrame:
    return s.stg_transactions


@query
def stg_sessions(s: Shop) -> DataFrame:
    return s.stg_sessions


def order_event_json(s: Shop) -> DataFrame:
    """One JSON order event per order line, and one without items per order without lines.

    Events of one order share its id, as status updates do, so the silver job has
    copies to remove.
    """
    t = s.tables
    part = t.part.select("p_partkey", "p_name", "p_type")
    quantity = F.col("l_quantity").cast("int")
    line = t.lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    joined = t.orders.join(line, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    item = F.struct(
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        quantity.alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("unit_price"),
        F.col("l_discount").cast("decimal(4,2)").alias("discount_pct"),
    )
    has_line = F.col("l_orderkey").isNotNull()
    status = supplied.recode("o_orderstatus", supplied.ORDER_STATUS)
    moment = F.coalesce("l_shipdate", "o_orderdate").cast("timestamp")
    event = F.struct(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.concat(F.lit("order_"), status).alias("event_type"),
        F.date_format(moment, EVENT_TIME_FORMAT).alias("timestamp"),
        F.when(has_line, F.array(item)).otherwise(F.array().cast("array<struct<product_id:string,product_name:string,category:string,quantity:int,unit_price:decimal(12,2),discount_pct:decimal(4,2)>>")).alias("items"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
        supplied.recode("o_orderpriority", supplied.PAYMENTS).alias("payment_method"),
        F.struct(
            F.concat(F.lit("NATION_"), (F.col("o_orderkey") % supplied.COUNTRIES).cast("string")).alias("country"),
            F.concat(F.lit("CITY_"), (F.coalesce("l_suppkey", F.lit(0)) % supplied.CITIES).cast("string")).alias("city"),
        ).alias("shipping_address"),
    )
    return joined.select(F.to_json(event).alias("value"), moment.alias("timestamp"))


@query
def order_events_flat(s: Shop) -> DataFrame:
    """JSON order events parsed against the bronze schema and flattened, one row per event."""
    bronze = ingest.parse_and_enrich(order_event_json(s), schemas.ORDERS)
    return staging.flatten_orders(bronze)


@query
def silver_transactions_latest(s: Shop) -> DataFrame:
    """The same events reduced to the newest one per order."""
    bronze = ingest.parse_and_enrich(order_event_json(s), schemas.ORDERS)
    return staging.silver_transactions(bronze)


def nested_order_json(s: Shop) -> DataFrame:
    """One JSON order event per order, with all its lines as nested items.

    An order has a bounded number of lines, so its items fit a row.
    """
    t = s.tables
    part = t.part.select("p_partkey", F.col("p_type").alias("category"))
    item = F.struct(
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        F.col("l_partkey").cast("string").alias("product_id"),
        "category",
        F.lit(1).alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("unit_price"),
        F.col("l_discount").cast("decimal(4,2)").alias("discount_pct"),
    )
    lines = (
        t.lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        .groupBy("l_orderkey")
        .agg(F.sort_array(F.collect_list(item)).alias("items"))
    )
    wire = F.transform("items", lambda x: F.struct(*[x[c] for c in ("product_id", "category", "quantity", "unit_price", "discount_pct")]))
    event = F.struct(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.lit("order_created").alias("event_type"),
        F.date_format(F.col("o_orderdate").cast("timestamp"), EVENT_TIME_FORMAT).alias("timestamp"),
        wire.alias("items"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
    )
    orders_with_lines = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return orders_with_lines.select(
        F.to_json(event).alias("value"), F.col("o_orderdate").cast("timestamp").alias("timestamp")
    )


@query
def order_events_nested(s: Shop) -> DataFrame:
    """Orders with several items: their number, and the first item's category."""
    bronze = ingest.parse_and_enrich(nested_order_json(s), schemas.ORDERS)
    return staging.flatten_orders(bronze).select(
        "order_id", "user_id", "timestamp", "total_amount", "item_count", "primary_category"
    )


@query
def order_pricing_from_items(s: Shop) -> DataFrame:
    """Totals of the nested events, recomputed from their items."""
    bronze = ingest.parse_and_enrich(nested_order_json(s), schemas.ORDERS)
    heads = bronze.select(
        "order_id",
        F.when(F.col("order_id").cast("bigint") % 2 == 0, F.lit("SAVE10")).alias("coupon_code"),
        F.col("total_amount").cast("decimal(12,2)").alias("stated_total"),
    )
    return pricing.price_orders(pricing.item_lines(bronze), heads)


@query
def order_status_from_event(s: Shop) -> DataFrame:
    kind = F.concat(F.lit("order_"), supplied.recode("o_orderstatus", supplied.ORDER_STATUS))
    return s.tables.orders.groupBy(kind.alias("event_type")).agg(
        F.count(F.lit(1)).alias("orders")
    ).select("event_type", status_from_event("event_type").alias("status"), "orders")


@query
def product_labels(s: Shop) -> DataFrame:
    """SKU and page address of every product."""
    return s.products.select(
        F.col("id").alias("product_id"),
        sku("id").alias("sku"),
        product_url("https://shop.example", "category", "id").alias("page_url"),
    )


@query
def silver_append_idempotent(s: Shop) -> DataFrame:
    """Transactions appended twice to one table; the second run must add nothing."""
    path = fresh_dir(s.spark, "append")
    rows = supplied.order_headers(s.tables)
    first = sinks.append_new(rows, path, ["order_id"])
    second = sinks.append_new(rows, path, ["order_id"])
    stored = s.spark.read.parquet(path)
    return stored.agg(
        F.count(F.lit(1)).alias("stored_rows"),
        F.sum("total_amount").cast("decimal(22,2)").alias("stored_amount"),
    ).select(
        F.lit(first).cast("bigint").alias("first_run"),
        F.lit(second).cast("bigint").alias("second_run"),
        "stored_rows",
        "stored_amount",
    )


@query
def silver_build_report(s: Shop) -> DataFrame:
    """The three silver tables written twice from bronze events; rows per table afterwards."""
    t = s.tables
    ledger = s.ledger.withColumn(
        "inventory_id",
        F.concat_ws("-", *[F.lpad(F.col(c).cast("string"), 20, "0") for c in ("l_orderkey", "l_linenumber")], "l_suppkey"),
    )
    bronze = {
        "orders": ingest.parse_and_enrich(order_event_json(s), schemas.ORDERS),
        "clickstream": supplied.clickstream_with_sessions(t),
        "inventory": ledger,
    }
    root = fresh_dir(s.spark, "silver")
    tables = silver.build_silver(bronze)
    first = silver.write_silver(tables, root)
    second = silver.write_silver(tables, root)
    stored = catalog.row_counts({n: catalog.read_table(s.spark, f"{root}/{n}") for n in tables})
    written = [(n, first[n], second[n]) for n in tables]
    return stored.join(
        s.spark.createDataFrame(written, "table_name string, first_run bigint, second_run bigint"),
        "table_name",
    )


# --- sessions and funnel --------------------------------------------------------------


@query
def sessions_by_gap(s: Shop) -> DataFrame:
    return s.sessions


@query
def sessions_by_id(s: Shop) -> DataFrame:
    return session_ops.sessionize(supplied.clickstream_with_sessions(s.tables))


@query
def silver_sessions_unique(s: Shop) -> DataFrame:
    """Sessions by id where ids are shared: each spans several users and still is one row."""
    shared = F.concat(F.lit("S"), F.col("event_id") % 500)
    return session_ops.sessionize(s.clickstream.withColumn("session_id", shared))


@query
def agg_funnel(s: Shop) -> DataFrame:
    return funnel.agg_funnel(s.stg_sessions)


@query
def funnel_furthest_step(s: Shop) -> DataFrame:
    return session_ops.funnel_progress(supplied.clickstream_with_sessions(s.tables))


@query
def funnel_step_reach(s: Shop) -> DataFrame:
    return session_ops.funnel_steps(supplied.clickstream_with_sessions(s.tables))


# --- gold, default model --------------------------------------------------------------


@query
def dim_customers(s: Shop) -> DataFrame:
    return s.dim_customers


@query
def churned_customers(s: Shop) -> DataFrame:
    return customers.churned_customers(s.dim_customers).select("user_id", "tier", "last_order_date")


@query
def category_pareto(s: Shop) -> DataFrame:
    return products.category_pareto(products.category_sales(s.stg_transactions))


@query
def dim_products_abc(s: Shop) -> DataFrame:
    return products.dim_products(s.stg_products, s.stg_transactions)


@query
def fct_orders(s: Shop) -> DataFrame:
    return s.fct_orders


@query
def agg_daily_revenue(s: Shop) -> DataFrame:
    return s.daily_revenue


@query
def agg_rfm_scores(s: Shop) -> DataFrame:
    return s.rfm_scores


@query
def agg_rfm_scores_nulls_last(s: Shop) -> DataFrame:
    return rfm.agg_rfm_scores(s.headers, s.as_of, null_monetary="last")


@query
def rfm_with_tier(s: Shop) -> DataFrame:
    return rfm.with_tier(s.rfm_scores, s.dim_customers)


@query
def rfm_segment_summary(s: Shop) -> DataFrame:
    return rfm.segment_summary(s.rfm_scores)


@query
def segment_lookup(s: Shop) -> DataFrame:
    """Segments for a batch of ids: the users seen in the clickstream."""
    return rfm.segments_for(s.rfm_scores, s.tables.events.select("user_id"))


@query
def cohort_retention_calendar(s: Shop) -> DataFrame:
    return s.retention


@query
def cohort_retention_30day(s: Shop) -> DataFrame:
    return cohorts.agg_cohort_retention(s.headers, period="30day")


@query
def cohort_matrix(s: Shop) -> DataFrame:
    return cohorts.cohort_matrix(s.retention)


@query
def retention_curve(s: Shop) -> DataFrame:
    return cohorts.retention_curve(s.retention)


@query
def agg_churn_features(s: Shop) -> DataFrame:
    return s.churn_features


@query
def churn_rule_scores(s: Shop) -> DataFrame:
    """Rule scores for a batch of ids: the users seen in the clickstream."""
    return churn.churn_rule_scores(s.churn_features, s.tables.events.select("user_id"))


@query
def at_risk_top_k(s: Shop) -> DataFrame:
    return churn.at_risk_customers(s.churn_features, s.dim_customers)


# --- KPIs -----------------------------------------------------------------------------


@query
def kpi_orders_today(s: Shop) -> DataFrame:
    return kpis.orders_today(s.headers, F.date_sub(s.as_of, 1))


@query
def kpi_revenue_today(s: Shop) -> DataFrame:
    return kpis.revenue_today(s.headers, F.date_sub(s.as_of, 1))


def _sessions_since(s: Shop, first: DataFrame) -> DataFrame:
    """Staged sessions of the events from a moment (one row, as the events store it) on.

    The condition is on the stored column, so it reaches the scan.
    """
    recent = _Recent(s.spark, s.root, first)
    return staging.stg_sessions(session_ops.sessionize_by_gap(supplied.clickstream(recent), supplied.SESSION_GAP_SECONDS))


class _Recent(Tables):
    """The tables with no events before a moment."""

    def __init__(self, spark: SparkSession, root: str, first: DataFrame):
        super().__init__(spark, root)
        self._first = first

    def __getitem__(self, name: str) -> DataFrame:
        table = super().__getitem__(name)
        return table.filter(F.col("ts") >= self._first.scalar()) if name == "events" else table


@query
def kpi_active_sessions(s: Shop) -> DataFrame:
    """Events are read from one session gap before the hour on: earlier ones start no session in it."""
    now = s.tables.events.agg(F.max(F.col("ts").cast("timestamp"))).scalar()
    newest = s.tables.events.agg(F.max("ts") - F.expr(f"INTERVAL {3600 + supplied.SESSION_GAP_SECONDS} SECONDS"))
    return kpis.active_sessions(_sessions_since(s, newest), now)


@query
def kpi_conversion_today(s: Shop) -> DataFrame:
    """Events are read from one session gap before the last day on."""
    midnight = s.tables.events.agg(
        F.date_trunc("day", F.max("ts")).cast("timestamp_ntz") - F.expr(f"INTERVAL {supplied.SESSION_GAP_SECONDS} SECONDS")
    )
    return kpis.conversion_today(_sessions_since(s, midnight), F.date_sub(s.events_as_of, 1))


@query
def kpi_revenue_trend(s: Shop) -> DataFrame:
    return kpis.revenue_trend(s.headers, s.as_of)


@query
def kpi_top_categories(s: Shop) -> DataFrame:
    """Only the lines of the orders in question are read into the aggregation."""
    recent = supplied.order_headers(s.tables).filter(kpis.recent_orders(s.as_of))
    orders_of_interest = staging.stg_transactions(supplied.transactions(s.tables, recent))
    return kpis.top_categories(orders_of_interest, s.as_of)


@query
def kpi_latest_order_day(s: Shop) -> DataFrame:
    return orders.latest_order_day(s.headers)


@query
def table_row_counts(s: Shop) -> DataFrame:
    """The daily report: two silver and three gold tables."""
    gold = {n: s.gold[n] for n in ("fct_orders", "dim_customers", "agg_rfm_scores")}
    silver_tables = {"transactions": supplied.order_headers(s.tables), "sessions": s.sessions}
    return catalog.row_counts({**silver_tables, **gold})


# --- data quality ---------------------------------------------------------------------


@query
def dq_column_tests(s: Shop) -> DataFrame:
    tables = {**s.sources, **s.gold, **_staging(s)}
    return quality.column_tests(tables)


def _staging(s: Shop) -> dict[str, DataFrame]:
    return {
        "stg_users": s.stg_users,
        "stg_products": s.stg_products,
        "stg_transactions": s.stg_transactions,
        "stg_sessions": s.stg_sessions,
    }


@query
def dq_silver_gate(s: Shop) -> DataFrame:
    return quality.silver_gate({"transactions": supplied.order_headers(s.tables), "sessions": s.sessions})


@query
def dq_gold_gate(s: Shop) -> DataFrame:
    return quality.gold_gate(s.gold)


@query
def dq_duplicate_orders(s: Shop) -> DataFrame:
    """Order ids that occur more than once in the silver transactions."""
    return quality.duplicate_keys(supplied.order_headers(s.tables), "order_id")


@query
def dq_duplicate_events(s: Shop) -> DataFrame:
    """Order ids with more than one bronze order event, which the silver job has to reduce."""
    events = s.tables.lineitem.select(F.col("l_orderkey").alias("order_id"))
    return quality.duplicate_keys(events, "order_id")


@query
def dq_minimum_rows(s: Shop) -> DataFrame:
    tables = {"churn": s.churn_features, "demand": s.daily, "drift": s.churn_features}
    return quality.check_minimum_rows(tables, quality.MODEL_MINIMUM_ROWS)


def click_event_json(s: Shop, event_id: Column | None = None, session_id: Column | None = None) -> DataFrame:
    """Clickstream records as JSON.  Signup and error events keep their own type,
    which the contract does not allow, and every record carries a value field."""
    own_id = F.col("event_id").cast("string")
    mapped = {k: v for k, v in supplied.EVENT_TYPES.items() if k not in ("signup", "error")}
    k = F.get_json_object("props", "$.k")
    event = F.struct(
        (own_id if event_id is None else event_id).alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        (F.md5(own_id) if session_id is None else session_id).alias("session_id"),
        F.date_format(F.col("ts").cast("timestamp"), EVENT_TIME_FORMAT).alias("timestamp"),
        supplied.recode("event_type", mapped).alias("event_type"),
        product_url("https://shop.example", F.lit("Toys"), k).alias("page_url"),
        k.alias("product_id"),
        F.lit("Toys").alias("product_category"),
        F.lit("mobile").alias("device_type"),
        F.lit("Firefox").alias("browser"),
        F.lit("US").alias("country"),
        F.when(F.col("value") >= 5, F.lit("Springfield")).alias("city"),
        F.lit("direct").alias("referrer"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("value"),
    )
    return s.tables.events.select(
        "event_id", F.to_json(event).alias("value"), F.col("ts").cast("timestamp").alias("timestamp")
    )


@query
def contract_violations_clickstream(s: Shop) -> DataFrame:
    checked = contracts.validate(click_event_json(s), contracts.CLICKSTREAM)
    return checked.select(
        "event_id", F.array_join(F.array_sort("violations"), ",").alias("violations")
    )


@query
def contract_uuid_formats(s: Shop) -> DataFrame:
    """Uuids made of digests; every fifth event and the sessions of errors have bare digests."""
    event, user = F.md5(F.col("event_id").cast("string")), F.md5(F.col("user_id").cast("string"))
    records = click_event_json(
        s,
        F.when(F.col("event_id") % 5 == 0, event).otherwise(uuid_text(event)),
        F.when(F.col("event_type") == "error", user).otherwise(uuid_text(user)),
    )
    checked = contracts.validate(records, contracts.with_uuid_formats(contracts.CLICKSTREAM))
    return checked.select("event_id", F.array_join(F.array_sort("violations"), ",").alias("violations"))


def inventory_event_json(s: Shop) -> DataFrame:
    """Order lines as stock events with the levels before and after; returned lines have a type
    the contract does not know."""
    event = F.struct(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "product_id", "l_suppkey").alias("inventory_id"),
        F.col("product_id").cast("string").alias("product_id"),
        F.lit("item").alias("product_name"),
        F.lit("Toys").alias("category"),
        sku("product_id").alias("sku"),
        F.date_format("timestamp", EVENT_TIME_FORMAT).alias("timestamp"),
        F.when(F.col("quantity_change") > 0, "refund").otherwise("sale").alias("event_type"),
        "quantity_change",
        "quantity_before",
        (F.col("quantity_before") + F.col("quantity_change")).alias("quantity_after"),
        "warehouse_id",
        F.lit(9.5).alias("unit_cost"),
    )
    return s.ledger.select(F.to_json(event).alias("value"), "timestamp")


@query
def contract_violations_inventory(s: Shop) -> DataFrame:
    checked = contracts.validate(inventory_event_json(s), contracts.INVENTORY)
    return checked.groupBy(F.array_join(F.array_sort("violations"), ",").alias("violations")).agg(
        F.count(F.lit(1)).alias("events")
    )


@query
def contract_violations_orders(s: Shop) -> DataFrame:
    """The order events lack several required fields, and some have no items."""
    checked = contracts.validate(order_event_json(s), contracts.ORDERS)
    return checked.groupBy(F.array_join(F.array_sort("violations"), ",").alias("violations")).agg(
        F.count(F.lit(1)).alias("events")
    )


@query
def quarantine_split(s: Shop) -> DataFrame:
    valid, rejected = ingest.with_quarantine(click_event_json(s), contracts.CLICKSTREAM)
    bronze = ingest.parse_and_enrich(valid, schemas.CLICKSTREAM)
    return catalog.row_counts({"valid": bronze, "quarantine": rejected})


# --- alternate model ------------------------------------------------------------------


@query
def seed_dim_customers(s: Shop) -> DataFrame:
    return s.seed_customers


@query
def seed_dim_products(s: Shop) -> DataFrame:
    return s.seed_products


@query
def seed_fct_orders(s: Shop) -> DataFrame:
    return seed.fct_orders(s.lines, s.seed_customers, s.seed_products, s.products)


@query
def seed_agg_daily_revenue(s: Shop) -> DataFrame:
    return s.seed_daily


@query
def seed_agg_rfm_scores(s: Shop) -> DataFrame:
    return s.seed_scores


@query
def seed_agg_cohort_retention(s: Shop) -> DataFrame:
    return seed.agg_cohort_retention(s.lines)


@query
def seed_agg_funnel(s: Shop) -> DataFrame:
    return s.seed_funnel


@query
def seed_agg_churn_features(s: Shop) -> DataFrame:
    return seed.agg_churn_features(s.seed_customers, s.seed_scores, s.as_of)


@query
def seed_build_summary(s: Shop) -> DataFrame:
    return seed.build_summary(s.seed_customers, s.seed_scores, s.seed_daily, s.seed_funnel)


# --- experiments, distributions, drift --------------------------------------------------


@query
def ab_assignment(s: Shop) -> DataFrame:
    return s.assigned


@query
def ab_summary(s: Shop) -> DataFrame:
    return experiments.group_summary(s.assigned)


@query
def ab_lift(s: Shop) -> DataFrame:
    return experiments.lift(experiments.contingency(s.assigned))


@query
def ab_chi2(s: Shop) -> DataFrame:
    return experiments.chi_squared(experiments.contingency(s.assigned))


@query
def ab_significance(s: Shop) -> DataFrame:
    tested = experiments.significance(experiments.contingency(s.assigned))
    return tested.withColumn("p_value", F.round("p_value", 6))


@query
def duration_histogram(s: Shop) -> DataFrame:
    return histogram.duration_histogram(s.assigned)


@query
def feature_histograms(s: Shop) -> DataFrame:
    columns = ("days_since_last_order", "total_orders", "rfm_total", "total_sessions_30d")
    return histogram.feature_histograms(s.feature_table, columns)


@query
def dataset_profile(s: Shop) -> DataFrame:
    delivered = (F.col("status") == "delivered").cast("int")
    labelled = s.headers.withColumn("month", month_label("order_date"))
    return histogram.profile(labelled, "order_date", "month", delivered)


@query
def drift_ks(s: Shop) -> DataFrame:
    rows = s.feature_table.select("user_id", *drift.DRIFT_COLUMNS)
    return drift.ks_by_column(drift.split_halves(rows, "user_id"))


@query
def drift_dataset(s: Shop) -> DataFrame:
    """The share of drifted columns over the whole feature frame, label included."""
    columns = (*churn.FEATURES, "label")
    rows = s.feature_table.select("user_id", *[F.col(c).cast("double").alias(c) for c in columns])
    return drift.dataset_drift(drift.ks_by_column(drift.split_halves(rows, "user_id"), columns))


# --- demand ---------------------------------------------------------------------------


@query
def daily_demand(s: Shop) -> DataFrame:
    return s.daily


@query
def demand_features_daily(s: Shop) -> DataFrame:
    return demand.daily_features(s.daily)


@query
def demand_features_daily_inclusive(s: Shop) -> DataFrame:
    return demand.daily_features(s.daily, include_today=True)


@query
def demand_features_category(s: Shop) -> DataFrame:
    return demand.category_features(s.daily_revenue)


@query
def demand_recent_days(s: Shop) -> DataFrame:
    return demand.recent_with_lags(s.daily)


@query
def demand_forecast_rule(s: Shop) -> DataFrame:
    return demand.rule_forecast(s.daily, s.as_of)


@query
def demand_folds(s: Shop) -> DataFrame:
    folds = demand.expanding_folds(s.daily)
    return folds.groupBy("fold", "role").agg(
        F.count(F.lit(1)).alias("days"),
        F.min("order_date").alias("first_day"),
        F.max("order_date").alias("last_day"),
    )


@query
def demand_chronological_split(s: Shop) -> DataFrame:
    split = demand.chronological_split(s.daily_revenue)
    return split.groupBy("role").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("order_date").alias("first_day"),
        F.max("order_date").alias("last_day"),
    )


# --- stock and pricing ------------------------------------------------------------------


@query
def inventory_ledger(s: Shop) -> DataFrame:
    return s.ledger


@query
def inventory_snapshot(s: Shop) -> DataFrame:
    return inventory.daily_closing_stock(
        supplied.movements(s.tables), supplied.MOVEMENT_ORDER, chunk=supplied.movement_chunk()
    )


@query
def inventory_snapshot_compat(s: Shop) -> DataFrame:
    return inventory.daily_snapshot(s.ledger, supplied.MOVEMENT_ORDER, compat=True)


@query
def inventory_latest_stock(s: Shop) -> DataFrame:
    return inventory.latest_stock(s.ledger, supplied.MOVEMENT_ORDER)


@query
def ledger_continuity(s: Shop) -> DataFrame:
    """Links that break when the returns are missing from the ledger.

    The ledger is settled first, as the table it is in practice: the check reads it twice.
    """
    sales_only = cut_lineage(s.ledger).filter("quantity_change < 0")
    return inventory.broken_links(
        sales_only, supplied.MOVEMENT_ORDER, chunk=supplied.movement_chunk()
    )


@query
def order_pricing_check(s: Shop) -> DataFrame:
    """Every second order has a coupon; l_extendedprice already includes the quantity."""
    lines = s.tables.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("unit_price"),
        F.lit(1).alias("quantity"),
        F.col("l_discount").cast("decimal(4,2)").alias("discount_pct"),
    )
    heads = s.tables.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit("SAVE10")).alias("coupon_code"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("stated_total"),
    )
    return pricing.price_orders(lines, heads)


# --- models ---------------------------------------------------------------------------


@query
def rfm_standardized(s: Shop) -> DataFrame:
    z = clustering.standardize(s.rfm_scores)
    return z.select("user_id", *[F.round(f"z_{c}", 6).alias(f"z_{c}") for c in clustering.FEATURES])


@query
def kmeans_elbow(s: Shop) -> DataFrame:
    return clustering.elbow(clustering.scaled_features(s.rfm_scores))


@query
def kmeans_profile(s: Shop) -> DataFrame:
    scores = s.rfm_scores
    assigned = clustering.assign_clusters(clustering.scaled_features(scores))
    return clustering.cluster_profile(assigned)


@query
def churn_model_comparison(s: Shop) -> DataFrame:
    return models.compare_churn_models(*models.prepare_churn(s.churn_features))[0]


@query
def churn_model_without_leak(s: Shop) -> DataFrame:
    """The best comparison row when the columns that restate the label are left out."""
    columns = [c for c in churn.FEATURES if c not in churn.LEAKING_FEATURES]
    train, test = models.prepare_churn(s.churn_features, columns)
    return models.best_model(models.compare_churn_models(train, test, columns)[0])


@query
def churn_split(s: Shop) -> DataFrame:
    """Which labeled users are held out for testing."""
    rows = models.training_frame(s.churn_features, churn.FEATURES, "label", ["user_id"])
    train, test = models.stratified_split(rows, "user_id")
    sides = train.withColumn("held_out", F.lit(False)).unionByName(test.withColumn("held_out", F.lit(True)))
    return sides.select("user_id", "label", "held_out")


@query
def churn_roc_curve(s: Shop) -> DataFrame:
    """The curves of all models over the same test rows."""
    train, test = models.prepare_churn(s.churn_features)
    fitted = {name: models.fit_churn(train, name) for name in models.churn_estimators()}
    return models.roc_curves(models.scored_by_all(fitted, test))


def _given_scores(s: Shop) -> DataFrame:
    """Three fixed scores of every labeled user, in the place of models."""
    rows = models.training_frame(s.churn_features, churn.FEATURES, "label", ["user_id"])
    scores = {
        "recency": F.col("days_since_last_order") / (F.col("days_since_last_order") + 30),
        "orders": 1 / (1 + F.col("total_orders")),
        "constant": F.lit(0.5),
    }
    return rows.select(
        "label", F.explode(F.array(*[F.struct(F.lit(n).alias("model"), x.alias("score")) for n, x in scores.items()])).alias("m")
    ).select("m.model", "label", "m.score")


@query
def roc_of_given_scores(s: Shop) -> DataFrame:
    curves = models.roc_curves(_given_scores(s))
    return curves.select("model", *[F.round(c, 9).alias(c) for c in ("score", "fpr", "tpr")])


@query
def auc_of_given_scores(s: Shop) -> DataFrame:
    """Area under each curve, and the confusion of a cut at one half."""
    scores = _given_scores(s)
    areas = models.areas(scores).select("model", F.round("auc", 9).alias("auc"))
    cut = scores.withColumn("prediction", (F.col("score") >= 0.5).cast("double"))
    return models.confusion(cut, "model").join(areas, "model")


@query
def churn_confusion(s: Shop) -> DataFrame:
    """Confusion of the best model."""
    train, test = models.prepare_churn(s.churn_features)
    metrics, fitted = models.compare_churn_models(train, test)
    return models.confusion(fitted[models.best_model(metrics).first().model].transform(test))


@query
def churn_importances(s: Shop) -> DataFrame:
    """Importances in the best model that has them."""
    train, test = models.prepare_churn(s.churn_features)
    metrics, fitted = models.compare_churn_models(train, test)
    with_importances = metrics.filter(F.col("model").isin([n for n, m in fitted.items() if models.has_importances(m)]))
    return models.importances(fitted[models.best_model(with_importances).first().model], churn.FEATURES, s.spark)


@query
def churn_model_scores(s: Shop) -> DataFrame:
    train, _ = models.prepare_churn(s.churn_features)
    return models.score_churn(s.churn_features, models.fit_churn(train))


@query
def model_run_log(s: Shop) -> DataFrame:
    """A logged run of each churn model; the best one by AUC is promoted."""
    path = fresh_dir(s.spark, "model-runs")
    train, test = models.prepare_churn(s.churn_features)
    _, fitted = models.compare_churn_models(train, test)
    for name, model in fitted.items():
        auc, f1 = models.churn_metrics(model.transform(test))
        models.log_run(s.spark, path, name, {"seed": models.SEED}, {"auc": auc, "f1": f1}, model)
    return models.best_run(s.spark, path).select("model", "score", "metrics", "params")


@query
def demand_model_metrics(s: Shop) -> DataFrame:
    return models.train_demand(s.daily_revenue)[0]


@query
def demand_importances(s: Shop) -> DataFrame:
    """What the demand model's predictions rest on."""
    return models.importances(models.train_demand(s.daily_revenue)[1], demand.CATEGORY_FEATURES, s.spark)


@query
def busiest_days_tail(s: Shop) -> DataFrame:
    """The last 15 days by orders, and by date among equal ones."""
    return ranking.tail(s.daily.select("order_date", "total_orders"), ["total_orders", "order_date"], 15)


@query
def demand_cross_validation(s: Shop) -> DataFrame:
    return models.cross_validate_demand(s.daily)


@query
def demand_actual_vs_predicted(s: Shop) -> DataFrame:
    """The newest 30 days against a model trained on the whole series."""
    features = cut_lineage(demand.daily_features(s.daily))
    rows = features.withColumn("label", F.col("total_orders").cast("double"))
    model = models.fit_demand(rows, demand.DAILY_FEATURES)
    return models.actual_and_predicted(features, model, demand.DAILY_FEATURES)


@query
def demand_forecast_model(s: Shop) -> DataFrame:
    _, model = models.train_demand(s.daily_revenue)
    return models.forecast_demand(s.daily, s.as_of, model)


# --- streaming --------------------------------------------------------------------------


def _event_stream(s: Shop, table: str) -> DataFrame:
    return ingest.file_stream(s.spark, s.root, s.tables[table].schema, glob=f"{table}.parquet")


class StreamShop(Shop):
    """The same shapes, with events, orders or lines read as a stream of files."""

    def __init__(self, shop: Shop, *streamed: str):
        super().__init__(shop.spark, shop.root)
        self.tables = _StreamTables(shop, streamed)


class _StreamTables(Tables):
    def __init__(self, shop: Shop, streamed: tuple[str, ...]):
        super().__init__(shop.spark, shop.root)
        self._shop, self._streamed = shop, streamed

    def __getitem__(self, name: str) -> DataFrame:
        return _event_stream(self._shop, name) if name in self._streamed else super().__getitem__(name)


def _run_append(s: Shop, stream: DataFrame, label: str) -> DataFrame:
    """Run a stream over all available files into a table, and read the table."""
    base = fresh_dir(s.spark, label)
    writing = ingest.write_stream(
        stream, f"{base}/table", f"{base}/checkpoint", label, AVAILABLE_NOW, partition_by=None
    )
    ingest.drain(writing)
    return s.spark.read.schema(stream.schema).parquet(f"{base}/table")


@query
def stream_bronze_clickstream(s: Shop) -> DataFrame:
    """JSON clickstream records through the ingestion stream into a bronze table."""
    live = StreamShop(s, "events")
    base = fresh_dir(s.spark, "bronze")
    raw = click_event_json(live).drop("event_id")
    feed = ingest.Feed("clickstream", raw, schemas.CLICKSTREAM)
    for writing in ingest.start_feeds([feed], f"{base}/bronze", f"{base}/checkpoint", AVAILABLE_NOW):
        ingest.drain(writing)
    bronze = catalog.read_table(s.spark, f"{base}/bronze/clickstream", merge_schema=True)
    return bronze.select("event_id", "user_id", "session_id", "timestamp", "event_type", "page_url", "city")


@query
def stream_bronze_feeds(s: Shop) -> DataFrame:
    """All three topics as independent streams; rows per bronze table."""
    base = fresh_dir(s.spark, "feeds")
    live = StreamShop(s, "events", "orders", "lineitem")
    clicks = click_event_json(live).drop("event_id")
    heads = supplied.order_headers(live.tables)
    order_events = heads.select(F.to_json(F.struct(*heads.columns)).alias("value"), "timestamp")
    moves = supplied.movements(live.tables).withColumn(
        "inventory_id", F.concat_ws("-", "l_orderkey", "l_linenumber", "product_id", "l_suppkey")
    )
    stock = moves.select(
        F.to_json(F.struct("inventory_id", "product_id", "warehouse_id", "quantity_change")).alias("value"),
        "timestamp",
    )
    raw = {"clickstream": clicks, "orders": order_events, "inventory": stock}
    feeds = [ingest.Feed(label, raw[label], schema) for label, schema in schemas.STREAMS.items()]
    for writing in ingest.start_feeds(feeds, f"{base}/bronze", f"{base}/checkpoint", AVAILABLE_NOW):
        ingest.drain(writing)
    tables = {label: catalog.read_table(s.spark, f"{base}/bronze/{label}") for label in raw}
    return catalog.row_counts(tables)


def _bronze(s: Shop, label: str, raw: DataFrame) -> DataFrame:
    """The bronze table of one topic after its feed has taken in all that is there."""
    base = fresh_dir(s.spark, f"bronze-{label}")
    feed = ingest.Feed(label, raw, schemas.STREAMS[label])
    for writing in ingest.start_feeds([feed], f"{base}/bronze", f"{base}/checkpoint", AVAILABLE_NOW):
        ingest.drain(writing)
    return catalog.read_table(s.spark, f"{base}/bronze/{label}", merge_schema=True)


@query
def stream_bronze_orders(s: Shop) -> DataFrame:
    """Order events with all their items through the ingestion stream; one row per item of the bronze table."""
    bronze = _bronze(s, "orders", nested_order_json(StreamShop(s, "orders")))
    return bronze.select(
        "order_id", "user_id", "timestamp", "total_amount", F.posexplode_outer("items").alias("place", "item")
    ).select("order_id", "user_id", "timestamp", "total_amount", "place", "item.product_id", "item.category", "item.unit_price", "item.discount_pct")


@query
def stream_bronze_inventory(s: Shop) -> DataFrame:
    """Stock events with their levels, arriving as files a few at a time, as the bronze table holds them."""
    arriving = fresh_dir(s.spark, "stock-events")
    events = inventory_event_json(s)
    events.write.parquet(arriving)
    bronze = _bronze(s, "inventory", ingest.file_stream(s.spark, arriving, events.schema, max_files=64))
    return bronze.select(
        "inventory_id", "product_id", "timestamp", "event_type", "quantity_change", "quantity_before",
        "quantity_after", "warehouse_id", "unit_cost",
    )


@query
def stream_dedupe(s: Shop) -> DataFrame:
    live = StreamShop(s, "events")
    unique = stateful.dedupe(live.clickstream, "event_id", "timestamp", "1 hour")
    return _run_append(s, unique, "dedupe")


@query
def stream_unique_append(s: Shop) -> DataFrame:
    """Every event sent twice into a stream that stores each event once."""
    base = fresh_dir(s.spark, "unique")
    live = StreamShop(s, "events").clickstream
    twice = live.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    writing = stateful.write_unique(
        twice, f"{base}/table", f"{base}/checkpoint", ["event_id"], AVAILABLE_NOW
    )
    ingest.drain(writing)
    return s.spark.read.parquet(f"{base}/table")


def _closed(s: Shop, stream: DataFrame, timestamp: str) -> DataFrame:
    """The stream followed by one far later row, which closes all windows before it."""
    path = fresh_dir(s.spark, "flush")
    later = F.lit("2999-01-01").cast("timestamp")
    empty = [later.alias(f.name) if f.name == timestamp else F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema]
    s.spark.range(1).select(*empty).write.parquet(path)
    return stream.unionByName(ingest.file_stream(s.spark, path, stream.schema))


@query
def stream_sessions(s: Shop) -> DataFrame:
    """All sessions, closed by a flush row."""
    live = _closed(s, StreamShop(s, "events").clickstream, "timestamp")
    return _run_append(s, stateful.sessions(live, "6 hours", "1 hour"), "sessions")


@query
def stream_order_kpis(s: Shop) -> DataFrame:
    """Order KPIs of all days, closed by a flush row."""
    live = _closed(s, StreamShop(s, "orders").headers, "order_timestamp")
    return _run_append(s, stateful.order_kpis(live, "1 day", "1 day"), "kpis")


@query
def stream_active_users(s: Shop) -> DataFrame:
    live = _closed(s, StreamShop(s, "events").clickstream, "timestamp")
    return _run_append(s, stateful.active_users(live, "1 hour", "15 minutes", "1 hour"), "active")


@query
def stream_latest_stock(s: Shop) -> DataFrame:
    """Stock level per product and warehouse, from a stream of stock events."""
    base = fresh_dir(s.spark, "stock")
    order = [*supplied.MOVEMENT_ORDER]
    events = s.ledger.select(*inventory.KEYS, *order, "quantity_after")
    events.write.parquet(f"{base}/events")
    keys = list(inventory.KEYS)
    updates = stateful.stock_changes(
        ingest.file_stream(s.spark, f"{base}/events", events.schema), keys, order, "quantity_after"
    )
    ingest.drain(stateful.write_updates(updates, f"{base}/table", f"{base}/checkpoint", AVAILABLE_NOW))
    return stateful.read_newest(s.spark, f"{base}/table", keys)


def _damaged(clicks: DataFrame) -> DataFrame:
    """Clickstream records of which one in fifty is cut off and one in fifty has lost its key."""
    step = F.col("event_id") % 50
    return clicks.withColumn(
        "value",
        F.when(step == 7, F.substring("value", 1, 30))
        .when(step == 8, F.replace("value", F.lit('"event_id"'), F.lit('"id"')))
        .otherwise(F.col("value")),
    )


def _checked_feed(s: Shop) -> str:
    """Damaged clickstream records through the checked ingestion stream; the folder of its tables."""
    base = fresh_dir(s.spark, "checked")
    raw = _damaged(click_event_json(StreamShop(s, "events"))).drop("event_id")
    feed = ingest.Feed("clickstream", raw, schemas.CLICKSTREAM, contracts.CLICKSTREAM)
    for writing in ingest.start_feeds([feed], f"{base}/bronze", f"{base}/checkpoint", AVAILABLE_NOW):
        ingest.drain(writing)
    return f"{base}/bronze/clickstream"


@query
def stream_quarantine_records(s: Shop) -> DataFrame:
    """The good records of a stream with malformed, wrong and good ones."""
    records = quarantine.read_records(s.spark, _checked_feed(s), schemas.CLICKSTREAM)
    return records.select(
        "event_id", "user_id", "session_id", "timestamp", "event_type", "page_url", "city", "source_timestamp"
    )


@query
def stream_quarantine_rejects(s: Shop) -> DataFrame:
    """The other records of the same stream: reasons, and the payload of those that are not JSON."""
    rejects = quarantine.read_quarantine(s.spark, _checked_feed(s))
    malformed = F.array_contains("violations", "not_json")
    return rejects.select(
        F.coalesce(F.get_json_object("value", "$.event_id"), F.get_json_object("value", "$.id")).alias("event_id"),
        F.when(malformed, F.col("value")).alias("payload"),
        F.array_join(F.array_sort("violations"), ",").alias("violations"),
        "source_timestamp",
    )


LATE_PARTS = 5


@query
def stream_late_ledger(s: Shop) -> DataFrame:
    """Events arriving in parts, some of them two parts late; the stream is stopped after every part."""
    base = fresh_dir(s.spark, "late")
    events = s.clickstream.select("event_id", "user_id", "timestamp", "event_type")
    last = s.tables.events.agg(F.max("event_id")).scalar()
    part = F.floor(F.col("event_id") * LATE_PARTS / (last + 1)) + F.when(F.col("event_id") % 89 == 0, 2).otherwise(0)
    parts = events.withColumn("part", F.least(part, F.lit(LATE_PARTS - 1)))
    for number in range(LATE_PARTS):
        parts.filter(F.col("part") == number).drop("part").write.mode("append").parquet(f"{base}/events")
        arriving = ingest.file_stream(s.spark, f"{base}/events", events.schema)
        ingest.drain(
            late.write_on_time(arriving, "timestamp", "1 hour", f"{base}/table", f"{base}/checkpoint", AVAILABLE_NOW)
        )
    return late.late_ledger(s.spark, f"{base}/table").drop("query")


STOCK_BATCHES = 6


@query
def stream_stock_compacted(s: Shop) -> DataFrame:
    """stream_latest_stock in several micro-batches, whose updates are compacted."""
    base = fresh_dir(s.spark, "stock")
    order, keys = [*supplied.MOVEMENT_ORDER], list(inventory.KEYS)
    events = s.ledger.select(*keys, *order, "quantity_after")
    # As many files in a micro-batch as tasks can read at once: one file is one task's work at a time.
    files = s.spark.sparkContext.defaultParallelism
    events.repartition(STOCK_BATCHES * files, *order).write.parquet(f"{base}/events")
    arriving = ingest.file_stream(s.spark, f"{base}/events", events.schema, max_files=files)
    updates = stateful.stock_changes(arriving, keys, order, "quantity_after")
    ingest.drain(
        compaction.write_compacted(updates, f"{base}/table", f"{base}/checkpoint", AVAILABLE_NOW, keys, every=4)
    )
    return compaction.read_compacted(s.spark, f"{base}/table", keys)
