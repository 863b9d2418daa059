"""SQL equivalents of the registered queries, for DuckDB on the same tables.

They are written in the plainest form (row_number, lag, ntile, count distinct,
a recursive ledger) so that they check the distributed forms independently.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def _round(x: str, digits: int = 2) -> str:
    return f"cast(round(cast({x} as decimal(38,12)), {digits}) as double)"


def _ratio(n: str, d: str) -> str:
    return f"(cast({n} as double) / nullif(cast({d} as double), 0))"


def _pct(n: str, d: str) -> str:
    return _round(f"cast({n} as double) * 100 / nullif(cast({d} as double), 0)")


def _query(name: str, ctes: tuple[str, ...], body: str) -> None:
    """Assemble a query from named building blocks, each included once, in order."""
    needed: list[str] = []

    def add(block: str) -> None:
        for parent in BLOCKS[block][0]:
            add(parent)
        if block not in needed:
            needed.append(block)

    for block in ctes:
        add(block)
    head = ",\n".join(f"{b} as materialized ({BLOCKS[b][1].strip()})" for b in needed)
    text = body.strip()
    if head:
        rest = f",{text[len('with'):]}" if text.startswith("with ") else f"\n{text}"
        text = f"with recursive {head}{rest}"
    ORACLE[name] = text


AS_OF = "(select max(cast(o_orderdate as date)) + 1 from orders)"
EVENTS_AS_OF = "(select max(cast(ts as date)) + 1 from events)"
MAP_STATUS = (
    "case o_orderstatus when 'F' then 'delivered' when 'O' then 'pending' "
    "when 'P' then 'cancelled' else o_orderstatus end"
)
MAP_LINE_STATUS = MAP_STATUS.replace("'delivered'", "'completed'")
MAP_PAYMENT = (
    "case o_orderpriority when '1-URGENT' then 'credit_card' when '2-HIGH' then 'debit_card' "
    "when '3-MEDIUM' then 'paypal' when '4-NOT SPECIFIED' then 'bank_transfer' "
    "when '5-LOW' then 'crypto' else o_orderpriority end"
)

# name -> (blocks it reads, SQL)
BLOCKS: dict[str, tuple[tuple[str, ...], str]] = {}

BLOCKS["users"] = ((), """
select c_custkey as user_id, lower(replace(c_name, '#', '.')) || '@example.com' as email,
       c_name as name, n_name as country, c_mktsegment as tier,
       date '1995-01-01' - cast(c_custkey % 365 as integer) as signup_date
from customer left join nation on c_nationkey = n_nationkey
""")

BLOCKS["products"] = ((), """
select p_partkey as product_id, p_name as product_name, p_type as category,
       'size-' || cast(p_size // 10 as varchar) as subcategory, p_brand as brand,
       cast(p_retailprice as decimal(10,2)) as base_price,
       cast(round(cast(p_retailprice as decimal(10,2)) * cast(p_size + 40 as decimal(4,0))
                  * cast(0.01 as decimal(3,2)), 2) as decimal(10,2)) as cost_price,
       'SUP' || lpad(cast(p_partkey % 20 + 1 as varchar), 3, '0') as supplier_id
from part
""")

BLOCKS["heads"] = ((), f"""
select o_orderkey as order_id, o_custkey as user_id, o_orderdate as order_timestamp,
       cast(o_orderdate as date) as order_date,
       cast(o_totalprice as decimal(12,2)) as total_amount,
       {MAP_PAYMENT} as payment_method, {MAP_STATUS} as status,
       'NATION_' || (o_orderkey % 25) as country, 'CITY_' || (o_orderkey % 100) as city
from orders where o_orderstatus is not null and o_orderkey is not null
""")

BLOCKS["first_lines"] = ((), """
select * from (
  select l_orderkey, l_partkey, cast(count(*) over (partition by l_orderkey) as integer) as item_count,
         row_number() over (partition by l_orderkey
           order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) as rn
  from lineitem) where rn = 1
""")

BLOCKS["tx"] = (("heads", "first_lines"), """
select h.*, coalesce(f.item_count, 0) as item_count, p.p_type as primary_category
from heads h left join first_lines f on h.order_id = f.l_orderkey
left join part p on f.l_partkey = p.p_partkey
""")

BLOCKS["ev"] = ((), """
select event_id, user_id, ts as "timestamp",
       case event_type when 'error' then 'page_view' when 'view' then 'product_view'
         when 'click' then 'add_to_cart' when 'signup' then 'checkout_start'
         when 'purchase' then 'checkout_complete' else event_type end as event_type,
       ['mobile', 'desktop', 'tablet'][cast(event_id % 3 + 1 as integer)] as device_type,
       'NATION_' || (event_id % 25) as country
from events
""")

BLOCKS["ev_session"] = (("ev",), """
with marked as (
  select *, lag("timestamp") over (partition by user_id order by "timestamp", event_id) as prev from ev),
numbered as (
  select *, sum(case when prev is null or "timestamp" - prev > interval 6 hour then 1 else 0 end)
    over (partition by user_id order by "timestamp", event_id) as n from marked),
started as (select *, min("timestamp") over (partition by user_id, n) as session_start from numbered)
select *, md5(cast(user_id as varchar) || '|' || cast(epoch_us(session_start) as varchar)) as session_id
from started
""")

BLOCKS["sessions"] = (("ev_session",), """
select session_id, user_id, min("timestamp") as start_time, max("timestamp") as end_time,
       epoch_us(max("timestamp")) // 1000000 - epoch_us(min("timestamp")) // 1000000 as duration_seconds,
       count(*) as page_views,
       count(*) filter (where event_type = 'product_view') as products_viewed,
       count(*) filter (where event_type = 'add_to_cart') as add_to_cart_count,
       count(*) filter (where event_type = 'checkout_complete') > 0 as converted,
       max(case when pos = 1 then device_type end) as device_type,
       max(case when pos = 1 then country end) as country,
       count(*) filter (where event_type = 'checkout_start') as checkout_initiated,
       count(*) filter (where event_type = 'checkout_complete') as purchased
from (select *, row_number() over (partition by session_id order by "timestamp", event_id) as pos
      from ev_session)
group by session_id, user_id
""")

BLOCKS["stg_sessions"] = (("sessions",), """
select *, cast(start_time as date) as session_date from sessions
""")

BLOCKS["dim_customers"] = (("users", "heads"), f"""
with m as (
  select user_id, count(*) as total_orders, sum(total_amount) as total_revenue,
         cast(sum(total_amount) as double) / count(total_amount) as avg_order_value,
         min(order_timestamp) as first_order_date, max(order_timestamp) as last_order_date,
         count(*) filter (where status = 'delivered') as completed_orders,
         count(*) filter (where status = 'cancelled') as cancelled_orders
  from heads group by user_id),
d as (
  select *, (epoch(cast({AS_OF} as timestamp)) - epoch(last_order_date)) / 86400 as days_last,
         (epoch(cast({AS_OF} as timestamp)) - epoch(first_order_date)) / 86400 as days_first from m),
r as (select *, {_round(_ratio('total_revenue', 'days_first') + ' * 365')} as rate from d)
select u.user_id, u.email, u.name, u.country, u.tier, u.signup_date,
       coalesce(total_orders, 0) as total_orders,
       cast(coalesce(total_revenue, 0) as decimal(22,2)) as total_revenue,
       coalesce(avg_order_value, 0.0::double) as avg_order_value, first_order_date, last_order_date,
       coalesce(completed_orders, 0) as completed_orders,
       coalesce(cancelled_orders, 0) as cancelled_orders,
       coalesce(days_last, 9999.0::double) as days_since_last_order,
       coalesce(rate, 0.0::double) as annual_revenue_rate,
       coalesce({_round('rate * 3')}, 0.0::double) as predicted_clv_3yr,
       coalesce(days_last > 90, false) as is_churned
from users u left join r on u.user_id = r.user_id
""")

BLOCKS["fct_orders"] = (("tx", "dim_customers"), """
select t.order_id, t.user_id, t.order_timestamp, t.order_date,
       cast(date_trunc('week', t.order_timestamp) as date) as order_week,
       cast(date_trunc('month', t.order_timestamp) as date) as order_month,
       t.total_amount, t.item_count, t.primary_category, t.payment_method, t.status,
       t.country, t.city, c.tier as customer_tier, c.is_churned,
       coalesce(cast(c.first_order_date as date) = t.order_date, false) as is_first_order
from tx t left join dim_customers c on t.user_id = c.user_id
""")

BLOCKS["daily_revenue"] = (("fct_orders",), f"""
select order_date, primary_category, count(distinct order_id) as total_orders,
       count(distinct user_id) as unique_customers,
       count(distinct case when is_first_order then user_id end) as new_customers,
       cast(sum(total_amount) as decimal(22,2)) as gross_revenue,
       cast(sum(total_amount) filter (where status = 'delivered') as decimal(22,2)) as net_revenue,
       cast(sum(total_amount) as double) / count(total_amount) as avg_order_value,
       {_pct("count(*) filter (where status = 'cancelled')", "count(*)")} as cancellation_rate_pct
from fct_orders group by order_date, primary_category
""")

BLOCKS["daily"] = (("daily_revenue",), f"""
select order_date, cast(sum(total_orders) as bigint) as total_orders,
       cast(sum(gross_revenue) as decimal(28,2)) as gross_revenue,
       {_round('cast(sum(cast(avg_order_value as decimal(22,8))) as double) / count(avg_order_value)', 6)}
         as avg_order_value,
       {_round('cast(sum(cast(cancellation_rate_pct as decimal(22,8))) as double) / count(cancellation_rate_pct)', 6)}
         as cancellation_rate_pct
from daily_revenue group by order_date
""")

SEGMENT_RULES = """case
 when r_score >= 4 and f_score >= 4 and m_score >= 4 then 'Champions'
 when r_score >= 3 and f_score >= 3 and m_score >= 3 then 'Loyal Customers'
 when r_score >= 4 and f_score <= 2 then 'Recent Customers'
 when r_score >= 3 and m_score >= 4 then 'Potential Loyalists'
 when r_score <= 2 and f_score >= 3 and m_score >= 3 then 'At Risk'
 when r_score <= 2 and f_score >= 2 then 'Cannot Lose Them'
 when r_score <= 2 and f_score <= 2 and m_score <= 2 then 'Lost'
 else 'Hibernating' end"""


def _rfm(spend_order: str) -> str:
    return f"""
with raw as (
  select user_id, max(order_date) as last_order_date,
         cast({AS_OF} - max(order_date) as integer) as recency_days,
         count(distinct order_id) as frequency,
         sum(total_amount) filter (where status = 'delivered') as monetary
  from heads group by user_id),
scored as (
  select *, cast(ntile(5) over (order by recency_days desc, user_id) as integer) as r_score,
         cast(ntile(5) over (order by frequency, user_id) as integer) as f_score,
         cast(ntile(5) over (order by {spend_order}, user_id) as integer) as m_score from raw)
select user_id, last_order_date, recency_days, frequency,
       cast(coalesce(monetary, 0) as decimal(22,2)) as monetary, r_score, f_score, m_score,
       r_score + f_score + m_score as rfm_total, {SEGMENT_RULES} as rfm_segment
from scored"""


BLOCKS["rfm"] = (("heads",), _rfm("coalesce(monetary, 0)"))
BLOCKS["rfm_nulls_last"] = (("heads",), _rfm("monetary asc nulls last"))


def _cohort(period: str) -> str:
    return f"""
with firsts as (
  select user_id, cast(date_trunc('month', min(order_timestamp)) as date) as cohort_month
  from heads group by user_id),
joined as (
  select f.user_id, f.cohort_month, cast(date_trunc('month', h.order_timestamp) as date) as active_month
  from firsts f join heads h on f.user_id = h.user_id),
counts as (
  select cohort_month, {period} as period_number, count(distinct user_id) as active_users
  from joined group by all having {period} between 0 and 11)
select cohort_month, period_number, active_users,
       first_value(active_users) over w as cohort_size,
       {_pct('active_users', 'first_value(active_users) over w')} as retention_rate
from counts window w as (partition by cohort_month order by period_number)"""


CALENDAR_PERIOD = (
    "cast((year(active_month) - year(cohort_month)) * 12 + month(active_month) - month(cohort_month) as integer)"
)
BLOCKS["cohort"] = (("heads",), _cohort(CALENDAR_PERIOD))
BLOCKS["cohort30"] = (("heads",), _cohort("cast(active_month - cohort_month as double) / 30"))

BLOCKS["churn"] = (("dim_customers", "rfm", "stg_sessions"), f"""
with s as (
  select user_id, cast(sum(duration_seconds) as double) / count(*) as d,
         cast(sum(products_viewed) as double) / count(*) as p,
         count(*) filter (where session_date >= {EVENTS_AS_OF} - 30) as recent
  from stg_sessions group by user_id)
select c.user_id, c.days_since_last_order, c.total_orders, c.total_revenue, c.avg_order_value,
       {_pct('c.cancelled_orders', 'c.total_orders')} as cancellation_rate,
       r.r_score, r.f_score, r.m_score, r.rfm_total, r.rfm_segment,
       coalesce(s.d, 0.0::double) as avg_session_duration,
       coalesce(s.p, 0.0::double) as avg_products_viewed,
       coalesce(s.recent, 0) as total_sessions_30d, c.is_churned as label
from dim_customers c left join rfm r on c.user_id = r.user_id
left join s on c.user_id = s.user_id where c.total_orders > 0
""")

BLOCKS["lines"] = ((), f"""
select 'TXN-' || lpad(cast(l_orderkey as varchar), cast(greatest(6, length(cast(l_orderkey as varchar))) as integer), '0')
         || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey as transaction_id,
       o_custkey as user_id, l_partkey as product_id, cast(l_quantity as integer) as quantity,
       cast((2 * cast(round(l_extendedprice * 100) as bigint) + cast(l_quantity as bigint))
            // (2 * cast(l_quantity as bigint)) as decimal(12,0)) * cast(0.01 as decimal(3,2)) as unit_price,
       {MAP_LINE_STATUS} as status, {MAP_PAYMENT} as payment_method, o_orderdate as created_at
from lineitem join orders on l_orderkey = o_orderkey
""")

BLOCKS["seed_tx"] = (("lines",), """
select * replace (cast(unit_price as decimal(10,2)) as unit_price),
       cast(quantity * unit_price as decimal(12,2)) as total_amount from lines
""")

BLOCKS["seed_customers"] = (("seed_tx", "users"), f"""
with spend as (
  select user_id, count(*) as n, sum(total_amount) as v, max(created_at) as last_order_date
  from seed_tx where status = 'completed' group by user_id)
select u.user_id, u.email, u.name, u.signup_date, u.country, coalesce(n, 0) as total_orders,
       cast(coalesce(v, 0) as decimal(22,2)) as lifetime_value, last_order_date,
       case when coalesce(v, 0) > 1000 then 'Platinum' when coalesce(v, 0) > 400 then 'Gold'
            when coalesce(v, 0) > 100 then 'Silver' else 'Bronze' end as tier,
       coalesce(last_order_date < cast({AS_OF} - 90 as timestamp), false) as is_churned
from users u left join spend s on u.user_id = s.user_id
""")

BLOCKS["seed_products"] = (("seed_tx", "products"), """
with sold as (
  select product_id, count(*) as n, sum(total_amount) as v
  from seed_tx where status = 'completed' group by product_id),
all_products as (
  select p.product_id, p.product_name as name, p.category, p.subcategory, p.base_price, p.cost_price,
         coalesce(n, 0) as total_orders, cast(coalesce(v, 0) as decimal(22,2)) as total_revenue
  from products p left join sold s on p.product_id = s.product_id),
limits as (
  select quantile_cont(cast(total_revenue as double), 0.8) as a,
         quantile_cont(cast(total_revenue as double), 0.5) as b from all_products)
select q.*, case when total_revenue > a then 'A' when total_revenue > b then 'B' else 'C' end as abc_class
from all_products q, limits
""")

BLOCKS["seed_rfm"] = (("seed_tx",), f"""
with base as (
  select user_id, max(created_at) as last_purchase, count(*) as frequency,
         cast(sum(total_amount) as decimal(22,2)) as monetary
  from seed_tx where status = 'completed' group by user_id),
scored as (
  select *, cast(floor((epoch(cast({AS_OF} as timestamp)) - epoch(last_purchase)) / 86400) as integer) as recency_days,
         cast(ntile(5) over (order by last_purchase desc, user_id) as integer) as r_score,
         cast(ntile(5) over (order by frequency, user_id) as integer) as f_score,
         cast(ntile(5) over (order by monetary, user_id) as integer) as m_score from base)
select user_id, recency_days, frequency, monetary, r_score, f_score, m_score,
       r_score + f_score + m_score as rfm_total,
       case when r_score >= 4 and f_score >= 4 then 'Champions'
            when r_score >= 3 and f_score >= 3 then 'Loyal Customers'
            when r_score >= 4 and f_score <= 2 then 'Recent Customers'
            when r_score <= 2 and f_score >= 3 then 'At Risk'
            when r_score <= 2 and f_score <= 2 then 'Lost'
            else 'Potential Loyalists' end as rfm_segment
from scored
""")

BLOCKS["seed_daily"] = (("seed_tx",), """
select cast(created_at as date) as revenue_date, p_type as category, count(*) as total_orders,
       cast(sum(total_amount) as decimal(22,2)) as total_revenue,
       cast(sum(total_amount) as double) / count(*) as avg_order_value,
       count(distinct user_id) as unique_customers
from seed_tx join part on product_id = p_partkey where status = 'completed'
group by all
""")

BLOCKS["seed_funnel"] = (("sessions",), f"""
select cast(start_time as date) as funnel_date, count(*) as total_sessions,
       cast(sum(products_viewed) as bigint) as product_views,
       cast(sum(add_to_cart_count) as bigint) as add_to_carts,
       cast(sum(checkout_initiated) as bigint) as checkouts,
       cast(sum(purchased) as bigint) as purchases,
       {_pct('sum(purchased)', 'count(*)')} as conversion_rate
from sessions group by all
""")

# The ledger really walks the movements one by one, all products in step.
BLOCKS["moves"] = ((), """
select *, row_number() over (partition by product_id, warehouse_id
            order by "timestamp", l_orderkey, l_linenumber, l_suppkey, quantity_change) as rn
from (select l_partkey as product_id, 'WH' || lpad(cast(l_suppkey % 5 + 1 as varchar), 3, '0') as warehouse_id,
             l_shipdate as "timestamp", l_orderkey, l_linenumber, l_suppkey,
             case when l_returnflag = 'R' then cast(l_quantity as integer)
                  else -cast(l_quantity as integer) end as quantity_change
      from lineitem)
""")
BLOCKS["walk"] = (("moves",), """
select *, cast(100 as bigint) as quantity_before,
       cast(greatest(0, 100 + quantity_change) as bigint) as quantity_after from moves where rn = 1
union all
select m.*, w.quantity_after, cast(greatest(0, w.quantity_after + m.quantity_change) as bigint)
from walk w join moves m
  on m.product_id = w.product_id and m.warehouse_id = w.warehouse_id and m.rn = w.rn + 1
""")
BLOCKS["ledger"] = (("walk",), "select * exclude (rn) from walk")

BLOCKS["assigned"] = (("stg_sessions",), f"""
select session_id, user_id, converted, add_to_cart_count, duration_seconds, products_viewed, device_type,
       case when right(session_id, 1) in ('0','1','2','3','4','5','6','7')
            then 'control' else 'treatment' end as "group"
from stg_sessions where session_date >= {EVENTS_AS_OF} - 14
""")
BLOCKS["ab"] = (("assigned",), """
select count(*) filter (where "group" = 'control' and converted) as control_converted,
       count(*) filter (where "group" = 'control' and not converted) as control_not_converted,
       count(*) filter (where "group" = 'treatment' and converted) as treatment_converted,
       count(*) filter (where "group" = 'treatment' and not converted) as treatment_not_converted
from assigned
""")

# --- staging ---------------------------------------------------------------------------

_query("bronze_presence", (), """
select 'orders' as table_name, count(*) > 0 as has_rows from orders
union all select 'events', count(*) > 0 from events
union all select 'lineitem', count(*) > 0 from lineitem""")
_query("stg_users", ("users",), "select * from users")
_query("stg_products", ("products",), f"""
select *, base_price - cost_price as gross_margin,
       {_pct('base_price - cost_price', 'base_price')} as margin_pct from products""")
_query("stg_transactions", ("tx",), "select * from tx")
_query("stg_sessions", ("stg_sessions",), "select * from stg_sessions")

_EVENT_COLUMNS = f"""
select cast(o_orderkey as varchar) as order_id, cast(o_custkey as varchar) as user_id,
       coalesce(l_shipdate, o_orderdate) as "timestamp",
       cast(coalesce(l_shipdate, o_orderdate) as date) as order_date,
       cast(o_totalprice as decimal(12,2)) as total_amount,
       case when l_orderkey is null then 0 else 1 end as item_count, p_type as primary_category,
       {MAP_PAYMENT} as payment_method, {MAP_STATUS} as status,
       'NATION_' || (o_orderkey % 25) as country, 'CITY_' || (coalesce(l_suppkey, 0) % 100) as city
from orders left join lineitem on o_orderkey = l_orderkey left join part on l_partkey = p_partkey"""
BLOCKS["order_events"] = ((), _EVENT_COLUMNS)
_query("order_events_flat", ("order_events",), "select * from order_events")
_query("silver_transactions_latest", ("order_events",), """
select * exclude (rn) from (
  select *, row_number() over (partition by order_id
    order by "timestamp" desc, user_id desc, order_date desc, total_amount desc, item_count desc,
             primary_category desc nulls last, payment_method desc, status desc, country desc, city desc) as rn
  from order_events) where rn = 1""")
_query("order_events_nested", ("tx",), """
select cast(order_id as varchar) as order_id, cast(user_id as varchar) as user_id,
       order_timestamp as "timestamp", total_amount, item_count, primary_category from tx""")
_query("silver_sessions_unique", ("ev",), """
select 'S' || (event_id % 500) as session_id, arg_min(user_id, ("timestamp", event_id)) as user_id,
       min("timestamp") as start_time, max("timestamp") as end_time,
       epoch_us(max("timestamp")) // 1000000 - epoch_us(min("timestamp")) // 1000000 as duration_seconds,
       count(*) as page_views,
       count(*) filter (where event_type = 'product_view') as products_viewed,
       count(*) filter (where event_type = 'add_to_cart') as add_to_cart_count,
       count(*) filter (where event_type = 'checkout_complete') > 0 as converted,
       arg_min(device_type, ("timestamp", event_id)) as device_type,
       arg_min(country, ("timestamp", event_id)) as country,
       count(*) filter (where event_type = 'checkout_start') as checkout_initiated,
       count(*) filter (where event_type = 'checkout_complete') as purchased
from ev group by 1""")
_query("order_status_from_event", ("heads",), """
select 'order_' || status as event_type, status, count(*) as orders from heads group by status""")
_query("product_labels", (), """
select p_partkey as product_id, 'SKU-' || upper(left(cast(p_partkey as varchar), 8)) as sku,
       'https://shop.example/' || lower(p_type) || '/' || p_partkey as page_url from part""")
_query("silver_append_idempotent", ("heads",), """
select count(*) as first_run, cast(0 as bigint) as second_run, count(*) as stored_rows,
       cast(sum(total_amount) as decimal(22,2)) as stored_amount from heads""")

_query("silver_build_report", ("sessions",), """
with sizes as (
  select 'transactions' as table_name, count(*) as n from orders
  union all select 'sessions', count(*) from sessions
  union all select 'inventory_snapshots', count(*)
    from (select distinct l_partkey, l_suppkey % 5, cast(l_shipdate as date) from lineitem))
select table_name, n as row_count, n as first_run, n as second_run from sizes""")

# --- sessions and funnel ---------------------------------------------------------------

_query("sessions_by_gap", ("sessions",), "select * from sessions")
_query("sessions_by_id", ("sessions",), "select * from sessions")
_query("agg_funnel", ("stg_sessions",), f"""
with d as (
  select session_date, count(distinct session_id) as total_sessions,
    count(distinct case when page_views > 0 then session_id end) as page_view_sessions,
    count(distinct case when products_viewed > 0 then session_id end) as product_view_sessions,
    count(distinct case when add_to_cart_count > 0 then session_id end) as add_to_cart_sessions,
    count(distinct case when converted then session_id end) as converted_sessions
  from stg_sessions group by session_date)
select *, {_pct('product_view_sessions', 'total_sessions')} as product_view_rate,
       {_pct('add_to_cart_sessions', 'product_view_sessions')} as cart_rate,
       {_pct('converted_sessions', 'add_to_cart_sessions')} as checkout_conversion_rate,
       {_pct('converted_sessions', 'total_sessions')} as overall_conversion_rate from d""")
BLOCKS["steps"] = ((), """
select * from (values (1, 'page_view'), (2, 'product_view'), (3, 'add_to_cart'),
                      (4, 'checkout_start'), (5, 'checkout_complete')) v(step_number, step)""")
BLOCKS["furthest"] = (("ev_session", "steps"), """
select session_id, max(step_number) as step_number
from ev_session join steps on event_type = step group by session_id""")
_query("funnel_furthest_step", ("furthest", "steps"), """
select session_id, f.step_number, step as furthest_step from furthest f join steps s
  on f.step_number = s.step_number""")
_query("funnel_step_reach", ("furthest", "steps"), f"""
select s.step_number, s.step,
       (select count(*) from furthest f where f.step_number >= s.step_number) as sessions_reached,
       {_pct('(select count(*) from furthest f where f.step_number >= s.step_number)',
             '(select count(*) from furthest)')} as reach_pct
from steps s""")

# --- gold --------------------------------------------------------------------------------

_query("dim_customers", ("dim_customers",), "select * from dim_customers")
_query("churned_customers", ("dim_customers",), """
select user_id, tier, last_order_date from dim_customers where is_churned""")
BLOCKS["pareto"] = (("tx",), f"""
with sales as (
  select primary_category, count(*) as order_count, cast(sum(total_amount) as decimal(22,2)) as total_revenue
  from tx where status = 'delivered' group by primary_category),
run as (
  select *, cast(sum(total_revenue) over (order by total_revenue desc nulls last, primary_category nulls last
           rows between unbounded preceding and current row) as decimal(28,2)) as running_total,
         cast(sum(total_revenue) over () as decimal(28,2)) as grand_total from sales)
select *, case when {_ratio('running_total', 'grand_total')} <= 0.80 then 'A'
               when {_ratio('running_total', 'grand_total')} <= 0.95 then 'B' else 'C' end as abc_class
from run""")
_query("category_pareto", ("pareto",), "select * from pareto")
_query("dim_products_abc", ("products", "pareto"), f"""
select p.*, base_price - cost_price as gross_margin,
       {_pct('base_price - cost_price', 'base_price')} as margin_pct,
       coalesce(abc_class, 'C') as abc_class, coalesce(order_count, 0) as total_orders,
       cast(coalesce(total_revenue, 0) as decimal(22,2)) as total_revenue
from products p left join pareto on category = primary_category""")
_query("fct_orders", ("fct_orders",), "select * from fct_orders")
_query("agg_daily_revenue", ("daily_revenue",), "select * from daily_revenue")
_query("agg_rfm_scores", ("rfm",), "select * from rfm")
_query("agg_rfm_scores_nulls_last", ("rfm_nulls_last",), "select * from rfm_nulls_last")
_query("rfm_with_tier", ("rfm", "dim_customers"), """
select r.*, c.tier from rfm r join dim_customers c on r.user_id = c.user_id""")
_query("rfm_segment_summary", ("rfm",), f"""
select rfm_segment, count(*) as customers, cast(sum(monetary) as decimal(28,2)) as revenue,
       {_pct('count(*)', '(select count(*) from rfm)')} as customer_pct
from rfm group by rfm_segment""")
_query("segment_lookup", ("rfm",), """
select user_id, rfm_segment, r_score, f_score, m_score, monetary from rfm
where user_id in (select user_id from events)""")
_query("cohort_retention_calendar", ("cohort",), "select * from cohort")
_query("cohort_retention_30day", ("cohort30",), "select * from cohort30")
_query("cohort_matrix", ("cohort",), "select strftime(cohort_month, '%Y-%m') as cohort_month, " + ", ".join(
    f'max(case when period_number = {p} then retention_rate end) as "Month {p}"' for p in range(12)
) + " from cohort group by 1")
_query("retention_curve", ("cohort",), f"""
select period_number,
       {_round('cast(sum(cast(retention_rate as decimal(9,2))) as double) / count(*)', 6)} as avg_retention,
       count(*) as cohorts from cohort group by period_number""")
_query("agg_churn_features", ("churn",), "select * from churn")
_query("churn_rule_scores", ("churn",), """
select user_id, case when days_since_last_order > 90 then 0.85::double else 0.0::double end as churn_probability,
       days_since_last_order > 90 as is_at_risk, rfm_segment, days_since_last_order
from churn where user_id in (select user_id from events)""")
_query("at_risk_top_k", ("churn",), """
select user_id, 0.9::double as churn_probability, true as is_at_risk, rfm_segment, days_since_last_order
from churn where label order by days_since_last_order desc, user_id limit 20""")

# --- KPIs --------------------------------------------------------------------------------

_query("kpi_orders_today", ("heads",), f"""
select count(*) as "value" from heads where order_date = {AS_OF} - 1""")
_query("kpi_revenue_today", ("heads",), f"""
select cast(sum(total_amount) as decimal(22,2)) as "value" from heads
where order_date = {AS_OF} - 1 and status = 'delivered'""")
_query("kpi_active_sessions", ("sessions",), """
select count(*) as "value" from sessions
where start_time > (select max(ts) from events) - interval 1 hour""")
_query("kpi_conversion_today", ("stg_sessions",), f"""
select {_round('cast(count(*) filter (where converted) as double) * 100 / nullif(count(*), 0)')} as "value"
from stg_sessions where session_date = {EVENTS_AS_OF} - 1""")
_query("kpi_revenue_trend", ("heads",), f"""
select order_date as "time", cast(sum(total_amount) as decimal(22,2)) as revenue from heads
where order_date >= {AS_OF} - 7 group by order_date""")
_query("kpi_top_categories", ("tx",), f"""
select primary_category as metric, count(*) as "value" from tx where order_date >= {AS_OF} - 7
group by primary_category order by 2 desc, 1 nulls last limit 8""")
_query("kpi_latest_order_day", ("heads",), """
select max(order_date) as latest_order_date, max(order_date) is not null as is_ready from heads""")
_query("table_row_counts", ("fct_orders", "rfm", "sessions"), """
select 'transactions' as table_name, count(*) as row_count from orders
union all select 'sessions', count(*) from sessions
union all select 'fct_orders', count(*) from fct_orders
union all select 'dim_customers', count(*) from customer
union all select 'agg_rfm_scores', count(*) from rfm""")

# --- data quality ------------------------------------------------------------------------


def _check(check: str, table: str, failing: str) -> str:
    return (
        f"select '{check}' as check_name, '{table}' as table_name, "
        f"cast(({failing}) as bigint) as failing_rows, ({failing}) = 0 as passed"
    )


def _dup(source: str, key: str) -> str:
    return f"select count(*) from (select {key} from {source} where {key} is not null group by {key} having count(*) > 1)"


def _nulls(source: str, key: str) -> str:
    return f"select count(*) from {source} where {key} is null"


# (table in the report, column in the report, relation, column here)
_KEYS = [
    ("users", "id", "users", "user_id"),
    ("users", "email", "users", "email"),
    ("products", "id", "products", "product_id"),
    ("transactions", "order_id", "tx", "order_id"),
    ("sessions", "session_id", "sessions", "session_id"),
    ("stg_users", "user_id", "users", "user_id"),
    ("stg_products", "product_id", "products", "product_id"),
    ("stg_transactions", "order_id", "tx", "order_id"),
    ("stg_sessions", "session_id", "stg_sessions", "session_id"),
    ("dim_customers", "user_id", "dim_customers", "user_id"),
    ("dim_products", "product_id", "products", "product_id"),
    ("fct_orders", "order_id", "fct_orders", "order_id"),
]
_query(
    "dq_column_tests",
    ("products", "stg_sessions", "fct_orders", "rfm"),
    "\nunion all\n".join(
        [_check(f"unique:{c}", t, _dup(rel, col)) for t, c, rel, col in _KEYS]
        + [_check(f"not_null:{c}", t, _nulls(rel, col)) for t, c, rel, col in _KEYS]
        + [
            _check("not_null:total_revenue", "dim_customers", _nulls("dim_customers", "total_revenue")),
            _check("not_null:user_id", "agg_rfm_scores", _nulls("rfm", "user_id")),
        ]
    ),
)
_query(
    "dq_silver_gate",
    ("heads", "sessions"),
    "\nunion all\n".join(
        [_check(f"not_null:{c}", "transactions", _nulls("heads", c)) for c in ("order_id", "user_id", "total_amount")]
        + [
            _check("negative:total_amount", "transactions", "select count(*) from heads where total_amount < 0"),
            _check("not_null:session_id", "sessions", _nulls("sessions", "session_id")),
        ]
    ),
)
_query(
    "dq_gold_gate",
    ("daily_revenue", "rfm", "stg_sessions"),
    "\nunion all\n".join(
        [
            _check("negative:total_amount", "fct_orders", "select count(*) from fct_orders where total_amount < 0"),
            _check("range:r_score+f_score+m_score", "agg_rfm_scores",
                   "select count(*) from rfm where least(r_score, f_score, m_score) < 1 or greatest(r_score, f_score, m_score) > 5"),
            _check("negative:gross_revenue", "agg_daily_revenue", "select count(*) from daily_revenue where gross_revenue < 0"),
            _check("negative:net_revenue", "agg_daily_revenue", "select count(*) from daily_revenue where net_revenue < 0"),
            _check("above_100:overall_conversion_rate", "agg_funnel",
                   "select count(*) from (select session_date from stg_sessions group by 1 "
                   "having count(*) filter (where converted) > count(*))"),
            _check("min_rows:1", "agg_daily_revenue", "select greatest(0, 1 - count(*)) from daily_revenue"),
            _check("min_rows:1", "agg_rfm_scores", "select greatest(0, 1 - count(*)) from rfm"),
        ]
    ),
)
_query("dq_duplicate_orders", ("heads",), """
select order_id, count(*) as copies from heads group by order_id having count(*) > 1""")
_query("dq_duplicate_events", (), """
select l_orderkey as order_id, count(*) as copies from lineitem group by l_orderkey having count(*) > 1""")
_query(
    "dq_minimum_rows",
    ("daily", "churn"),
    "\nunion all\n".join(
        _check(f"min_rows:{n}", name, f"select greatest(0, {n} - count(*)) from {rel}")
        for name, n, rel in (("churn", 50, "churn"), ("demand", 30, "daily"), ("drift", 20, "churn"))
    ),
)
BLOCKS["click_codes"] = ((), """
select event_id, concat_ws(',', case when not coalesce("value" >= 5, false) then 'city:missing' end,
         case when event_type in ('signup', 'error') then 'event_type:enum' end,
         case when event_type = 'purchase' then 'value:unexpected' end) as violations
from events""")
_query("contract_violations_clickstream", ("click_codes",), "select * from click_codes")
_query("contract_uuid_formats", (), """
select event_id, concat_ws(',', case when not coalesce("value" >= 5, false) then 'city:missing' end,
         case when event_id % 5 = 0 then 'event_id:format' end,
         case when event_type in ('signup', 'error') then 'event_type:enum' end,
         case when event_type = 'error' then 'session_id:format' end,
         case when event_type = 'purchase' then 'value:unexpected' end) as violations
from events""")
_query("contract_violations_inventory", ("ledger",), """
select concat_ws(',', case when quantity_change > 0 then 'event_type:enum' end,
         case when quantity_before + quantity_change < 0 then 'quantity_after:minimum' end) as violations,
       count(*) as events from ledger group by 1""")
_query("contract_violations_orders", (), """
select concat_ws(',', 'discount_amount:missing', case when o_orderstatus = 'O' then 'event_type:enum' end,
         case when l_orderkey is null then 'items:min_items' end, 'shipping_address.zip:missing',
         'shipping_method:missing', 'status:missing', 'subtotal:missing', 'tax_amount:missing') as violations,
       count(*) as events
from orders left join lineitem on o_orderkey = l_orderkey group by 1""")
_query("quarantine_split", ("click_codes",), """
select 'valid' as table_name, count(*) filter (where violations = '') as row_count from click_codes
union all select 'quarantine', count(*) filter (where violations <> '') from click_codes""")

# --- alternate model ---------------------------------------------------------------------

_query("seed_dim_customers", ("seed_customers",), "select * from seed_customers")
_query("seed_dim_products", ("seed_products",), "select * from seed_products")
_query("seed_fct_orders", ("seed_tx", "seed_customers", "products"), """
select t.transaction_id, t.user_id, t.product_id, p.category, p.subcategory, t.quantity, t.unit_price,
       t.total_amount, t.status, t.payment_method, t.created_at, c.tier as customer_tier
from seed_tx t join seed_customers c on t.user_id = c.user_id join products p on t.product_id = p.product_id""")
_query("seed_agg_daily_revenue", ("seed_daily",), "select * from seed_daily")
_query("seed_agg_rfm_scores", ("seed_rfm",), "select * from seed_rfm")
_query("seed_agg_cohort_retention", ("seed_tx",), f"""
with done as (select user_id, cast(date_trunc('month', created_at) as date) as active_month
              from seed_tx where status = 'completed'),
firsts as (select user_id, min(active_month) as cohort_month from done group by user_id),
sizes as (select cohort_month, count(*) as cohort_size from firsts group by cohort_month)
select f.cohort_month, {CALENDAR_PERIOD.replace('cohort_month', 'f.cohort_month')} as months_since_first,
       count(distinct f.user_id) as retained_users, any_value(cohort_size) as cohort_size
from firsts f join done d on f.user_id = d.user_id join sizes s on f.cohort_month = s.cohort_month
where {CALENDAR_PERIOD.replace('cohort_month', 'f.cohort_month')} <= 11 group by 1, 2""")
_query("seed_agg_funnel", ("seed_funnel",), "select * from seed_funnel")
_query("seed_agg_churn_features", ("seed_customers", "seed_rfm"), f"""
select c.user_id, c.total_orders, c.lifetime_value,
       coalesce(cast(floor((epoch(cast({AS_OF} as timestamp)) - epoch(c.last_order_date)) / 86400) as integer), 999)
         as days_since_last_order,
       coalesce(r.recency_days, 999) as recency_days, coalesce(r.frequency, 0) as frequency,
       cast(coalesce(r.monetary, 0) as decimal(22,2)) as monetary, coalesce(r.r_score, 1) as r_score,
       coalesce(r.f_score, 1) as f_score, coalesce(r.m_score, 1) as m_score, c.tier,
       cast(c.is_churned as integer) as label
from seed_customers c left join seed_rfm r on c.user_id = r.user_id""")
_query("seed_build_summary", ("seed_customers", "seed_rfm", "seed_daily", "seed_funnel"), """
select 'ALL DONE' as status, (select count(*) from seed_customers) as customers,
       (select count(*) from seed_rfm) as rfm_rows, (select count(*) from seed_daily) as daily_rev_rows,
       (select count(*) from seed_funnel) as funnel_rows""")

# --- experiments, distributions, drift -----------------------------------------------------

_query("ab_assignment", ("assigned",), "select * from assigned")
_query("ab_summary", ("assigned",), f"""
select "group", count(*) as sessions, count(*) filter (where converted) as conversions,
       {_pct('count(*) filter (where converted)', 'count(*)')} as conversion_rate
from assigned group by "group" """)
_query("ab_lift", ("ab",), f"""
with r as (select cast(control_converted * 100.0 as double) / nullif(control_converted + control_not_converted, 0) as c,
                  cast(treatment_converted * 100.0 as double) / nullif(treatment_converted + treatment_not_converted, 0) as t
           from ab)
select {_round('c', 4)} as control_rate, {_round('t', 4)} as treatment_rate,
       {_round('(t - c) * 100 / nullif(c, 0)', 4)} as lift_pct from r""")
_query("ab_chi2", ("ab",), f"""
with x as (select *, cast(control_converted as double) as a, cast(control_not_converted as double) as b,
                  cast(treatment_converted as double) as c, cast(treatment_not_converted as double) as d from ab),
y as (select *, a + b + c + d as n, greatest(abs(a * d - b * c) - (a + b + c + d) / 2, 0) as dist from x)
select control_converted, control_not_converted, treatment_converted, treatment_not_converted,
       {_round('n * dist * dist / nullif((a + b) * (c + d) * (a + c) * (b + d), 0)', 6)} as chi2,
       1 as dof from y""")


def _histogram(source: str, by: str, bins: int) -> str:
    return f"""
select {by}, bin, {_round('low + bin * width', 6)} as bin_start, count(*) as n,
       cast(round(cast(cast(count(*) as double) / nullif(total * width, 0) as decimal(38,16)), 8) as double) as density
from (select *, cast(least(floor((v - low) / width), {bins - 1}) as integer) as bin
      from (select {by}, v, total, first_v - margin as low,
                   (last_v + margin - (first_v - margin)) / {bins} as width
            from (select *, case when first_v = last_v then 0.5::double else 0.0::double end as margin
                  from (select *, min(v) over w as first_v, max(v) over w as last_v, count(*) over w as total
                        from {source} window w as (partition by {by})))))
group by {by}, bin, low, width, total"""


BLOCKS["durations"] = (("assigned",), """
select "group", cast(least(greatest(duration_seconds, 0), 600) as double) as v from assigned""")
_query("duration_histogram", ("durations",), _histogram("durations", '"group"', 40))
BLOCKS["feature_values"] = (("churn",), "\nunion all\n".join(
    f"select '{c}' as feature, label, cast({c} as double) as v from churn"
    for c in ("days_since_last_order", "total_orders", "rfm_total", "total_sessions_30d")
))
BLOCKS["feature_clipped"] = (("feature_values",), """
select feature, label, least(greatest(v, 0), q) as v from feature_values
join (select feature, label, quantile_cont(v, 0.99) as q from feature_values group by feature, label)
using (feature, label)""")
_query("feature_histograms", ("feature_clipped",), _histogram("feature_clipped", "feature, label", 30))
_query("dataset_profile", ("heads",), f"""
select count(*) as row_count, count(distinct strftime(order_date, '%Y-%m')) as distinct_keys,
       min(order_date) as first_date, max(order_date) as last_date,
       {_round("cast(count(*) filter (where status = 'delivered') as double) / count(*)", 6)} as mean_value
from heads""")
BLOCKS["halves"] = (("churn",), """
select *, row_number() over (order by user_id) > (select count(*) from churn) // 2 as is_current from churn""")
DRIFT_COLUMNS = ("days_since_last_order", "total_orders", "rfm_total")
FRAME_COLUMNS = (
    "days_since_last_order", "total_orders", "total_revenue", "avg_order_value", "cancellation_rate",
    "r_score", "f_score", "m_score", "rfm_total", "avg_session_duration", "avg_products_viewed",
    "total_sessions_30d", "label",
)
BLOCKS["ks_values"] = (("halves",), "\nunion all\n".join(
    f"select '{c}' as \"column\", is_current, cast({'cast(label as integer)' if c == 'label' else c} as double) as v"
    " from halves"
    for c in FRAME_COLUMNS
))
_SERIES = " + ".join(f"({2.0 * (-1) ** (k - 1)}) * exp(-{2.0 * k * k} * x * x)" for k in range(1, 21))
BLOCKS["ks"] = (("ks_values",), f"""
with sizes as (
  select "column", count(*) filter (where not is_current) as n_ref,
         count(*) filter (where is_current) as n_cur from ks_values where v is not null group by "column"),
cdf as (
  select "column", v, sum(count(*) filter (where not is_current)) over w as r,
         sum(count(*) filter (where is_current)) over w as c
  from ks_values where v is not null group by "column", v window w as (partition by "column" order by v)),
dist as (
  select "column", n_ref, n_cur, max(abs(cast(r as double) / n_ref - cast(c as double) / n_cur)) as d
  from cdf join sizes using ("column") group by "column", n_ref, n_cur),
xs as (select *, sqrt(cast(n_ref as double) * n_cur / (n_ref + n_cur)) * d as x from dist)
select *, case when x < 0.2 then 1.0 else least(greatest({_SERIES}, 0.0), 1.0) end as p from xs""")
_query("drift_ks", ("ks",), f"""
select "column", n_ref, n_cur, {_round('d', 8)} as ks_statistic, {_round('p', 6)} as p_value,
       p < 0.05 as drifted from ks where "column" in {DRIFT_COLUMNS}""")
_query("drift_dataset", ("ks",), f"""
select {_round('cast(count(*) filter (where p < 0.05) as double) / count(*)', 4)} as drift_share,
       cast(count(*) filter (where p < 0.05) as double) / count(*) >= 0.5 as drift_detected from ks""")

# --- demand ------------------------------------------------------------------------------

_query("busiest_days_tail", ("daily",), """
select order_date, total_orders from daily order by total_orders desc, order_date desc limit 15""")
_query("daily_demand", ("daily",), "select * from daily")


def _daily_features(frame7: str, frame30: str) -> str:
    return f"""
select * from (
  select order_date, total_orders, gross_revenue, cast(isodow(order_date) - 1 as integer) as day_of_week,
         cast(month(order_date) as integer) as "month", cast(quarter(order_date) as integer) as "quarter",
         case when isodow(order_date) >= 6 then 1 else 0 end as is_weekend,
         lag(total_orders, 1) over w as lag_1, lag(total_orders, 7) over w as lag_7,
         lag(total_orders, 14) over w as lag_14,
         case when count(*) over (order by order_date rows between {frame7}) = 7 then
           {_round(f'cast(sum(total_orders) over (order by order_date rows between {frame7}) as double) / 7', 6)} end as rolling_7,
         case when count(*) over (order by order_date rows between {frame30}) = 30 then
           {_round(f'cast(sum(total_orders) over (order by order_date rows between {frame30}) as double) / 30', 6)} end as rolling_30,
         avg_order_value, cancellation_rate_pct
  from daily window w as (order by order_date))
where lag_14 is not null and rolling_30 is not null"""


_query("demand_features_daily", ("daily",), _daily_features(
    "7 preceding and 1 preceding", "30 preceding and 1 preceding"))
_query("demand_features_daily_inclusive", ("daily",), _daily_features(
    "6 preceding and current row", "29 preceding and current row"))
_query("demand_features_category", ("daily_revenue",), """
select order_date, primary_category, total_orders, cast(isodow(order_date) - 1 as integer) as day_of_week,
       cast(month(order_date) as integer) as "month",
       coalesce(lag(total_orders, 7) over w, 0) as lag_7, coalesce(lag(total_orders, 14) over w, 0) as lag_14,
       avg_order_value, cancellation_rate_pct
from daily_revenue window w as (partition by primary_category order by order_date)""")
BLOCKS["recent"] = (("daily",), "select * from daily order by order_date desc limit 30")
_query("demand_recent_days", ("recent",), f"""
select order_date, total_orders, cast(isodow(order_date) - 1 as integer) as day_of_week,
       cast(month(order_date) as integer) as "month",
       coalesce(cast(lag(total_orders, 7) over w as double), m) as lag_7,
       coalesce(cast(lag(total_orders, 14) over w as double), m) as lag_14,
       avg_order_value, cancellation_rate_pct
from recent, (select {_round('avg(total_orders)', 6)} as m from recent) window w as (order by order_date)""")
_query("demand_forecast_rule", ("recent",), f"""
select d as forecast_date,
       {_round('(select avg(total_orders) from recent) * case when isodow(d) >= 6 then 1.3::double else 1.0::double end', 1)}
         as predicted_orders
from (select {AS_OF} + cast(i as integer) as d from range(1, 8) t(i))""")
_query("demand_folds", ("daily",), """
with numbered as (select order_date, row_number() over (order by order_date) - 1 as i,
                         count(*) over () as n from daily),
roles as (
  select fold, order_date,
         case when i < n - (4 - fold) * (n // 4) then 'train'
              when i < n - (3 - fold) * (n // 4) then 'test' end as role
  from numbered, (values (1), (2), (3)) f(fold))
select fold, role, count(*) as days, min(order_date) as first_day, max(order_date) as last_day
from roles where role is not null group by fold, role""")
_query("demand_chronological_split", ("daily_revenue",), """
with days as (select distinct order_date from daily_revenue),
ranked as (select order_date, row_number() over (order by order_date) as i, count(*) over () as n from days),
roles as (select order_date, case when i > n - ceil(n * 0.2::double) then 'test' else 'train' end as role from ranked)
select role, count(*) as "rows", min(order_date) as first_day, max(order_date) as last_day
from daily_revenue join roles using (order_date) group by role""")

# --- stock and pricing -------------------------------------------------------------------

_query("inventory_ledger", ("ledger",), "select * from ledger")
BLOCKS["closing"] = (("walk",), """
select product_id, warehouse_id, cast("timestamp" as date) as snapshot_date,
       arg_max(quantity_after, rn) as quantity, count(*) as event_count
from walk group by all""")
_query("inventory_snapshot", ("closing",), "select * from closing")
_query("inventory_snapshot_compat", ("closing",), """
select * replace (cast(1 as bigint) as event_count) from closing""")
_query("inventory_latest_stock", ("walk",), """
select product_id, warehouse_id, arg_max(quantity_after, rn) as quantity, max("timestamp") as as_of
from walk group by product_id, warehouse_id""")
_query("ledger_continuity", ("walk",), """
select * exclude (rn) from (
  select *, lag(quantity_after) over (partition by product_id, warehouse_id order by rn) as expected_before
  from walk where quantity_change < 0) where expected_before <> quantity_before""")
_query("order_pricing_check", (), """
with subs as (
  select l_orderkey, cast(round(sum(cast(l_extendedprice as decimal(12,2))
           * (1 - cast(l_discount as decimal(4,2)))), 2) as decimal(18,2)) as s
  from lineitem group by l_orderkey),
a as (select o_orderkey as order_id, coalesce(s, 0) as subtotal, o_orderkey % 2 = 0 as has_coupon,
             cast(o_totalprice as decimal(12,2)) as stated_total
      from orders left join subs on o_orderkey = l_orderkey),
b as (select *, cast(case when has_coupon then round(subtotal * cast(0.10 as decimal(4,2)), 2) else 0 end
                     as decimal(18,2)) as discount_amount from a),
c as (select *, cast(round((subtotal - discount_amount) * cast(0.08 as decimal(4,2)), 2) as decimal(18,2))
             as tax_amount from b),
d as (select *, cast(subtotal - discount_amount + tax_amount as decimal(18,2)) as total_amount from c)
select order_id, subtotal, discount_amount, tax_amount, total_amount, stated_total,
       abs(total_amount - stated_total) > 0.01 as mismatch from d""")

ORACLE["order_pricing_from_items"] = ORACLE["order_pricing_check"].replace(
    "select order_id, subtotal", "select cast(order_id as varchar) as order_id, subtotal"
)

# --- models --------------------------------------------------------------------------------

_query("rfm_standardized", ("rfm",), "select user_id, " + ", ".join(
    f"""coalesce({_round(f"(cast({c} as double) - (select avg(cast({c} as double)) from rfm))"
                        f" / nullif((select stddev_pop(cast({c} as double)) from rfm), 0)", 6)}, 0.0::double) as z_{c}"""
    for c in ("recency_days", "frequency", "monetary")
) + " from rfm")

# --- streaming: the batch result over the same rows, minus what the watermark withholds -------

_query("stream_bronze_clickstream", (), """
select cast(event_id as varchar) as event_id, cast(user_id as varchar) as user_id,
       md5(cast(event_id as varchar)) as session_id, ts as "timestamp",
       case event_type when 'view' then 'product_view' when 'click' then 'add_to_cart'
         when 'purchase' then 'checkout_complete' else event_type end as event_type,
       'https://shop.example/toys/' || json_extract_string(props, '$.k') as page_url,
       case when "value" >= 5 then 'Springfield' end as city
from events""")
_query("stream_bronze_feeds", (), """
select 'clickstream' as table_name, count(*) as row_count from events
union all select 'orders', count(*) from orders
union all select 'inventory', count(*) from lineitem""")
_query("stream_bronze_orders", (), """
select cast(o_orderkey as varchar) as order_id, cast(o_custkey as varchar) as user_id,
       cast(o_orderdate as timestamp) as "timestamp", cast(cast(o_totalprice as decimal(12,2)) as double) as total_amount,
       case when l_orderkey is not null then cast(row_number() over (partition by o_orderkey
         order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount) - 1 as integer) end as place,
       cast(l_partkey as varchar) as product_id, p_type as category,
       cast(cast(l_extendedprice as decimal(12,2)) as double) as unit_price,
       cast(cast(l_discount as decimal(4,2)) as double) as discount_pct
from orders left join lineitem on o_orderkey = l_orderkey left join part on l_partkey = p_partkey""")
_query("stream_bronze_inventory", ("ledger",), """
select concat_ws('-', l_orderkey, l_linenumber, product_id, l_suppkey) as inventory_id,
       cast(product_id as varchar) as product_id, "timestamp",
       case when quantity_change > 0 then 'refund' else 'sale' end as event_type,
       cast(quantity_change as integer) as quantity_change, cast(quantity_before as integer) as quantity_before,
       cast(quantity_before + quantity_change as integer) as quantity_after, warehouse_id,
       cast(9.5 as double) as unit_cost
from ledger""")
_UNIQUE_EVENTS = """
select event_id, user_id, "timestamp", event_type, cast(json_extract_string(props, '$.k') as integer) as product_id,
       device_type, country
from ev join (select event_id, props from events) using (event_id)"""
_query("stream_dedupe", ("ev",), _UNIQUE_EVENTS)
_query("stream_unique_append", ("ev",), _UNIQUE_EVENTS)
_query("stream_sessions", ("sessions",), """
select session_id, user_id, start_time, end_time, duration_seconds, page_views, products_viewed,
       add_to_cart_count, converted
from sessions""")
_query("stream_order_kpis", ("heads",), """
select cast(order_date as timestamp) as window_start, cast(order_date + 1 as timestamp) as window_end,
       count(*) as orders, cast(sum(total_amount) as decimal(22,2)) as gross_revenue,
       cast(sum(total_amount) filter (where status = 'delivered') as decimal(22,2)) as net_revenue,
       count(distinct user_id) as customers
from heads group by order_date""")
_query("stream_active_users", (), """
with spans as (
  select time_bucket(interval 15 minute, ts) - i * interval 15 minute as window_start, user_id
  from events, range(0, 4) t(i))
select window_start, window_start + interval 1 hour as window_end, count(*) as events,
       count(distinct user_id) as users
from spans group by window_start""")
_query("stream_latest_stock", ("walk",), """
select product_id, warehouse_id, arg_max(quantity_after, rn) as quantity_after, max("timestamp") as as_of
from walk group by product_id, warehouse_id""")
_query("stream_quarantine_records", ("click_codes",), """
select cast(event_id as varchar) as event_id, cast(user_id as varchar) as user_id,
       md5(cast(event_id as varchar)) as session_id, ts as "timestamp",
       case event_type when 'view' then 'product_view' when 'click' then 'add_to_cart'
         when 'purchase' then 'checkout_complete' else event_type end as event_type,
       'https://shop.example/toys/' || json_extract_string(props, '$.k') as page_url,
       case when "value" >= 5 then 'Springfield' end as city, ts as source_timestamp
from events join click_codes using (event_id) where violations = '' and event_id % 50 not in (7, 8)""")
_query("stream_quarantine_rejects", ("click_codes",), """
select case when event_id % 50 <> 7 then cast(event_id as varchar) end as event_id,
       case when event_id % 50 = 7
            then substr('{"event_id":"' || event_id || '","user_id":"' || user_id || '","session_id":', 1, 30)
       end as payload,
       case event_id % 50 when 7 then 'not_json'
            when 8 then array_to_string(list_sort(list_filter(string_split(violations, ',')
                          || ['event_id:missing', 'id:unexpected'], lambda x: x <> '')), ',')
            else violations end as violations,
       ts as source_timestamp
from events join click_codes using (event_id) where violations <> '' or event_id % 50 in (7, 8)""")
_query("stream_late_ledger", (), """
with parted as (
  select ts, least(floor(event_id * 5 / ((select max(event_id) from events) + 1))
                   + case when event_id % 89 = 0 then 2 else 0 end, 4) as batch_id from events),
ends as (select batch_id, max(ts) as last from parted group by batch_id),
marks as (
  select batch_id, max(last) over (order by batch_id) as newest_event,
         max(last) over (order by batch_id rows between unbounded preceding and 1 preceding) - interval 1 hour
           as watermark from ends),
counted as (
  select batch_id, count(*) as rows, count(*) filter (where ts <= watermark) as late_rows,
         any_value(watermark) as watermark, any_value(newest_event) as newest_event
  from parted join marks using (batch_id) group by batch_id)
select cast(batch_id as bigint) as batch_id, rows, late_rows,
       cast(sum(rows) over (order by batch_id) as bigint) as total_rows,
       cast(sum(late_rows) over (order by batch_id) as bigint) as total_late_rows, watermark, newest_event
from counted""")
_query("stream_stock_compacted", ("walk",), """
select product_id, warehouse_id, arg_max(quantity_after, rn) as quantity_after, max("timestamp") as as_of
from walk group by product_id, warehouse_id""")

# --- models: what does not depend on a fit -------------------------------------------------

BLOCKS["labeled"] = (("churn",), """
select user_id, cast(cast(label as integer) as double) as label,
       coalesce(cast(days_since_last_order as double), 0) as days, coalesce(cast(total_orders as double), 0) as orders
from churn where label is not null""")
BLOCKS["ranked_scores"] = (("labeled",), """
with s as (
  select 'recency' as model, label, days / (days + 30) as score from labeled
  union all select 'orders', label, 1 / (1 + orders) from labeled
  union all select 'constant', label, 0.5::double from labeled),
counts as (
  select model, score, count(*) filter (where label = 1) as positives, count(*) filter (where label = 0) as negatives
  from s group by model, score)
select *, sum(positives) over so_far as tp, sum(negatives) over so_far as fp,
       sum(positives) over (partition by model) as p, sum(negatives) over (partition by model) as n
from counts window so_far as (partition by model order by score desc)""")
_query("churn_split", ("labeled",), """
select user_id, label,
       row_number() over (partition by label order by md5('42|' || user_id), user_id)
         <= floor(count(*) over (partition by label) * 0.2::double + 0.5::double) as held_out from labeled""")
_query("roc_of_given_scores", ("ranked_scores",), f"""
select model, {_round('score', 9)} as score, {_round('cast(fp as double) / nullif(n, 0)', 9)} as fpr,
       {_round('cast(tp as double) / nullif(p, 0)', 9)} as tpr from ranked_scores""")
_query("auc_of_given_scores", ("ranked_scores",), f"""
with areas as (
  select model, {_round('sum(positives * (n - fp + cast(negatives as double) / 2)) / nullif(any_value(p * n), 0)', 9)} as auc
  from ranked_scores group by model),
cut as (
  select model, label, case when score >= 0.5 then 1.0::double else 0.0::double end as prediction, rows
  from (select model, score, 1.0::double as label, positives as rows from ranked_scores
        union all select model, score, 0.0::double, negatives from ranked_scores))
select model, label, prediction, cast(sum(rows) as bigint) as rows, any_value(auc) as auc
from cut join areas using (model) where rows > 0 group by model, label, prediction""")
# The p-value by the series of erf, in logarithms; p is 1 - erf(sqrt(chi2 / 2)).
ORACLE["ab_significance"] = f"""
with tested as ({ORACLE["ab_chi2"]}),
valued as (
  select *, case when chi2 is null then null when chi2 = 0 then 1.0::double else 1 - 2 / sqrt(pi()) * exp(-chi2 / 2)
           * list_sum(list_transform(range(0, 150), lambda k: exp((2 * k + 1) * ln(sqrt(chi2 / 2)) + 2 * k * ln(2)
                                                                  + lgamma(k + 1) - lgamma(2 * k + 2)))) end as tail
  from tested)
select * exclude (tail), {_round('greatest(tail, 0)', 6)} as p_value, tail < 0.05 as significant from valued"""
