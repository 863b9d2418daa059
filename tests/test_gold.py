"""Edge cases of the gold tables on hand-made frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemart.operators import churn, cohorts, customers, funnel, orders, products, rfm, seed, staging

AS_OF = dt.date(2025, 6, 30)
ORDER_COLUMNS = "order_id long, user_id long, order_timestamp timestamp, status string, total_amount decimal(12,2), primary_category string"


def _day(text):
    return dt.datetime.fromisoformat(text)


def _orders(spark, rows):
    df = spark.createDataFrame(rows, ORDER_COLUMNS)
    return df.withColumn("order_date", F.col("order_timestamp").cast("date")).withColumns(
        {c: F.lit(None).cast("string") for c in ("payment_method", "country", "city")}
    ).withColumn("item_count", F.lit(1))


def _users(spark, ids):
    rows = [(i, f"u{i}@example.com", f"u{i}", dt.date(2024, 1, 1), "X", "gold") for i in ids]
    return spark.createDataFrame(
        rows, "user_id long, email string, name string, signup_date date, country string, tier string"
    )


@pytest.fixture(scope="module")
def shop(spark):
    from decimal import Decimal as D

    facts = _orders(
        spark,
        [
            (1, 1, _day("2025-06-30 00:00:00"), "delivered", D("10.00"), "a"),
            (2, 2, _day("2025-04-01 00:00:00"), "cancelled", D("5.00"), "a"),   # 90 days
            (3, 3, _day("2025-03-31 00:00:00"), "delivered", D("7.00"), "b"),   # 91 days
            (4, 4, _day("2025-05-01 08:00:00"), "delivered", D("3.00"), "b"),
            (5, 4, _day("2025-05-01 20:00:00"), "delivered", D("4.00"), "a"),
            (6, 4, _day("2025-06-01 20:00:00"), "pending", D("1.00"), None),
            (7, 99, _day("2025-06-01 20:00:00"), "delivered", D("2.00"), "a"),  # unknown user
        ],
    )
    return facts, _users(spark, [1, 2, 3, 4, 5])


def test_customer_metrics(shop):
    facts, users = shop
    dim = {r.user_id: r for r in customers.dim_customers(users, facts, AS_OF).collect()}
    assert set(dim) == {1, 2, 3, 4, 5}
    assert (dim[5].total_orders, dim[5].days_since_last_order, dim[5].is_churned) == (0, 9999.0, False)
    assert dim[2].days_since_last_order == 90.0 and not dim[2].is_churned
    assert dim[3].days_since_last_order == 91.0 and dim[3].is_churned
    assert dim[1].annual_revenue_rate == 0.0  # first order today: no days to divide by
    assert dim[4].total_orders == 3 and dim[4].completed_orders == 2
    assert dim[3].predicted_clv_3yr == pytest.approx(3 * round(7 / 91 * 365, 2))


def test_fact_keeps_unknown_users_and_flags_first_day(shop):
    facts, users = shop
    dim = customers.dim_customers(users, facts, AS_OF)
    rows = {r.order_id: r for r in orders.fct_orders(facts, dim).collect()}
    assert len(rows) == 7
    assert rows[4].is_first_order and rows[5].is_first_order and not rows[6].is_first_order
    assert rows[7].customer_tier is None and rows[7].is_first_order is False
    assert rows[1].order_week == dt.date(2025, 6, 30)  # a Monday


def test_daily_revenue_adds_up(shop):
    facts, users = shop
    dim = customers.dim_customers(users, facts, AS_OF)
    daily = orders.agg_daily_revenue(orders.fct_orders(facts, dim))
    total = daily.agg(F.sum("gross_revenue"), F.sum("total_orders")).collect()[0]
    assert tuple(total) == (facts.agg(F.sum("total_amount")).collect()[0][0], 7)
    april = daily.filter("order_date = '2025-04-01'").collect()[0]
    assert april.net_revenue is None and april.cancellation_rate_pct == 100.0


def test_an_order_stored_twice_counts_once(shop):
    facts, users = shop
    twice = facts.unionByName(facts.filter("order_id = 4"))
    dim = customers.dim_customers(users, facts, AS_OF)
    daily = orders.agg_daily_revenue(orders.fct_orders(twice, dim))
    assert daily.agg(F.sum("total_orders")).first()[0] == 7
    assert daily.agg(F.sum("gross_revenue")).first()[0] == twice.agg(F.sum("total_amount")).first()[0]
    raw = {r.user_id: r.frequency for r in rfm.rfm_raw(twice, AS_OF).collect()}
    assert raw == {r.user_id: r.frequency for r in rfm.rfm_raw(facts, AS_OF).collect()}


def test_rfm_null_order(shop):
    facts, _ = shop
    zero = {r.user_id: r for r in rfm.agg_rfm_scores(facts, AS_OF).collect()}
    last = {r.user_id: r for r in rfm.agg_rfm_scores(facts, AS_OF, null_monetary="last").collect()}
    assert zero[2].m_score == 1 and last[2].m_score == 5
    assert zero[2].monetary == 0
    assert all(1 <= s <= 5 for r in zero.values() for s in (r.r_score, r.f_score, r.m_score))


def test_rfm_segment_rules(spark):
    rows = [(r, f, m) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6)]
    df = spark.createDataFrame(rows, "r_score int, f_score int, m_score int")
    seen = {tuple(x[:3]): x[3] for x in df.select("*", rfm.segment_column()).collect()}
    assert seen[(5, 5, 5)] == "Champions"
    assert seen[(3, 3, 3)] == "Loyal Customers"
    assert seen[(5, 1, 5)] == "Recent Customers"
    assert seen[(3, 1, 4)] == "Potential Loyalists"
    assert seen[(2, 3, 3)] == "At Risk"
    assert seen[(1, 2, 1)] == "Cannot Lose Them"
    assert seen[(1, 1, 1)] == "Lost"
    assert seen[(3, 1, 1)] == "Hibernating"
    assert len(set(seen.values())) == 8


def test_cohorts_across_year_and_february(spark):
    from decimal import Decimal as D

    moments = {
        1: ["2024-12-31", "2025-01-01", "2025-11-30", "2025-12-01"],  # periods 0, 1, 11, 12
        2: ["2025-02-01", "2025-03-31"],
        3: ["2025-02-28"],
    }
    rows, n = [], 0
    for user, days in moments.items():
        for day in days * 2:  # repeated orders count once
            n += 1
            rows.append((n, user, _day(day), "delivered", D("1.00"), "a"))
    got = {
        (r.cohort_month.isoformat(), r.period_number): (r.active_users, r.cohort_size, r.retention_rate)
        for r in cohorts.agg_cohort_retention(_orders(spark, rows)).collect()
    }
    assert got == {
        ("2024-12-01", 0): (1, 1, 100.0),
        ("2024-12-01", 1): (1, 1, 100.0),
        ("2024-12-01", 11): (1, 1, 100.0),
        ("2025-02-01", 0): (2, 2, 100.0),
        ("2025-02-01", 1): (1, 2, 50.0),
    }
    by_30 = cohorts.agg_cohort_retention(_orders(spark, rows), period="30day")
    february = [r.period_number for r in by_30.filter("cohort_month = '2025-02-01'").collect()]
    assert sorted(february) == [0.0, pytest.approx(28 / 30)]


def test_abc_on_exact_limits(spark):
    from decimal import Decimal as D

    amounts = {"a": D("80.00"), "b": D("15.00"), "c": D("5.00")}
    rows = [(i, 1, _day("2025-01-01"), "delivered", v, k) for i, (k, v) in enumerate(amounts.items())]
    facts = _orders(spark, rows)
    items = spark.createDataFrame([(k, k) for k in "abcd"], "product_id string, category string")
    got = {r.product_id: (r.abc_class, r.total_orders) for r in products.dim_products(items, facts).collect()}
    assert got == {"a": ("A", 1), "b": ("B", 1), "c": ("C", 1), "d": ("C", 0)}


def test_funnel_with_zero_denominator(spark):
    rows = [(dt.date(2025, 1, 1), "s1", 2, 0, 0, False), (dt.date(2025, 1, 2), "s2", 2, 1, 1, True)]
    df = spark.createDataFrame(
        rows,
        "session_date date, session_id string, page_views int, products_viewed int, add_to_cart_count int, converted boolean",
    )
    got = {r.session_date.day: r for r in funnel.agg_funnel(df).collect()}
    assert got[1].cart_rate is None and got[1].checkout_conversion_rate is None
    assert got[2].overall_conversion_rate == 100.0


def test_churn_features_and_rule(spark, shop):
    facts, users = shop
    dim = customers.dim_customers(users, facts, AS_OF)
    scores = rfm.agg_rfm_scores(facts, AS_OF)
    visits = spark.createDataFrame(
        [(4, dt.date(2025, 5, 31), 60, 2), (4, dt.date(2025, 5, 30), 30, 1)],
        "user_id long, session_date date, duration_seconds long, products_viewed long",
    )
    features = churn.agg_churn_features(dim, scores, visits, AS_OF)
    got = {r.user_id: r for r in features.collect()}
    assert set(got) == {1, 2, 3, 4}  # no orders, no row
    assert got[4].avg_session_duration == 45.0 and got[4].total_sessions_30d == 1
    assert got[1].total_sessions_30d == 0 and got[2].cancellation_rate == 100.0
    rule = {r.user_id: (r.churn_probability, r.is_at_risk) for r in churn.churn_rule_scores(features).collect()}
    assert rule[3] == (0.85, True) and rule[2] == (0.0, False)
    listed = churn.at_risk_customers(features, dim).collect()
    assert [r.user_id for r in listed] == [3]


def test_seed_customer_without_completed_orders(spark):
    users = _users(spark, [1, 2]).withColumnRenamed("user_id", "id")
    lines = spark.createDataFrame(
        [("t1", 1, "pending", _day("2025-01-01"))],
        "transaction_id string, user_id long, status string, created_at timestamp",
    ).withColumn("total_amount", F.lit("500").cast("decimal(12,2)"))
    got = {r.user_id: r for r in seed.dim_customers(users, lines, AS_OF).collect()}
    assert (got[1].total_orders, got[1].tier, got[1].is_churned) == (0, "Bronze", False)
    assert len(got) == 2


def test_flatten_orders_with_and_without_items(spark):
    from tidemart.schemas import ORDERS

    item = ("p", "name", "toys", 2, 1.0, 0.0)
    address = ("US", "Rome", "1")

    def row(key, items, moment="2025-01-01"):
        return (key, "u", "order_delivered", _day(moment), items, 1.0, 0.0, 0.0, 1.0, "paypal", "express", address, None, None)

    raw = spark.createDataFrame(
        [row("1", None), row("2", []), row("3", [item]), row("4", [item, ("q", "n", "food", 1, 1.0, 0.0)]),
         row("3", [], "2025-01-02")],
        ORDERS,
    )
    flat = {(r.order_id, r.order_date.day): r for r in staging.flatten_orders(raw).collect()}
    assert [flat[(k, 1)].item_count for k in "1234"] == [0, 0, 1, 2]
    assert flat[("2", 1)].primary_category is None and flat[("4", 1)].primary_category == "toys"
    assert flat[("1", 1)].status == "delivered" and flat[("1", 1)].city == "Rome"
    silver = {r.order_id: r for r in staging.silver_transactions(raw).collect()}
    assert len(silver) == 4 and silver["3"].order_date.day == 2
