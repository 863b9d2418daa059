"""Stock ledger against a sequential loop, continuity, and order pricing."""

import datetime as dt
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tidemart.operators import inventory, pricing

START = dt.datetime(2025, 1, 1)
ORDER = ("timestamp", "seq")
COLUMNS = "product_id long, warehouse_id string, timestamp timestamp, seq long, quantity_change int"


def _moves(n, keys, seed):
    rnd = random.Random(seed)
    rows, when = [], START
    for i in range(n):
        when += dt.timedelta(minutes=rnd.choice([0, 0, 1, 600]))
        # The first key gets a third of all rows.
        key = keys[0] if rnd.random() < 0.33 else rnd.choice(keys)
        rows.append((key, f"WH{key % 2}", when, i, rnd.randint(-60, 45)))
    return rows


def _walk(rows, opening):
    level, out = {}, {}
    for product, warehouse, _, seq, change in rows:
        before = level.get((product, warehouse), opening)
        after = max(0, before + change)
        level[(product, warehouse)] = after
        out[seq] = (before, after)
    return out


def _fine():
    return [F.col("timestamp").cast("date"), F.floor(F.col("seq") / 7)]


@pytest.mark.parametrize("opening,chunk", [(0, None), (100, None), (100, _fine)])
def test_ledger_matches_a_sequential_walk(spark, opening, chunk):
    rows = _moves(2000, [1, 2, 3, 4, 5], opening)
    df = spark.createDataFrame(rows, COLUMNS).repartition(6)
    ledger = inventory.stock_ledger(df, ORDER, opening=opening, chunk=chunk and chunk())
    got = {r.seq: (r.quantity_before, r.quantity_after) for r in ledger.collect()}
    assert got == _walk(rows, opening)


def test_continuity_and_snapshots(spark):
    rows = _moves(600, [1, 2, 3], 8)
    ledger = inventory.stock_ledger(spark.createDataFrame(rows, COLUMNS), ORDER)
    assert inventory.broken_links(ledger, ORDER).count() == 0
    tampered = ledger.withColumn(
        "quantity_before", F.when(F.col("seq") == 300, F.lit(-1)).otherwise(F.col("quantity_before"))
    )
    for chunk in (None, _fine()):
        assert [r.seq for r in inventory.broken_links(tampered, ORDER, chunk=chunk).collect()] == [300]

    walked = _walk(rows, 100)
    closing, counts = {}, {}
    for product, warehouse, when, seq, _ in rows:
        key = (product, warehouse, when.date())
        closing[key] = walked[seq][1]
        counts[key] = counts.get(key, 0) + 1
    snap = inventory.daily_snapshot(ledger, ORDER).collect()
    assert {(r.product_id, r.warehouse_id, r.snapshot_date): (r.quantity, r.event_count) for r in snap} == {
        k: (closing[k], counts[k]) for k in closing
    }
    compat = inventory.daily_snapshot(ledger, ORDER, compat=True)
    assert {r.event_count for r in compat.collect()} == {1}
    newest = {(r.product_id, r.warehouse_id): r.quantity for r in inventory.latest_stock(ledger, ORDER).collect()}
    assert newest == {k[:2]: closing[k] for k in sorted(closing)}


def test_pricing(spark):
    lines = spark.createDataFrame(
        [("a", D("10.00"), 2, D("0.10")), ("a", D("3.33"), 1, D("0.00")), ("b", D("5.00"), 1, D("0.05"))],
        "order_id string, unit_price decimal(12,2), quantity int, discount_pct decimal(4,2)",
    )
    heads = spark.createDataFrame(
        [("a", "SAVE10", D("20.73")), ("b", None, D("9.99")), ("c", None, D("0.00"))],
        "order_id string, coupon_code string, stated_total decimal(12,2)",
    )
    got = {r.order_id: r for r in pricing.price_orders(lines, heads).collect()}
    assert (got["a"].subtotal, got["a"].discount_amount, got["a"].tax_amount) == (D("21.33"), D("2.13"), D("1.54"))
    assert got["a"].total_amount == D("20.74") and not got["a"].mismatch
    assert got["b"].total_amount == D("5.13") and got["b"].mismatch
    assert got["c"].total_amount == 0 and not got["c"].mismatch


def test_item_lines(spark):
    from tidemart.schemas import ORDERS

    items = [("p", "n", "toys", 2, 1.5, 0.1), ("q", "n", "toys", 1, 4.0, 0.0)]
    raw = spark.createDataFrame([("o", "u") + (None,) * 2 + (items,) + (None,) * 9], ORDERS)
    got = pricing.item_lines(raw).collect()
    assert [(r.unit_price, r.quantity, r.discount_pct) for r in got] == [(D("1.50"), 2, D("0.10")), (D("4.00"), 1, D("0.00"))]


@pytest.mark.parametrize("fine", [False, True])
def test_closing_stock_without_the_ledger(spark, fine):
    chunk = _fine() if fine else None
    moves = spark.createDataFrame(_moves(500, [1, 2, 3, 4], 5), COLUMNS).repartition(4)
    ledger = inventory.stock_ledger(moves, ORDER, chunk=chunk)
    wanted = inventory.daily_snapshot(ledger, ORDER)
    found = inventory.daily_closing_stock(moves, ORDER, chunk=chunk)
    assert found.dtypes == wanted.dtypes
    assert sorted(found.collect()) == sorted(wanted.collect())
