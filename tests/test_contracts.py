"""Event contracts, quality rules and the gates."""

import copy
import json

import pytest

from tidemart.operators import contracts, quality

ORDER = {
    "order_id": "o1", "user_id": "u1", "event_type": "order_created", "timestamp": "2025-01-01T10:00:00+00:00",
    "items": [{"product_id": "p", "product_name": "n", "category": "Toys", "quantity": 1, "unit_price": 2.5, "discount_pct": 0.1}],
    "subtotal": 2.25, "discount_amount": 0, "tax_amount": 0.18, "total_amount": 2.43, "payment_method": "paypal",
    "shipping_method": "express", "shipping_address": {"country": "US", "city": "X", "zip": "1"},
    "coupon_code": None, "status": "created",
}
STOCK = {
    "inventory_id": "i", "product_id": "p", "product_name": "n", "category": "Toys", "sku": "SKU-P",
    "timestamp": "2025-01-01T10:00:00Z", "event_type": "sale", "quantity_change": -1, "quantity_before": 3,
    "quantity_after": 2, "warehouse_id": "WH001", "supplier_id": None, "unit_cost": 9.99,
}


def _codes(spark, contract, *records):
    texts = [(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(records)]
    df = spark.createDataFrame(texts, "n int, value string")
    rows = contracts.validate(df, contract).orderBy("n").collect()
    return [sorted(r.violations) for r in rows]


def _changed(base, **changes):
    record = copy.deepcopy(base)
    for key, value in changes.items():
        if value is KeyError:
            del record[key]
        else:
            record[key] = value
    return record


def test_order_contract(spark):
    item = ORDER["items"][0]
    cases = [
        (ORDER, []),
        (_changed(ORDER, coupon_code="SAVE10"), []),
        (_changed(ORDER, coupon_code=KeyError), []),
        (_changed(ORDER, user_id=KeyError), ["user_id:missing"]),
        (_changed(ORDER, user_id=None), ["user_id:type"]),
        (_changed(ORDER, user_id=5), ["user_id:type"]),
        (_changed(ORDER, total_amount="2.43"), ["total_amount:type"]),
        (_changed(ORDER, total_amount=-0.01), ["total_amount:minimum"]),
        (_changed(ORDER, event_type="order_lost"), ["event_type:enum"]),
        (_changed(ORDER, timestamp="yesterday"), ["timestamp:format"]),
        (_changed(ORDER, items=[]), ["items:min_items"]),
        (_changed(ORDER, items={}), ["items:type"]),
        (_changed(ORDER, items=[item, {**item, "quantity": 0}, {**item, "quantity": 0.5, "discount_pct": 101}]),
         ["items:discount_pct", "items:quantity"]),
        (_changed(ORDER, shipping_address={"country": "US", "city": 7}),
         ["shipping_address.city:type", "shipping_address.zip:missing"]),
        (_changed(ORDER, note="x", extra=1), ["extra:unexpected", "note:unexpected"]),
        ("{broken", ["not_json"]),
        ("[1, 2]", ["not_json"]),
    ]
    assert _codes(spark, contracts.ORDERS, *[c[0] for c in cases]) == [c[1] for c in cases]


def test_stock_contract(spark):
    cases = [
        (STOCK, []),
        (_changed(STOCK, quantity_after=-1, quantity_change=1.5), ["quantity_after:minimum", "quantity_change:type"]),
        (_changed(STOCK, supplier_id="SUP001"), []),
        (_changed(STOCK, event_type="transfer", sku=KeyError), ["event_type:enum", "sku:missing"]),
    ]
    assert _codes(spark, contracts.INVENTORY, *[c[0] for c in cases]) == [c[1] for c in cases]


def test_uuid_formats_where_asked_for(spark):
    good = "123e4567-e89b-12d3-a456-426614174000"
    bad = ["o1", good + "\n", good.replace("-", ""), good[:-1] + "g", "{" + good + "}", ""]
    strict = contracts.with_uuid_formats(contracts.ORDERS)
    records = [_changed(ORDER, order_id=x) for x in (good, good.upper(), *bad, None, 7)]
    found = _codes(spark, strict, *records, _changed(ORDER, order_id=KeyError))
    assert found == [[], [], *[["order_id:format"]] * len(bad), *[["order_id:type"]] * 2, ["order_id:missing"]]
    assert _codes(spark, contracts.ORDERS, *records[:8]) == [[]] * 8
    # Keys of other parties are text, whatever the reader asks for.
    assert not strict["user_id"].uuid and strict["order_id"].uuid and not contracts.ORDERS["order_id"].uuid


def test_split_keeps_every_record(spark):
    df = spark.createDataFrame([(json.dumps(STOCK),), ("nope",)], "value string")
    valid, rejected = contracts.split_valid(contracts.validate(df, contracts.INVENTORY))
    assert valid.count() == 1 and valid.columns == ["value"]
    assert [r.violations for r in rejected.collect()] == [["not_json"]]


@pytest.fixture(scope="module")
def bad_tables(spark):
    orders = spark.createDataFrame(
        [("a", "u", 5.0), ("a", "u", -1.0), (None, None, 2.0)], "order_id string, user_id string, total_amount double"
    )
    sessions = spark.createDataFrame([("s",), (None,)], "session_id string")
    return {"transactions": orders, "sessions": sessions}


def test_silver_gate_and_duplicates(bad_tables):
    report = {(r.table_name, r.check_name): (r.failing_rows, r.passed) for r in quality.silver_gate(bad_tables).collect()}
    assert report == {
        ("transactions", "not_null:order_id"): (1, False),
        ("transactions", "not_null:user_id"): (1, False),
        ("transactions", "not_null:total_amount"): (0, True),
        ("transactions", "negative:total_amount"): (1, False),
        ("sessions", "not_null:session_id"): (1, False),
    }
    copies = quality.duplicate_keys(bad_tables["transactions"], "order_id").collect()
    assert [tuple(r) for r in copies] == [("a", 2)]
    with pytest.raises(ValueError, match="transactions.not_null:order_id: 1 failing"):
        quality.require_passed(quality.silver_gate(bad_tables))


def test_unique_and_minimum_rows(bad_tables):
    unique = quality.check_unique(bad_tables, [("transactions", "order_id"), ("sessions", "session_id")])
    assert {(r.table_name, r.failing_rows) for r in unique.collect()} == {("transactions", 1), ("sessions", 0)}
    minimum = quality.check_minimum_rows(bad_tables, {"transactions": 3, "sessions": 5})
    assert {(r.table_name, r.failing_rows, r.passed) for r in minimum.collect()} == {
        ("transactions", 0, True), ("sessions", 3, False),
    }


def test_out_of_range_scores(spark):
    scores = spark.createDataFrame([(1, 5, 3), (0, 2, 2), (3, 6, 1)], "r_score int, f_score int, m_score int")
    rule = quality.out_of_range("scores", ["r_score", "f_score", "m_score"], 1, 5)
    row = quality.check_rows({"scores": scores}, [rule]).collect()[0]
    assert row.failing_rows == 2
