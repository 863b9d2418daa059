"""Streams over files: ingestion, dedupe, late rows, sessions, stock."""

import datetime as dt
import json
import time


from tidemart import schemas
from tidemart.operators import sessions as batch
from tidemart.session import fresh_dir
from tidemart.streaming import ingest, stateful

NOW = {"availableNow": True}
START = dt.datetime(2025, 1, 1)
EVENT = "event_id long, user_id long, timestamp timestamp, event_type string, device_type string, country string"


def _files(spark, parts, schema):
    """One file per part, so that each part is its own micro-batch."""
    path = fresh_dir(spark, "t-stream")
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    return path


def _stream(spark, parts, schema=EVENT):
    return ingest.file_stream(spark, _files(spark, parts, schema), schema, max_files=1)


def _run(spark, stream, partition_by=None):
    base = fresh_dir(spark, "t-out")
    query = ingest.write_stream(stream, f"{base}/t", f"{base}/c", "t", NOW, partition_by=partition_by)
    ingest.drain(query)
    return query, spark.read.schema(stream.schema).parquet(f"{base}/t")


def _event(i, user, seconds, kind="page_view"):
    return (i, user, START + dt.timedelta(seconds=seconds), kind, "mobile", "X")


def test_bronze_ingestion_drops_only_unparsed_records(spark):
    good = {"inventory_id": "i1", "product_id": "p", "quantity_change": 2, "timestamp": "2025-01-01T00:00:00Z"}
    rows = [(json.dumps(good), START), ("{broken", START), (json.dumps({"product_id": "no key"}), START)]
    stream = _stream(spark, [rows], "value string, timestamp timestamp")
    base = fresh_dir(spark, "t-bronze")
    feed = ingest.Feed("inventory", stream, schemas.INVENTORY)
    for query in ingest.start_feeds([feed], f"{base}/b", f"{base}/c", NOW):
        ingest.drain(query)
    stored = spark.read.parquet(f"{base}/b/inventory")
    got = stored.collect()
    assert len(got) == 1 and got[0].inventory_id == "i1" and got[0].quantity_change == 2
    assert got[0].source_timestamp == START
    assert {"ingestion_date", "ingestion_timestamp"} <= set(stored.columns)


def test_restart_reads_only_new_files(spark):
    source = _files(spark, [[("a", START)]], "value string, timestamp timestamp")
    base = fresh_dir(spark, "t-restart")
    schema = "value string, timestamp timestamp"

    def run():
        stream = ingest.file_stream(spark, source, schema)
        ingest.drain(ingest.write_stream(stream, f"{base}/t", f"{base}/c", "r", NOW, partition_by=None))

    run()
    run()
    spark.createDataFrame([("b", START)], schema).write.mode("append").parquet(source)
    run()
    assert sorted(r.value for r in spark.read.schema(schema).parquet(f"{base}/t").collect()) == ["a", "b"]


def test_dedupe_across_batches_and_late_rows(spark):
    parts = [
        [_event(1, 1, 0), _event(2, 1, 10), _event(1, 1, 0)],
        [_event(1, 1, 5), _event(3, 1, 7200)],
        [_event(5, 1, 7250)],    # late rows are judged by the watermark of the batch before
        [_event(9, 1, 60)],      # two hours behind the newest event: too late
        [_event(4, 1, 7300)],
    ]
    late = stateful.LateRows()
    spark.streams.addListener(late)
    query, out = _run(spark, stateful.dedupe(_stream(spark, parts), "event_id", "timestamp", "10 minutes"))
    assert sorted(r.event_id for r in out.collect()) == [1, 2, 3, 4, 5]
    assert stateful.dropped_late_rows(query) == 1
    for _ in range(50):
        if late.dropped[str(query.id)]:
            break
        time.sleep(0.1)
    spark.streams.removeListener(late)
    assert late.dropped[str(query.id)] == 1


def test_streamed_sessions_equal_batch_sessions(spark):
    kinds = ["page_view", "product_view", "add_to_cart", "checkout_complete"]
    rows = [_event(i, i % 3, 40 * i + (3000 if i > 60 else 0), kinds[i % 4]) for i in range(120)]
    flush = _event(999, 7, 100_000)
    _, out = _run(spark, stateful.sessions(_stream(spark, [rows[:50], rows[50:], [flush]]), "10 minutes", "10 minutes"))
    whole = batch.sessionize_by_gap(spark.createDataFrame(rows, EVENT), 600).select(*out.columns)
    assert sorted(out.collect()) == sorted(whole.collect())


def test_windowed_kpis(spark):
    schema = "order_id long, user_id long, order_timestamp timestamp, status string, total_amount decimal(12,2)"
    from decimal import Decimal as D

    parts = [
        [(1, 1, START, "delivered", D("5.00")), (2, 1, START + dt.timedelta(hours=3), "pending", D("2.00"))],
        [(3, 2, START + dt.timedelta(days=1), "delivered", D("1.00"))],
        [(4, 2, START + dt.timedelta(days=5), "delivered", D("1.00"))],
    ]
    _, out = _run(spark, stateful.order_kpis(_stream(spark, parts, schema), "1 day", "1 hour"))
    got = {r.window_start.day: (r.orders, r.gross_revenue, r.net_revenue, r.customers) for r in out.collect()}
    assert got[1] == (2, D("7.00"), D("5.00"), 1) and got[2][0] == 1


def test_sliding_users(spark):
    parts = [[_event(1, 1, 0), _event(2, 2, 1000)], [_event(3, 3, 50_000)]]
    _, out = _run(spark, stateful.active_users(_stream(spark, parts), "1 hour", "30 minutes", "1 hour"))
    got = {r.window_start: (r.events, r.users) for r in out.collect()}
    assert got[START] == (2, 2) and got[START - dt.timedelta(minutes=30)] == (2, 2)


def test_latest_stock_over_batches(spark):
    schema = "product_id long, warehouse_id string, timestamp timestamp, quantity_after long"
    later = START + dt.timedelta(hours=1)
    parts = [[(1, "A", later, 5), (2, "A", START, 8)], [(1, "A", START, 99), (2, "A", later, 3)]]
    stream = _stream(spark, parts, schema)
    keys = ["product_id", "warehouse_id"]
    base = fresh_dir(spark, "t-stock")
    updates = stateful.stock_changes(stream, keys, ["timestamp"], "quantity_after")
    ingest.drain(stateful.write_updates(updates, f"{base}/t", f"{base}/c", NOW))
    got = {r.product_id: (r.quantity_after, r.as_of) for r in stateful.read_newest(spark, f"{base}/t", keys).collect()}
    assert got == {1: (5, later), 2: (3, later)}


def test_stop(spark):
    stream = _stream(spark, [[_event(1, 1, 0)]])
    base = fresh_dir(spark, "t-stop")
    query = ingest.write_stream(
        stream, f"{base}/t", f"{base}/c", "stop", {"processingTime": "1 second"}, partition_by=None
    )
    query.processAllAvailable()
    query.stop()
    ingest.run_until_stopped(spark, [query])
    assert not query.isActive
