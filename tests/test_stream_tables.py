"""Streams with several outputs: quarantine, late rows, compacted updates; restarts and retries."""

import datetime as dt
import json

import pytest

from tidemart import schemas
from tidemart.operators.contracts import INVENTORY
from tidemart.plans import queries
from tidemart.session import fresh_dir
from tidemart.sources import folders
from tidemart.streaming import batches, compaction, ingest, late, quarantine

NOW = {"availableNow": True}
START = dt.datetime(2025, 1, 1)
RAW = "value string, timestamp timestamp"
GOOD = {
    "inventory_id": "i1", "product_id": "p", "product_name": "n", "category": "c", "sku": "s",
    "timestamp": "2025-01-01T00:00:00Z", "event_type": "sale", "quantity_change": -2, "quantity_before": 5,
    "quantity_after": 3, "warehouse_id": "W", "supplier_id": None, "unit_cost": 1.5,
}


def _add(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def _records():
    wrong = {**GOOD, "inventory_id": "i2", "event_type": "theft"}
    keyless = {k: v for k, v in GOOD.items() if k != "inventory_id"}
    return [json.dumps(GOOD), "{broken", "", json.dumps(wrong), json.dumps(keyless), "[1]", None]


def test_bad_records_are_kept_with_reasons(spark):
    source, base = fresh_dir(spark, "t-source"), fresh_dir(spark, "t-quarantine")
    _add(spark, source, [(x, START) for x in _records()], RAW)
    stream = ingest.file_stream(spark, source, RAW, max_files=1)
    feed = ingest.Feed("inventory", stream, schemas.INVENTORY, INVENTORY)

    def run():
        for query in ingest.start_feeds([feed], f"{base}/b", f"{base}/c", NOW):
            ingest.drain(query)

    run()
    _add(spark, source, [(json.dumps({**GOOD, "inventory_id": "i9"}), START), ("{late", START)], RAW)
    run()  # restarted: only the new file
    root = f"{base}/b/inventory"
    good = quarantine.read_records(spark, root, schemas.INVENTORY)
    assert sorted(r.inventory_id for r in good.collect()) == ["i1", "i9"]
    assert good.select("ingestion_date").distinct().count() == 1
    bad = {r.value: r.violations for r in quarantine.read_quarantine(spark, root).collect()}
    assert set(bad) == {*_records()[1:], "{late"}
    assert bad["{broken"] == bad[""] == bad["[1]"] == bad[None] == ["not_json"]
    assert bad[_records()[3]] == ["event_type:enum"] and bad[_records()[4]] == ["inventory_id:missing"]


def test_outputs_of_a_batch_appear_together(spark):
    root = fresh_dir(spark, "t-commit")
    raw = spark.createDataFrame([(json.dumps(GOOD), START), ("{x", START)], RAW)
    rows = quarantine.checked(raw, schemas.INVENTORY, INVENTORY)

    def seen():
        return (
            quarantine.read_records(spark, root, schemas.INVENTORY).count(),
            quarantine.read_quarantine(spark, root).count(),
        )

    assert seen() == (0, 0)
    quarantine.store_batch(rows, 0, schemas.INVENTORY, root)
    assert seen() == (1, 1)
    # A batch that failed before its commit shows nothing; its retry replaces what it had left.
    batches.write_batch(rows.select("value", "violations"), root, quarantine.QUARANTINE, 1)
    assert seen() == (1, 1)
    for _ in range(2):
        quarantine.store_batch(rows, 1, schemas.INVENTORY, root)
        assert seen() == (2, 2)
    # Nothing but bad records: the records can still be read.
    quarantine.store_batch(rows.filter("size(violations) > 0"), 2, schemas.INVENTORY, root)
    assert seen() == (2, 3)


def test_without_a_contract_only_the_key_counts(spark):
    raw = spark.createDataFrame([(json.dumps({"inventory_id": "a"}), START), ('{"sku": "x"}', START), ("{", START)], RAW)
    found = quarantine.checked(raw, schemas.INVENTORY, None).select("value", "violations").collect()
    assert [r.violations for r in found] == [[], ["no_key"], ["no_key"]]


EVENT = "event_id long, timestamp timestamp"


def _at(*minutes):
    return [(i, None if m is None else START + dt.timedelta(minutes=m)) for i, m in enumerate(minutes)]


def test_late_rows_survive_a_restart(spark):
    source, base = fresh_dir(spark, "t-source"), fresh_dir(spark, "t-late")

    def run():
        stream = ingest.file_stream(spark, source, EVENT, max_files=1)
        ingest.drain(late.write_on_time(stream, "timestamp", "10 minutes", f"{base}/t", f"{base}/c", NOW, "clicks"))

    _add(spark, source, _at(0, 100, 1), EVENT)  # nothing before: no row is late
    _add(spark, source, _at(90, 91, 300, None), EVENT)  # 90 is not after 100 - 10
    run()
    _add(spark, source, _at(200), EVENT)  # late after the restart too
    _add(spark, source, _at(295, 290), EVENT)
    run()
    ledger = late.late_ledger(spark, f"{base}/t").orderBy("batch_id").collect()
    assert [(r.rows, r.late_rows, r.total_rows, r.total_late_rows) for r in ledger] == [
        (3, 0, 3, 0), (4, 1, 7, 1), (1, 1, 8, 2), (2, 1, 10, 3),
    ]
    assert {r.query for r in ledger} == {"clicks"} and ledger[0].watermark is None
    assert ledger[3].newest_event == START + dt.timedelta(minutes=300)
    kept = late.read_late(spark, f"{base}/t", EVENT).collect()
    assert sorted((r.timestamp - START).seconds // 60 for r in kept) == [90, 200, 290]
    assert late.read_on_time(spark, f"{base}/t", EVENT).count() == 7


def test_a_retried_batch_counts_once(spark):
    root = fresh_dir(spark, "t-late")
    first, second = (spark.createDataFrame(_at(*m), EVENT) for m in ((0, 100), (5, 120)))
    late.store_batch(first, 0, "timestamp", "10 minutes", root, "q")
    for _ in range(3):
        late.store_batch(second, 1, "timestamp", "10 minutes", root, "q")
        last = late.late_ledger(spark, root).orderBy("batch_id").collect()[-1]
        assert (last.total_rows, last.total_late_rows) == (4, 1)


UPDATE = "product_id long, quantity long"


def test_compacted_updates_equal_the_whole_history(spark):
    path, state = fresh_dir(spark, "t-compact"), {}
    for batch in range(23):
        rows = [(k, 100 * batch + k) for k in range(batch % 3, 40, 7 + batch % 5)]
        state.update(dict(rows))
        updates = spark.createDataFrame(rows, UPDATE).coalesce(1)
        for _ in range(2 if batch in (4, 9, 10) else 1):  # some batches are retried
            compaction.store_batch(updates, batch, path, ["product_id"], every=5)
        if batch in (0, 4, 5, 9, 14, 22):
            table = compaction.read_compacted(spark, path, ["product_id"])
            assert {r.product_id: r.quantity for r in table.collect()} == state
            read = {f.split("through=")[1].split("/")[0] + ("b" if "/base/" in f else "c") for f in table.inputFiles()}
            assert len(read) <= 2
    kept = [folders.numbered_folders(spark, f"{path}/{kind}", "through") for kind in ("base", "changes")]
    assert sum(map(len, kept)) <= 5


def test_reading_before_the_first_batch(spark):
    with pytest.raises(FileNotFoundError):
        compaction.read_compacted(spark, fresh_dir(spark, "t-none"), ["product_id"])


def test_a_stock_batch_is_read_by_several_tasks(spark, sf_dir, tmp_path, monkeypatch):
    """Each micro-batch used to be one file, written and read by one task."""
    monkeypatch.setattr(queries, "fresh_dir", lambda session, label: f"{tmp_path}/{label}")
    stored = queries.QUERIES["stream_stock_compacted"](spark, sf_dir)
    assert stored.count() == spark.read.parquet(f"{tmp_path}/stock/events").select("product_id", "warehouse_id").distinct().count()
    files = list((tmp_path / "stock" / "events").glob("*.parquet"))
    batches = [x for x in (tmp_path / "stock" / "checkpoint" / "commits").iterdir() if x.name.isdigit()]
    assert len(batches) == queries.STOCK_BATCHES and len(files) == queries.STOCK_BATCHES * spark.sparkContext.defaultParallelism
