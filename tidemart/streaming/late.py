"""Late rows, kept and counted durably.

A row is late when its event time is not after the watermark of the micro-batches before its own:
the newest event time they held, less the delay.  Stateful operators drop such rows and remember
the number only while they run.  Here each micro-batch is split in ``rows`` and ``late``, and its
commit (batches.py) is a ledger row with the totals so far.  The watermark is taken from that
ledger, so restarts and retries see the same one and the sums go on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemart.sources.folders import numbered_folders
from tidemart.streaming.batches import BATCH, COMMITS, read_batches, write_batch

ROWS, LATE = "rows", "late"
LEDGER = (
    "query string, rows long, late_rows long, total_rows long, total_late_rows long, "
    "watermark timestamp, newest_event timestamp"
)


def _before(spark: SparkSession, root: str, batch_id: int):
    """The ledger row of the last committed batch before this one, if any.  It holds all totals."""
    earlier = [n for n in numbered_folders(spark, f"{root}/{COMMITS}", BATCH) if n < batch_id]
    return spark.read.schema(LEDGER).parquet(f"{root}/{COMMITS}/{BATCH}={earlier[-1]}").first() if earlier else None


def store_batch(batch: DataFrame, batch_id: int, timestamp: str, delay: str, root: str, label: str) -> None:
    """Split a micro-batch, then add its ledger row."""
    spark = batch.sparkSession
    before = _before(spark, root, batch_id)
    newest = F.lit(before.newest_event if before else None).cast("timestamp")
    watermark = newest - F.expr(f"interval {delay}")
    batch = batch.persist()
    try:
        late = F.coalesce(F.col(timestamp) <= watermark, F.lit(False))
        write_batch(batch.filter(~late), root, ROWS, batch_id)
        write_batch(batch.filter(late), root, LATE, batch_id)
        found = batch.agg(
            F.lit(label).alias("query"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if(late).alias("late_rows"),
            (F.count(F.lit(1)) + F.lit(before.total_rows if before else 0)).alias("total_rows"),
            (F.count_if(late) + F.lit(before.total_late_rows if before else 0)).alias("total_late_rows"),
            watermark.alias("watermark"),
            F.greatest(newest, F.max(timestamp)).cast("timestamp").alias("newest_event"),
        )
        write_batch(found, root, COMMITS, batch_id)
    finally:
        batch.unpersist()


def write_on_time(
    stream: DataFrame, timestamp: str, delay: str, root: str, checkpoint: str, trigger: dict, label: str = "stream"
) -> StreamingQuery:
    """Store a stream's rows that are on time, its late ones, and the ledger."""
    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: store_batch(batch, batch_id, timestamp, delay, root, label))
        .trigger(**trigger)
        .start()
    )


def read_on_time(spark: SparkSession, root: str, schema) -> DataFrame:
    return read_batches(spark, root, ROWS, schema)


def read_late(spark: SparkSession, root: str, schema) -> DataFrame:
    return read_batches(spark, root, LATE, schema)


def late_ledger(spark: SparkSession, root: str) -> DataFrame:
    """One row per committed micro-batch, with its number, its rows and the totals up to it."""
    return read_batches(spark, root, COMMITS, LEDGER)
