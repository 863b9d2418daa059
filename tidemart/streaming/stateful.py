"""Streaming forms of dedupe, sessions, KPIs and latest stock.

The watermark delay is the late-data rule: rows older than the newest event time
minus the delay no longer change a result, and the dropped ones are counted in
the query progress.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemart.operators.sessions import session_key
from tidemart.sources.sinks import append_new


def dedupe(stream: DataFrame, key: str, timestamp: str, delay: str) -> DataFrame:
    """First record of each key within the delay; see write_unique for very hot keys."""
    return stream.withWatermark(timestamp, delay).dropDuplicatesWithinWatermark([key])


def write_unique(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], trigger: dict
) -> StreamingQuery:
    """Append only records whose key is not stored yet, without a delay limit.

    Copies inside a micro-batch collapse map-side before the shuffle, so a record
    that arrives very often does not fill one task.  A retried batch finds what it
    has already written and adds nothing.
    """

    def store(batch: DataFrame, _batch_id: int) -> None:
        append_new(batch, path, keys)

    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(store)
        .trigger(**trigger)
        .start()
    )


def sessions(stream: DataFrame, gap: str, delay: str, timestamp: str = "timestamp") -> DataFrame:
    """Sessions per user, emitted once the watermark has passed their end."""
    kind = F.col("event_type")
    return (
        stream.withWatermark(timestamp, delay)
        .groupBy("user_id", F.session_window(timestamp, gap).alias("span"))
        .agg(
            F.min(timestamp).alias("start_time"),
            F.max(timestamp).alias("end_time"),
            F.count(F.lit(1)).alias("page_views"),
            F.count_if(kind == "product_view").alias("products_viewed"),
            F.count_if(kind == "add_to_cart").alias("add_to_cart_count"),
            F.count_if(kind == "checkout_complete").alias("purchased"),
        )
        .select(
            session_key(F.col("user_id"), F.col("start_time")).alias("session_id"),
            "user_id",
            "start_time",
            "end_time",
            (F.unix_timestamp("end_time") - F.unix_timestamp("start_time")).alias("duration_seconds"),
            "page_views",
            "products_viewed",
            "add_to_cart_count",
            (F.col("purchased") > 0).alias("converted"),
        )
    )


def order_kpis(
    stream: DataFrame, size: str, delay: str, timestamp: str = "order_timestamp"
) -> DataFrame:
    """Orders, revenue and customers per tumbling window.

    One state row per window and user, then one per window: the users are counted
    exactly, and a window's state goes when the watermark has passed it.
    """
    delivered = F.when(F.col("status") == "delivered", F.col("total_amount"))
    per_user = (
        stream.withWatermark(timestamp, delay)
        .groupBy(F.window(timestamp, size).alias("span"), "user_id")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("total_amount").alias("gross"),
            F.sum(delivered).alias("net"),
        )
    )
    return (
        per_user.groupBy("span")
        .agg(
            F.sum("orders").alias("orders"),
            F.sum("gross").cast("decimal(22,2)").alias("gross_revenue"),
            F.sum("net").cast("decimal(22,2)").alias("net_revenue"),
            F.count("user_id").alias("customers"),
        )
        .select(F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"),
                "orders", "gross_revenue", "net_revenue", "customers")
    )


def active_users(
    stream: DataFrame, size: str, slide: str, delay: str, timestamp: str = "timestamp"
) -> DataFrame:
    """Events and users per sliding window, counted as in order_kpis."""
    per_user = (
        stream.withWatermark(timestamp, delay)
        .groupBy(F.window(timestamp, size, slide).alias("span"), "user_id")
        .agg(F.count(F.lit(1)).alias("events"))
    )
    return (
        per_user.groupBy("span")
        .agg(F.sum("events").alias("events"), F.count("user_id").alias("users"))
        .select(F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"),
                "events", "users")
    )


def stock_changes(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], quantity: str
) -> DataFrame:
    """Newest quantity per key so far; updated keys only (update mode).

    max_by keeps one row of state per key, combined map-side.
    """
    return stream.groupBy(*keys).agg(
        F.max(F.struct(*order, quantity)).alias("newest")
    ).select(*keys, F.col(f"newest.{quantity}").alias(quantity), F.col(f"newest.{order[0]}").alias("as_of"))


def write_updates(
    updates: DataFrame, path: str, checkpoint: str, trigger: dict
) -> StreamingQuery:
    """Store each micro-batch's updated keys under its batch number.

    A batch that is retried after a failure replaces its own folder.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        updates.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
        .trigger(**trigger)
        .start()
    )


def read_newest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The last stored update of each key."""
    rows = spark.read.parquet(path)
    rest = [c for c in rows.columns if c not in (*keys, "batch_id")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("row"))
    return newest.select(*keys, *[F.col(f"row.{c}").alias(c) for c in rest])


class LateRows(StreamingQueryListener):
    """Adds up, per query, the rows behind the watermark that were left out.

    Register it before the queries start; it keeps counting where a query's own
    progress list, which Spark cuts to the newest updates, would forget.
    """

    def __init__(self) -> None:
        self.dropped: Counter[str] = Counter()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.dropped[str(progress.id)] += sum(x.numRowsDroppedByWatermark for x in progress.stateOperators)

    def onQueryTerminated(self, event) -> None:
        pass


def dropped_late_rows(query: StreamingQuery) -> int:
    """Rows left out in the updates that the query still remembers; see LateRows for all."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
