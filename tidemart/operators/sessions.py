"""Sessions from clickstream events.

Events carry either a session id or only a user and a time.  In the second case
sessions are cut where a user pauses for longer than a gap.  A busy user may own
a third of all events, so events are never windowed per user.  Time is divided
into cells one gap wide: two events of one user in one cell can never be in
different sessions.  A map-side-combined aggregation reduces the events to
(user, cell) rows, of which a user has at most duration / gap, and only these
go through the per-user window.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.schemas import FUNNEL_STEPS


def _cell(timestamp: str, gap_seconds: int) -> Column:
    """Start of the gap-wide stretch of time an event falls into, in microseconds."""
    micros = F.unix_micros(F.col(timestamp))
    return micros - F.pmod(micros, F.lit(gap_seconds * 1_000_000))


def _measures(timestamp: str) -> list[Column]:
    kind = F.col("event_type")
    first_seen = F.struct(timestamp, "event_id", "user_id", "device_type", "country")
    return [
        F.min(timestamp).alias("start_time"),
        F.max(timestamp).alias("end_time"),
        F.min(first_seen).alias("first_event"),
        F.count(F.lit(1)).alias("page_views"),
        F.count_if(kind == "product_view").alias("products_viewed"),
        F.count_if(kind == "add_to_cart").alias("add_to_cart_count"),
        F.count_if(kind == "checkout_start").alias("checkout_initiated"),
        F.count_if(kind == "checkout_complete").alias("purchased"),
    ]


def _finish(sessions: DataFrame) -> DataFrame:
    """Session columns shared by both routes; user, device and country are the earliest event's."""
    return sessions.select(
        "session_id",
        F.col("first_event.user_id").alias("user_id"),
        "start_time",
        "end_time",
        (F.unix_timestamp("end_time") - F.unix_timestamp("start_time")).alias("duration_seconds"),
        "page_views",
        "products_viewed",
        "add_to_cart_count",
        (F.col("purchased") > 0).alias("converted"),
        F.col("first_event.device_type").alias("device_type"),
        F.col("first_event.country").alias("country"),
        "checkout_initiated",
        "purchased",
    )


def session_key(user: Column, start: Column) -> Column:
    return F.md5(
        F.concat_ws("|", user.cast("string"), F.unix_micros(start).cast("string"))
    )


def _with_session_start(cells: DataFrame, gap_seconds: int) -> DataFrame:
    """Mark each (user, cell) row with the start of the session it belongs to."""
    in_time = W.partitionBy("user_id").orderBy("cell")
    pause = F.unix_micros("start_time") - F.unix_micros(F.lag("end_time").over(in_time))
    opens = F.coalesce(pause > gap_seconds * 1_000_000, F.lit(True))
    return cells.withColumn("opened_at", F.when(opens, F.col("start_time"))).withColumn(
        "session_start", F.last("opened_at", ignorenulls=True).over(in_time)
    ).drop("opened_at")


def assign_sessions(
    events: DataFrame, gap_seconds: int, timestamp: str = "timestamp"
) -> DataFrame:
    """Add a session_id to each event, cut at pauses longer than the gap."""
    keyed = events.withColumn("cell", _cell(timestamp, gap_seconds))
    cells = keyed.groupBy("user_id", "cell").agg(
        F.min(timestamp).alias("start_time"), F.max(timestamp).alias("end_time")
    )
    starts = _with_session_start(cells, gap_seconds).select(
        F.col("user_id").alias("__user"), F.col("cell").alias("__cell"), "session_start"
    )
    same = F.col("user_id").eqNullSafe(F.col("__user")) & (F.col("cell") == F.col("__cell"))
    return keyed.join(starts, same).select(
        *events.columns, session_key(F.col("user_id"), F.col("session_start")).alias("session_id")
    )


def sessionize(events: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """One row per given session id, whoever its events name."""
    return _finish(events.groupBy("session_id").agg(*_measures(timestamp)))


def sessionize_by_gap(
    events: DataFrame, gap_seconds: int, timestamp: str = "timestamp"
) -> DataFrame:
    """Sessions straight from events without session ids; events are read once."""
    cells = (
        events.withColumn("cell", _cell(timestamp, gap_seconds))
        .groupBy("user_id", "cell")
        .agg(*_measures(timestamp))
    )
    counts = ("page_views", "products_viewed", "add_to_cart_count", "checkout_initiated", "purchased")
    merged = (
        _with_session_start(cells, gap_seconds)
        .groupBy("user_id", "session_start")
        .agg(
            F.min("start_time").alias("start_time"),
            F.max("end_time").alias("end_time"),
            F.min("first_event").alias("first_event"),
            *[F.sum(c).alias(c) for c in counts],
        )
        .withColumn("session_id", session_key(F.col("user_id"), F.col("session_start")))
    )
    return _finish(merged)


def sessions_started_between(
    events: DataFrame, low: dt.datetime, high: dt.datetime, gap_seconds: int, timestamp: str = "timestamp"
) -> DataFrame:
    """The sessions of sessionize_by_gap that start in [low, high), from the events around it only.

    Whether an event opens a session depends on one gap before it, so events from
    low - gap on are enough.  Sessions may last beyond high: the upper end grows,
    twice as far each time, until no session that started in time is still open.
    """
    gap = dt.timedelta(seconds=gap_seconds)
    reach = gap
    while True:
        near = (F.col(timestamp) >= F.lit(low - gap)) & (F.col(timestamp) < F.lit(high + reach))
        found = sessionize_by_gap(events.filter(near), gap_seconds, timestamp).filter(
            (F.col("start_time") >= F.lit(low)) & (F.col("start_time") < F.lit(high))
        )
        # A pause of exactly one gap does not end a session.
        if found.filter(F.col("end_time") >= F.lit(high + reach - gap)).isEmpty():
            return found
        reach *= 2


def funnel_progress(events: DataFrame) -> DataFrame:
    """Furthest funnel step each session reached."""
    steps = F.array(*[F.lit(s) for s in FUNNEL_STEPS])
    reached = F.max(F.array_position(steps, F.col("event_type"))).cast("int")
    return (
        events.groupBy("session_id")
        .agg(reached.alias("step_number"))
        .withColumn("furthest_step", F.get(steps, F.col("step_number") - 1))
    )


def funnel_steps(events: DataFrame) -> DataFrame:
    """Per step: sessions that got at least that far, and their share of all sessions.

    Sessions are counted per furthest step first, so the running total runs over
    at most one row per step.
    """
    by_step = funnel_progress(events).groupBy("step_number", "furthest_step").agg(
        F.count(F.lit(1)).alias("sessions_ending")
    )
    names = events.sparkSession.createDataFrame(
        [(i + 1, step) for i, step in enumerate(FUNNEL_STEPS)], "step_number int, step string"
    )
    counted = names.join(by_step.drop("furthest_step"), "step_number", "left").na.fill(
        0, ["sessions_ending"]
    )
    deeper = W.orderBy(F.desc("step_number")).rowsBetween(W.unboundedPreceding, W.currentRow)
    everyone = F.sum("sessions_ending").over(W.partitionBy())
    reached = F.sum("sessions_ending").over(deeper)
    return counted.select(
        "step_number",
        "step",
        reached.alias("sessions_reached"),
        F.round(reached * 100.0 / F.nullif(everyone, F.lit(0)), 2).cast("double").alias("reach_pct"),
    )
