"""Stock ledger and daily snapshots.

Stock never goes below zero: each movement gives max(0, before + change).  With
S the running sum of the changes, the sequential result equals
``opening + S - least(0, opening + min(S so far))``, so running sums and minima
replace the row-by-row loop.

One product in one warehouse may own a third of all movements, so a key's
movements are cut into chunks along their order.  Running values are taken per
(product, warehouse, chunk), and one row per chunk is carried from chunk to
chunk.  A chunk is a day unless the caller cuts finer, for days that are hot
themselves; chunk columns must not decrease along the order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.functions.columns import join_null_safe

OPENING_STOCK = 100
KEYS = ("product_id", "warehouse_id")


def _chunked(
    movements: DataFrame, timestamp: str, chunk: Sequence[Column] | None
) -> tuple[DataFrame, list[str]]:
    parts = list(chunk or [F.col(timestamp).cast("date")])
    names = [f"__chunk{i}" for i in range(len(parts))]
    return movements.withColumns(dict(zip(names, parts))), names


def stock_ledger(
    movements: DataFrame,
    order: Sequence[str],
    timestamp: str = "timestamp",
    change: str = "quantity_change",
    opening: int = OPENING_STOCK,
    chunk: Sequence[Column] | None = None,
) -> DataFrame:
    """Add quantity_before and quantity_after to every movement.

    ``order`` is the total order of the movements of one key and starts with the
    timestamp.
    """
    rows, cuts = _chunked(movements, timestamp, chunk)
    inside = W.partitionBy(*KEYS, *cuts).orderBy(*order)
    through = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    before = inside.rowsBetween(W.unboundedPreceding, -1)
    local = (
        rows.withColumn("__sum", F.sum(change).over(through))
        .withColumn("__low", F.min("__sum").over(through))
        .withColumn("__low_before", F.min("__sum").over(before))
    )
    per_chunk = local.groupBy(*KEYS, *cuts).agg(
        F.sum(change).alias("__total"), F.min("__sum").alias("__chunk_low")
    )
    earlier = W.partitionBy(*KEYS).orderBy(*cuts).rowsBetween(W.unboundedPreceding, -1)
    carried = (
        per_chunk.withColumn("__carry", F.coalesce(F.sum("__total").over(earlier), F.lit(0)))
        .withColumn("__carry_low", F.min(F.col("__carry") + F.col("__chunk_low")).over(earlier))
        .select(*KEYS, *cuts, "__carry", "__carry_low")
    )
    # The carried rows grow with the movements: never broadcast them.  The left side
    # is already partitioned and sorted by the join key.
    joined = join_null_safe(local, carried, [*KEYS, *cuts], hint="merge")

    def level(running: Column, *lows: Column) -> Column:
        floor = F.least(F.lit(0), *[opening + low for low in lows])  # least() skips nulls
        return (opening + running - floor).cast("bigint")

    total = F.col("__carry") + F.col("__sum")
    return joined.select(
        *movements.columns,
        level(total - F.col(change), F.col("__carry_low"), F.col("__carry") + F.col("__low_before")).alias(
            "quantity_before"
        ),
        level(total, F.col("__carry_low"), F.col("__carry") + F.col("__low")).alias("quantity_after"),
    )


def daily_snapshot(
    ledger: DataFrame, order: Sequence[str], timestamp: str = "timestamp", compat: bool = False
) -> DataFrame:
    """Closing stock and event count per product, warehouse and day.

    ``compat=True`` reports 1 event per snapshot, as counting after the cut to the
    latest row does.
    """
    events = F.lit(1).cast("bigint") if compat else F.count(F.lit(1))
    return ledger.groupBy(*KEYS, F.col(timestamp).cast("date").alias("snapshot_date")).agg(
        F.max_by("quantity_after", F.struct(*order)).alias("quantity"),
        events.alias("event_count"),
    )


def daily_closing_stock(
    movements: DataFrame,
    order: Sequence[str],
    timestamp: str = "timestamp",
    change: str = "quantity_change",
    opening: int = OPENING_STOCK,
    chunk: Sequence[Column] | None = None,
) -> DataFrame:
    """daily_snapshot(stock_ledger(...)) without the ledger: one row per chunk is all that a day needs.

    Movements are read once and reduced to their chunks' sums and lows; levels are
    taken at chunk ends only, and a day's last chunk is seen from the next one.
    """
    rows, cuts = _chunked(movements, timestamp, chunk)
    rows = rows.withColumn("snapshot_date", F.col(timestamp).cast("date"))
    days = ["snapshot_date", *cuts]
    inside = W.partitionBy(*KEYS, *days).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    per_chunk = (
        rows.select(*KEYS, *days, F.col(change).alias("__change"), F.sum(change).over(inside).alias("__sum"))
        .groupBy(*KEYS, *days)
        .agg(F.sum("__change").alias("__total"), F.min("__sum").alias("__low"), F.count(F.lit(1)).alias("__events"))
    )
    in_time = W.partitionBy(*KEYS).orderBy(*days)
    through = in_time.rowsBetween(W.unboundedPreceding, W.currentRow)
    running = (
        per_chunk.withColumn("__through", F.sum("__total").over(through))
        .withColumn("__lowest", F.min(F.col("__through") - F.col("__total") + F.col("__low")).over(through))
        .withColumn("__next_day", F.lead("snapshot_date").over(in_time))
        .withColumn("__events", F.sum("__events").over(W.partitionBy(*KEYS, "snapshot_date")))
    )
    level = F.lit(opening) + F.col("__through") - F.least(F.lit(0), F.lit(opening) + F.col("__lowest"))
    day_ends = F.col("__next_day").isNull() | (F.col("__next_day") > F.col("snapshot_date"))
    return running.filter(day_ends).select(
        *KEYS, "snapshot_date", level.cast("bigint").alias("quantity"), F.col("__events").alias("event_count")
    )


def latest_stock(ledger: DataFrame, order: Sequence[str], timestamp: str = "timestamp") -> DataFrame:
    """Current stock per product and warehouse."""
    return ledger.groupBy(*KEYS).agg(
        F.max_by("quantity_after", F.struct(*order)).alias("quantity"),
        F.max(timestamp).alias("as_of"),
    )


def broken_links(
    ledger: DataFrame,
    order: Sequence[str],
    timestamp: str = "timestamp",
    chunk: Sequence[Column] | None = None,
) -> DataFrame:
    """Movements whose quantity_before is not the previous quantity_after.

    The previous row is looked up inside the chunk; a chunk's first row takes the
    closing stock of the key's previous chunk.
    """
    rows, cuts = _chunked(ledger, timestamp, chunk)
    inside = W.partitionBy(*KEYS, *cuts).orderBy(*order)
    local = (
        rows.withColumn("__prev", F.lag("quantity_after").over(inside))
        .withColumn("__first", F.row_number().over(inside) == 1)
        .withColumn("__last", F.lead(F.lit(True), 1, False).over(inside) == F.lit(False))
    )
    # A chunk's last row is known from the window that is there already.
    closing = (
        local.filter("__last")
        .withColumn("__opening", F.lag("quantity_after").over(W.partitionBy(*KEYS).orderBy(*cuts)))
        .select(*KEYS, *cuts, "__opening")
    )
    expected = F.when(F.col("__first"), F.col("__opening")).otherwise(F.col("__prev"))
    return (
        join_null_safe(local, closing, [*KEYS, *cuts], hint="merge")
        .withColumn("expected_before", expected)
        .filter(F.col("expected_before") != F.col("quantity_before"))
        .select(*ledger.columns, "expected_before")
    )
