"""Exact global ranks, tiles, quantiles and running sums without a one-task window.

``Window.orderBy`` without a partition moves every row into one task.  Here the
rows are range-sorted instead, so that partition p holds only rows that come
before those of partition p + 1 even when one value covers a third of the
input (the order always ends in a unique key, so ties split too).  A row's
position is its offset inside the partition plus the sizes of all earlier
partitions; that second table has one row per partition, which bounds it.

The sorted rows are checkpointed before they are counted: range bounds are
sampled, and counting one sample while numbering another would be wrong.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.functions.columns import join_small_classes
from tidemart.session import cut_lineage

_SLOT = "__slot"
_PART = "__part"
# monotonically_increasing_id(): partition number above bit 33, row number below.
_SLOT_BITS = 33


def _sorted_slots(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    placed = df.orderBy(*order).withColumn(_SLOT, F.monotonically_increasing_id())
    return cut_lineage(placed).withColumn(_PART, F.shiftright(_SLOT, _SLOT_BITS))


def _before_partition(sizes: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Totals of all earlier partitions; the input has one row per partition."""
    earlier = W.orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    return sizes.select(
        _PART,
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"{m}__before") for m in measures],
        *[F.sum(m).over(W.partitionBy()).alias(f"{m}__total") for m in measures],
    )


def with_global_rank(
    df: DataFrame, order: Sequence[Column], rank: str = "rank", total: str = "total_rows"
) -> DataFrame:
    """Add the 1-based position under a total order, and the row count."""
    slots = _sorted_slots(df, order)
    sizes = slots.groupBy(_PART).agg(F.count(F.lit(1)).alias("n"))
    offsets = _before_partition(sizes, ["n"])
    inside = F.col(_SLOT).bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    return (
        slots.join(F.broadcast(offsets), _PART)
        .withColumn(rank, F.col("n__before") + inside + 1)
        .withColumn(total, F.col("n__total"))
        .drop(_SLOT, _PART, "n__before", "n__total")
    )


def tile_of_rank(rank: Column, total: Column, tiles: int) -> Column:
    """NTILE bucket of a 1-based rank: the first (total mod tiles) buckets hold one more row."""
    small = F.floor(total / tiles)
    extra = F.pmod(total, F.lit(tiles))
    wide_rows = extra * (small + 1)
    in_wide = F.ceil(rank / (small + 1))
    in_small = extra + F.ceil((rank - wide_rows) / F.nullif(small, F.lit(0)))
    return F.when(rank <= wide_rows, in_wide).otherwise(in_small).cast("int")


def with_global_ntile(df: DataFrame, order: Sequence[Column], name: str, tiles: int = 5) -> DataFrame:
    ranked = with_global_rank(df, order, "__rank", "__rows")
    return ranked.withColumn(name, tile_of_rank(F.col("__rank"), F.col("__rows"), tiles)).drop(
        "__rank", "__rows"
    )


def with_global_ntiles(
    df: DataFrame, key: str, measures: dict[str, Column], tiles: int = 5
) -> DataFrame:
    """Add several tile columns to a frame with one row per key, in one global sort.

    ``measures`` maps output names to values, smallest first; nulls come last and
    ties are ordered by the key.  Each row is repeated once per measure, all
    repetitions are sorted together by (measure, value, key), and the tiles are
    brought back to the key.  Every measure has a sort column of its own type, null
    in the rows of the others, so values are compared as they are.  A measure owns
    exactly one n-th of the sorted rows, so its own ranks need no second count.
    """
    names = list(measures)
    rest = [c for c in df.columns if c != key]
    values = [f"__value{i}" for i in range(len(names))]
    keyed = df.select(
        key, *rest, *[measures[n].alias(v) for n, v in zip(names, values)],
        F.explode(F.sequence(F.lit(0), F.lit(len(names) - 1))).alias("__slot_no"),
    )
    long = keyed.select(
        key,
        "__slot_no",
        *[F.when(F.col("__slot_no") == i, F.col(v)).alias(v) for i, v in enumerate(values)],
        *[F.when(F.col("__slot_no") == 0, F.col(c)).alias(c) for c in rest],
    )
    order = [F.col("__slot_no"), *[F.asc_nulls_last(v) for v in values], F.col(key)]
    ranked = with_global_rank(long, order, "__rank", "__all")
    rows = (F.col("__all") / len(names)).cast("bigint")
    tile = tile_of_rank(F.col("__rank") - F.col("__slot_no") * rows, rows, tiles)
    return (
        ranked.withColumn("__tile", tile)
        .groupBy(key)
        .agg(
            *[F.max(c).alias(c) for c in rest],
            *[F.max(F.when(F.col("__slot_no") == i, F.col("__tile"))).alias(n) for i, n in enumerate(names)],
        )
    )


def with_running_sums(df: DataFrame, order: Sequence[Column], sums: dict[str, str]) -> DataFrame:
    """Add running totals (inclusive) of numeric columns along a total order.

    ``sums`` maps output names to input columns.
    """
    slots = _sorted_slots(df, order)
    sizes = slots.groupBy(_PART).agg(*[F.sum(src).alias(src) for src in sums.values()])
    offsets = _before_partition(sizes, list(sums.values()))
    local = W.partitionBy(_PART).orderBy(_SLOT).rowsBetween(W.unboundedPreceding, W.currentRow)
    out = slots
    for name, src in sums.items():
        out = out.withColumn(f"__{name}", F.sum(src).over(local))
    out = out.join(F.broadcast(offsets), _PART)
    for name, src in sums.items():
        out = out.withColumn(name, F.col(f"__{name}") + F.col(f"{src}__before"))
    scratch = [f"__{name}" for name in sums]
    scratch += [f"{src}__{kind}" for src in sums.values() for kind in ("before", "total")]
    return out.drop(_SLOT, _PART, *scratch)


def exact_quantiles(
    df: DataFrame, value: str, quantiles: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Linearly interpolated quantiles per group, one output row per group.

    Rows are counted per (group, value) first, so a value that most rows share is one
    row of the global sort; running counts then give the ranks that each value covers.
    The group table is a class table (labels, features), so it stays small; the measured
    values do not.
    """
    by = list(by)
    counts = (
        df.select(*by, F.col(value).alias("__v"))
        .filter(F.col("__v").isNotNull())
        .groupBy(*by, "__v")
        .agg(F.count(F.lit(1)).alias("__copies"))
    )
    running = with_running_sums(counts, [F.col(c) for c in [*by, "__v"]], {"__through": "__copies"})
    bounds = running.groupBy(*by).agg(
        F.min(F.col("__through") - F.col("__copies")).alias("__before"), F.sum("__copies").alias("__n")
    )
    joined = join_small_classes(running, bounds, by)
    last = F.col("__through") - F.col("__before") - 1
    first = last - F.col("__copies") + 1
    number = F.col("__v").cast("double")
    aggregates = []
    for name, q in quantiles.items():
        spot = F.lit(q) * (F.col("__n") - 1)
        low = F.max(F.when(F.floor(spot).between(first, last), number))
        high = F.max(F.when(F.ceil(spot).between(first, last), number))
        share = F.max(spot - F.floor(spot))
        aggregates.append((low + (high - low) * share).alias(name))
    return joined.groupBy(*by).agg(*aggregates)


def tail(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The last n rows of an order, in that order; nulls come first, as in any ascending sort.

    It is a top-k of the reversed order, so each task hands on n rows and nothing is sorted as a whole.
    """
    return df.orderBy(*[F.desc_nulls_last(c) for c in order]).limit(n).orderBy(*order)
