"""Normalized histograms per class, and dataset profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.columns import join_small_classes
from tidemart.functions.numeric import clip, ratio
from tidemart.operators.ranking import exact_quantiles

DURATION_LIMIT = 600
DURATION_BINS = 40
FEATURE_BINS = 30
UPPER_QUANTILE = 0.99


def histogram(df: DataFrame, value: Column | str, bins: int, by: Sequence[str]) -> DataFrame:
    """Counts and densities over equal bins between each class's minimum and maximum.

    The last bin is closed.  A class with one single value gets bins over one unit
    around it.  Values are counted per distinct value first, so the shuffles carry
    counts, not rows.  Empty bins are left out.
    """
    by = list(by)
    column = F.col(value) if isinstance(value, str) else value
    counts = (
        df.select(*by, column.cast("double").alias("v"))
        .filter(F.col("v").isNotNull())
        .groupBy(*by, "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    low, high = F.min("v"), F.max("v")
    margin = F.when(low == high, F.lit(0.5)).otherwise(F.lit(0.0))
    edges = counts.groupBy(*by).agg(
        (low - margin).alias("low"),
        ((high + margin - (low - margin)) / bins).alias("width"),
        F.sum("n").alias("total"),
    )
    slot = F.floor((F.col("v") - F.col("low")) / F.col("width"))
    return (
        join_small_classes(counts, edges, by)
        .withColumn("bin", F.least(slot, F.lit(bins - 1)).cast("int"))
        .groupBy(*by, "bin", "low", "width", "total")
        .agg(F.sum("n").alias("n"))
        .select(
            *by,
            "bin",
            F.round(F.col("low") + F.col("bin") * F.col("width"), 6).alias("bin_start"),
            "n",
            F.round(ratio(F.col("n"), F.col("total") * F.col("width")), 8).alias("density"),
        )
    )


def duration_histogram(
    assigned: DataFrame, limit: int = DURATION_LIMIT, bins: int = DURATION_BINS
) -> DataFrame:
    """Session durations limited to 0..limit seconds, per experiment group."""
    return histogram(assigned, clip("duration_seconds", 0, limit), bins, ["group"])


def feature_histograms(
    features: DataFrame,
    columns: Sequence[str],
    label: str = "label",
    bins: int = FEATURE_BINS,
    upper: float = UPPER_QUANTILE,
) -> DataFrame:
    """Feature distributions per label, limited above by the class's own quantile."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in columns]
    )
    long = features.select(label, F.explode(pairs).alias("p")).select("p.feature", label, "p.v")
    limits = exact_quantiles(long, "v", {"upper": upper}, by=["feature", label])
    with_limits = join_small_classes(long, limits, ["feature", label])
    clipped = with_limits.withColumn("v", clip("v", 0.0, "upper"))
    return histogram(clipped, "v", bins, ["feature", label])


def profile(df: DataFrame, date_column: str, distinct: str, mean: Column) -> DataFrame:
    """Row count, distinct keys, date range and a mean, in one row."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct(distinct).alias("distinct_keys"),
        F.min(date_column).alias("first_date"),
        F.max(date_column).alias("last_date"),
        F.round(ratio(F.sum(mean), F.count(mean)), 6).alias("mean_value"),
    )
