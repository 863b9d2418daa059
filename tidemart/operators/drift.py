"""Feature drift between two halves of a table: two-sample Kolmogorov-Smirnov."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.numeric import ratio
from tidemart.operators.ranking import with_global_rank, with_running_sums

# Watched columns, p-value limit per column, share limit of the dataset.
DRIFT_COLUMNS = ("days_since_last_order", "total_orders", "rfm_total")
COLUMN_P = 0.05
DATASET_SHARE = 0.5
# Terms of the Kolmogorov series; the 20th term is below 1e-80 from x = 0.5 on.
_SERIES_TERMS = 20


def split_halves(df: DataFrame, order: str) -> DataFrame:
    """Add is_current: false for the first floor(n / 2) rows by ``order``, a unique key."""
    ranked = with_global_rank(df, [F.col(order)], "__rank", "__rows")
    return ranked.withColumn("is_current", F.col("__rank") > F.floor(F.col("__rows") / 2)).drop(
        "__rank", "__rows"
    )


def kolmogorov_tail(x: Column) -> Column:
    """Asymptotic P(D > d) at x = sqrt(n m / (n + m)) d."""
    series = F.lit(0.0)
    for k in range(1, _SERIES_TERMS + 1):
        series = series + F.lit(2.0 * (-1) ** (k - 1)) * F.exp(F.lit(-2.0 * k * k) * x * x)
    return F.when(x < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


def ks_by_column(halves: DataFrame, columns: Sequence[str] = DRIFT_COLUMNS) -> DataFrame:
    """KS distance and p-value per column between the rows with is_current false and true.

    Rows are counted per distinct value first; the two distribution functions are
    running sums over the sorted values of all columns at once.  Each column's
    sums start where the previous column's ended.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    counts = (
        halves.select("is_current", F.explode(pairs).alias("p"))
        .filter(F.col("p.value").isNotNull())
        .groupBy("p.column", "p.value")
        .agg(
            F.count_if(~F.col("is_current")).alias("reference"),
            F.count_if("is_current").alias("current"),
        )
    )
    running = with_running_sums(
        counts, [F.col("column"), F.col("value")], {"ref_run": "reference", "cur_run": "current"}
    )
    # One row per watched column.
    sizes = running.groupBy("column").agg(
        F.sum("reference").alias("n_ref"),
        F.sum("current").alias("n_cur"),
        F.max("ref_run").alias("ref_end"),
        F.max("cur_run").alias("cur_end"),
    )
    f_ref = ratio(F.col("ref_run") - (F.col("ref_end") - F.col("n_ref")), "n_ref")
    f_cur = ratio(F.col("cur_run") - (F.col("cur_end") - F.col("n_cur")), "n_cur")
    distance = (
        running.join(sizes, "column")
        .groupBy("column", "n_ref", "n_cur")
        .agg(F.max(F.abs(f_ref - f_cur)).alias("__d"))
    )
    n, m = F.col("n_ref").cast("double"), F.col("n_cur").cast("double")
    tail = kolmogorov_tail(F.sqrt(n * m / (n + m)) * F.col("__d"))
    return distance.withColumn("__p", tail).select(
        "column",
        "n_ref",
        "n_cur",
        F.round("__d", 8).alias("ks_statistic"),
        F.round("__p", 6).alias("p_value"),
        (F.col("__p") < COLUMN_P).alias("drifted"),
    )


def dataset_drift(per_column: DataFrame, share: float = DATASET_SHARE) -> DataFrame:
    drifted = ratio(F.count_if("drifted"), F.count(F.lit(1)))
    return per_column.agg(drifted.alias("__share")).select(
        F.round("__share", 4).alias("drift_share"),
        (F.col("__share") >= share).alias("drift_detected"),
    )
