"""Drift, histograms, demand features, splits and forecasts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemart.operators import demand, drift, histogram

FIRST = dt.date(2025, 1, 1)


def _ks(a, b):
    values = sorted(set(a) | set(b))
    return max(abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) for v in values)


def test_ks_against_brute_force(spark):
    rnd = random.Random(4)
    rows = [(i, float(rnd.randint(0, 30)), rnd.randint(0, 3) + (2 if i >= 101 else 0), 1) for i in range(203)]
    df = spark.createDataFrame(rows, "user_id long, x double, y int, z int").repartition(5)
    halves = drift.split_halves(df, "user_id")
    assert halves.filter(~F.col("is_current")).count() == 101
    got = {r.column: r for r in drift.ks_by_column(halves, ["x", "y", "z"]).collect()}
    for i, name in ((1, "x"), (2, "y"), (3, "z")):
        old, new = [r[i] for r in rows[:101]], [r[i] for r in rows[101:]]
        assert got[name].ks_statistic == pytest.approx(_ks(old, new), abs=1e-8)
        assert (got[name].n_ref, got[name].n_cur) == (101, 102)
    assert got["y"].drifted and not got["z"].drifted and got["z"].p_value == 1.0
    verdict = drift.dataset_drift(drift.ks_by_column(halves, ["x", "y", "z"])).collect()[0]
    assert verdict.drift_share == pytest.approx(0.3333) and verdict.drift_detected is False


def test_histogram_density_sums_to_one(spark):
    rnd = random.Random(6)
    rows = [("a" if i % 3 else "b", float(rnd.randint(0, 100))) for i in range(500)] + [("c", 4.0), ("c", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    bins = histogram.histogram(df, "v", 10, ["g"]).collect()
    for group in ("a", "b"):
        values = [v for g, v in rows if g == group]
        width = (max(values) - min(values)) / 10
        own = [b for b in bins if b.g == group]
        assert sum(b.n for b in own) == len(values)
        assert sum(b.density * width for b in own) == pytest.approx(1.0, abs=1e-5)
        assert max(b.bin for b in own) == 9  # the maximum falls into the last bin
    alone = [b for b in bins if b.g == "c"]
    # One single value is spread over one unit around it.
    assert [(b.bin, b.bin_start, b.n, b.density) for b in alone] == [(5, 4.0, 1, 10.0)]


def _daily(spark, counts, skip=()):
    rows = [(FIRST + dt.timedelta(days=i), c, 1.0, 0.0) for i, c in enumerate(counts) if i not in skip]
    return spark.createDataFrame(
        rows, "order_date date, total_orders long, avg_order_value double, cancellation_rate_pct double"
    ).withColumn("gross_revenue", F.lit(0).cast("decimal(28,2)"))


@pytest.mark.parametrize("days,kept", [(29, 0), (30, 0), (31, 1), (40, 10)])
def test_daily_features_need_a_full_history(spark, days, kept):
    counts = list(range(1, days + 1))
    rows = demand.daily_features(_daily(spark, counts)).orderBy("order_date").collect()
    assert len(rows) == kept
    if rows:
        first = rows[0]
        assert (first.lag_1, first.lag_7, first.lag_14) == (30, 24, 17)
        assert first.rolling_7 == pytest.approx(sum(counts[23:30]) / 7)
        assert first.rolling_30 == pytest.approx(sum(counts[:30]) / 30)
    inclusive = demand.daily_features(_daily(spark, counts), include_today=True)
    assert inclusive.count() == (kept + 1 if days >= 30 else 0)


def test_lags_stay_inside_the_category(spark):
    df = spark.createDataFrame(
        [(FIRST + dt.timedelta(days=i), c, 10 * (c == "b") + i) for i in range(9) for c in "ab"],
        "order_date date, primary_category string, total_orders long",
    ).withColumns({"avg_order_value": F.lit(1.0), "cancellation_rate_pct": F.lit(0.0)})
    rows = {(r.primary_category, (r.order_date - FIRST).days): r for r in demand.category_features(df).collect()}
    assert rows[("b", 7)].lag_7 == 10 and rows[("a", 8)].lag_7 == 1
    assert rows[("a", 6)].lag_7 == 0 and rows[("a", 8)].lag_14 == 0
    assert rows[("a", 0)].day_of_week == FIRST.weekday()


def test_splits(spark):
    daily = _daily(spark, range(10))
    folds = demand.expanding_folds(daily, 3).groupBy("fold", "role").count().collect()
    assert {(r.fold, r.role): r["count"] for r in folds} == {
        (1, "train"): 4, (1, "test"): 2, (2, "train"): 6, (2, "test"): 2, (3, "train"): 8, (3, "test"): 2,
    }
    roles = demand.chronological_split(daily).groupBy("role").count().collect()
    assert {r.role: r["count"] for r in roles} == {"train": 8, "test": 2}


def test_forecast_and_recent_days(spark):
    daily = _daily(spark, [10] * 40)
    friday = dt.date(2025, 2, 7)
    rows = demand.rule_forecast(daily, friday, days_ahead=3).orderBy("forecast_date").collect()
    assert [r.predicted_orders for r in rows] == [13.0, 13.0, 10.0]
    recent = demand.recent_with_lags(_daily(spark, list(range(40)))).orderBy("order_date").collect()
    assert len(recent) == 30 and recent[0].lag_7 == pytest.approx(24.5) and recent[7].lag_7 == 10.0
