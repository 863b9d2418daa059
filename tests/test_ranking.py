"""Distributed ranks, tiles, quantiles and running sums against plain Python."""

import itertools
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.operators.ranking import (
    exact_quantiles, with_global_ntile, with_global_ntiles, tail, with_global_rank, with_running_sums,
)


def _quantile(values, q):
    ordered = sorted(values)
    spot = q * (len(ordered) - 1)
    low = int(spot)
    high = min(low + 1, len(ordered) - 1)
    return ordered[low] + (ordered[high] - ordered[low]) * (spot - low)


@pytest.mark.parametrize("n", [1, 4, 5, 6, 23, 101])
def test_ntile_matches_window(spark, n):
    # A third of the rows share one value.
    rows = [(i, 7 if i % 3 == 0 else (i * 37) % 11) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, v int").repartition(4)
    ours = with_global_ntile(df, [F.col("v"), F.col("id")], "tile")
    plain = df.withColumn("tile", F.ntile(5).over(W.orderBy("v", "id")))
    assert sorted(ours.select("id", "tile").collect()) == sorted(plain.select("id", "tile").collect())
    sizes = [r["count"] for r in ours.groupBy("tile").count().collect()]
    assert max(sizes) - min(sizes) <= 1


def test_rank_counts_every_row_once(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice([1, 1, 1, 2, 5])) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, v int").repartition(7)
    ranked = with_global_rank(df, [F.desc("v"), F.col("id")])
    got = [r.id for r in ranked.orderBy("rank").collect()]
    assert got == [i for i, _ in sorted(rows, key=lambda r: (-r[1], r[0]))]
    assert {r.total_rows for r in ranked.collect()} == {500}


def test_running_sums(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.randint(0, 9), rnd.randint(-4, 4)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a int, b int").repartition(5)
    out = with_running_sums(df, [F.col("id")], {"ra": "a", "rb": "b"}).orderBy("id").collect()
    assert [r.ra for r in out] == list(itertools.accumulate(r[1] for r in rows))
    assert [r.rb for r in out] == list(itertools.accumulate(r[2] for r in rows))


def test_quantiles_per_group_with_null_class(spark):
    rnd = random.Random(9)
    rows = [(rnd.choice(["x", "y", None]), float(rnd.randint(0, 50))) for _ in range(200)]
    rows += [("x", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    got = {r.g: (r.lo, r.hi) for r in exact_quantiles(df, "v", {"lo": 0.25, "hi": 0.99}, ["g"]).collect()}
    for group in ("x", "y", None):
        values = [v for g, v in rows if g == group and v is not None]
        assert got[group][0] == pytest.approx(_quantile(values, 0.25))
        assert got[group][1] == pytest.approx(_quantile(values, 0.99))


def test_quantiles_without_groups(spark):
    df = spark.createDataFrame([(float(i),) for i in (5, 1, 9, 3)], "v double")
    row = exact_quantiles(df, "v", {"p80": 0.8, "p50": 0.5}).collect()[0]
    assert row.p80 == pytest.approx(_quantile([5, 1, 9, 3], 0.8))
    assert row.p50 == pytest.approx(4.0)


@pytest.mark.parametrize("n", [1, 4, 6, 50])
def test_several_tiles_in_one_sort(spark, n):
    rows = [(f"k{i:03d}", i % 3, None if i % 4 == 0 else i * 7 % 10, f"name{i}") for i in range(n)]
    df = spark.createDataFrame(rows, "key string, a int, b int, name string").repartition(3)
    ours = with_global_ntiles(df, "key", {"ta": -F.col("a"), "tb": F.col("b")})
    plain = df.withColumn("ta", F.ntile(5).over(W.orderBy(F.desc("a"), "key"))).withColumn(
        "tb", F.ntile(5).over(W.orderBy(F.asc_nulls_last("b"), "key"))
    )
    assert sorted(map(str, ours.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_tiles_compare_values_as_they_are(spark):
    rows = [(i, v, Decimal(i)) for i, v in enumerate([3e-5, 1e-5, 5e-5, 2e-5, 4e-5, None, float("inf")])]
    df = spark.createDataFrame(rows, "id long, small double, whole decimal(10,0)")
    tiled = with_global_ntiles(df, "id", {"a": F.col("small"), "b": F.col("whole")}, tiles=7)
    got = {r.id: (r.a, r.b) for r in tiled.collect()}
    assert [got[i][0] for i in range(7)] == [3, 1, 5, 2, 4, 7, 6]
    assert [got[i][1] for i in range(7)] == [1, 2, 3, 4, 5, 6, 7]


def test_a_tie_of_most_rows_is_one_row_of_the_sort(spark):
    df = spark.range(40_000).select(F.when(F.col("id") < 36_000, 0).otherwise(F.col("id")).cast("double").alias("v"))
    row = exact_quantiles(df, "v", {"p50": 0.5, "p89": 0.89, "p95": 0.95}).first()
    values = sorted([0.0] * 36_000 + [float(i) for i in range(36_000, 40_000)])
    for name, q in (("p50", 0.5), ("p89", 0.89), ("p95", 0.95)):
        assert row[name] == pytest.approx(_quantile(values, q))


def test_tail_keeps_the_order(spark):
    rows = [(i, None if i % 5 == 0 else i % 3) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, v int").repartition(4)
    ordered = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    for n in (0, 1, 7, 40, 60):
        assert [tuple(r) for r in tail(df, ["v", "id"], n).collect()] == (ordered[-n:] if n else [])
    assert "TakeOrderedAndProject" in tail(df, ["v", "id"], 7)._jdf.queryExecution().executedPlan().toString()
    assert tail(df.limit(0), ["v", "id"], 3).count() == 0
