"""Churn and demand models on seeded data: ranges and row counts."""

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemart.operators import churn, clustering, models
from tidemart.session import fresh_dir


@pytest.fixture(scope="module")
def features(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(300):
        days = rnd.uniform(0, 200)
        rows.append((i, days, *[float(rnd.randint(0, 9)) for _ in churn.FEATURES[1:]], "Lost", days > 90))
    names = ["user_id", *churn.FEATURES, "rfm_segment", "label"]
    return spark.createDataFrame(rows, names)


def test_split_is_stable_and_keeps_the_class_shares(features):
    rows = models.training_frame(features, churn.FEATURES, "label", ["user_id"])
    train, test = models.stratified_split(rows, "user_id")
    assert train.count() + test.count() == 300
    again = models.stratified_split(rows.repartition(7), "user_id")[1]
    assert sorted(r.user_id for r in again.collect()) == sorted(r.user_id for r in test.collect())
    for label in (0.0, 1.0):
        own = test.filter(F.col("label") == label).count() / rows.filter(F.col("label") == label).count()
        assert 0.1 < own < 0.3


def test_churn_models(spark, features):
    train, test = models.prepare_churn(features)
    table, fitted = models.compare_churn_models(train, test, names=["Logistic Regression", "Random Forest"])
    metrics = {r.model: r for r in table.collect()}
    assert metrics["Random Forest"].auc > 0.9 and 0 <= metrics["Random Forest"].f1 <= 1
    best = models.best_model(table).collect()[0]
    assert best.auc == max(r.auc for r in metrics.values())
    forest = fitted["Random Forest"]
    weights = models.importances(forest, churn.FEATURES, spark)
    ranked = weights.orderBy("place").collect()
    assert ranked[0].feature == "days_since_last_order" and [r.place for r in ranked] == list(range(1, 13))
    assert [r.importance for r in ranked] == sorted((r.importance for r in ranked), reverse=True)
    scored = forest.transform(test)
    points = models.roc_points(scored).orderBy(F.desc("score")).collect()
    assert points[-1].tpr == 1.0 and points[-1].fpr == 1.0
    rates = [(p.fpr, p.tpr) for p in points]
    assert rates == sorted(rates)
    assert models.confusion(scored).agg(F.sum("rows")).collect()[0][0] == test.count()
    out = models.score_churn(features, forest)
    assert out.count() == 300 and out.filter("is_at_risk <> (churn_probability > 0.6)").count() == 0
    by_rule = models.score_churn(features, None)
    assert {r.churn_probability for r in by_rule.collect()} == {0.0, 0.85}

    path = fresh_dir(spark, "t-runs")
    models.log_run(spark, path, "Random Forest", {"trees": 100}, {"auc": metrics["Random Forest"].auc}, forest)
    models.log_run(spark, path, "Old", {}, {"auc": 0.1})
    models.log_run(spark, path, "Random Forest", {"trees": 100}, {"auc": 0.2}, forest)
    assert models.best_run(spark, path).collect()[0].model == "Random Forest"
    runs = {r.run_id for r in spark.read.parquet(f"{path}/runs").filter("model = 'Random Forest'").collect()}
    kept = {r.path.rsplit("/", 3)[-3] for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(f"{path}/models/*/metadata").select("path").collect()}
    assert len(runs) == 2 and kept == runs


def test_too_few_rows(features):
    with pytest.raises(ValueError, match="at least 50"):
        models.prepare_churn(features.filter("user_id < 10"))


def test_clusters(spark):
    rnd = random.Random(1)
    centers = [(10, 2, 100.0), (300, 1, 20.0), (5, 40, 9000.0)]
    rows = [(i, *[v * rnd.uniform(0.95, 1.05) for v in centers[i % 3]]) for i in range(90)]
    df = spark.createDataFrame(rows, ["user_id", *clustering.FEATURES])
    scaled = clustering.scaled_features(df)
    costs = [r.inertia for r in clustering.elbow(scaled, range(2, 5)).orderBy("k").collect()]
    assert costs[0] > costs[1] >= costs[2] * 0.5
    groups = clustering.cluster_profile(clustering.assign_clusters(scaled, k=3)).collect()
    assert sorted(g.customers for g in groups) == [30, 30, 30]


def test_demand_forecast_without_model(spark):
    daily = spark.createDataFrame([(dt.date(2025, 1, 1), 4)], "order_date date, total_orders long")
    rows = models.forecast_demand(daily, dt.date(2025, 1, 1), None, days_ahead=2).collect()
    assert [r.predicted_orders for r in rows] == [4.0, 4.0]


def test_split_is_exact_in_every_class(spark):
    rows = spark.createDataFrame([(i, 1.0 if i % 7 == 0 else 0.0) for i in range(203)], "user_id long, label double")
    train, test = models.stratified_split(rows.repartition(5), "user_id")
    held = {label: sorted(r.user_id for r in test.filter(F.col("label") == label).collect()) for label in (0.0, 1.0)}
    assert (len(held[1.0]), len(held[0.0])) == (6, 35)  # 29 and 174 rows, a fifth of each to the nearest row

    def digest(i):
        return hashlib.md5(f"42|{i}".encode()).hexdigest()

    assert held[1.0] == sorted(sorted((i for i in range(203) if i % 7 == 0), key=digest)[:6])
    assert sorted(r.user_id for r in train.union(test).collect()) == list(range(203))
    assert models.stratified_split(rows.limit(0), "user_id")[1].count() == 0


def test_curves_of_all_models_in_one_pass(spark):
    rnd = random.Random(6)
    rows = [(m, float(rnd.random() < 0.4), rnd.choice([0.1, 0.2, 0.5, 0.9])) for m in "abc" for _ in range(60)]
    rows += [("d", 1.0, 0.3), ("d", 1.0, 0.4)]  # no negatives
    scores = spark.createDataFrame(rows, "model string, label double, score double")
    found = {r.model: r.auc for r in models.areas(scores).collect()}
    for model in "abc":
        own = [(label, score) for m, label, score in rows if m == model]
        pairs = [(p, n) for one, p in own if one for zero, n in own if not zero]
        assert found[model] == pytest.approx(sum((p > n) + (p == n) / 2 for p, n in pairs) / len(pairs))
        points = models.roc_curves(scores.filter(F.col("model") == model)).collect()
        together = models.roc_curves(scores).filter(F.col("model") == model).collect()
        assert sorted(points) == sorted(together) and max(p.tpr for p in points) == 1.0
    assert found["d"] is None


def test_demand_importances_follow_the_signal(spark):
    """Orders that depend on one lag only: it comes first, and the importances share out one."""
    rnd = random.Random(9)
    rows = [(float(rnd.randrange(100)), float(rnd.randrange(100)), float(rnd.randrange(100))) for _ in range(120)]
    train = spark.createDataFrame([(a, b, c, 5 * b) for a, b, c in rows], "x double, y double, z double, label double")
    found = models.importances(models.fit_demand(train, ["x", "y", "z"]), ["x", "y", "z"], spark).collect()
    assert [r.place for r in found] == [1, 2, 3] and found[0].feature == "y"
    assert sum(r.importance for r in found) == pytest.approx(1.0)
    assert [r.importance for r in found] == sorted((r.importance for r in found), reverse=True)


def test_training_rows_are_dealt_evenly(spark):
    """Rows of one class used to meet in one task, so two tasks trained whatever the number of rows."""
    numbers = [F.pmod(F.xxhash64("id", F.lit(c)), F.lit(50)).cast("double").alias(c) for c in churn.FEATURES]
    rows = spark.range(50_000).select(F.col("id").alias("user_id"), *numbers, (F.col("id") % 3 == 0).alias("label"))
    train, test = models.prepare_churn(rows)
    assert (train.count(), test.count()) == (40_000, 10_000)
    sizes = [r["count"] for r in train.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 40_000 / 6
    assert test.rdd.getNumPartitions() == 2 and train.select("user_id").distinct().count() == 40_000
