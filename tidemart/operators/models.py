"""Training, comparison and scoring of the churn and demand models with Spark ML."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.functions.columns import AsOf, null_as_zero, with_one_row
from tidemart.functions.numeric import non_negative, ratio
from tidemart.operators import churn, demand
from tidemart.operators.ranking import with_global_rank, with_running_sums
from tidemart.session import cut_lineage, fresh_dir

SEED = 42
TEST_SHARE = 0.2
# Model settings and the minimum rows to train on.
CHURN_TREES, CHURN_DEPTH, CHURN_RATE = 100, 5, 0.1
# Depth limit of the forest's trees.  The model sets none; a distributed forest grows its
# trees level by level and keeps all nodes of a level in memory, so it needs one.
FOREST_DEPTH = 12
DEMAND_TREES, DEMAND_DEPTH, DEMAND_RATE = 100, 4, 0.05
LOGISTIC_ITERATIONS = 500
CHURN_MIN_ROWS = 50
DEMAND_MIN_ROWS = 30
# Training rows a task has at least: below, the start of a task costs more than its rows.
ROWS_PER_TASK = 5_000


def training_frame(features: DataFrame, columns: Sequence[str], label: str, keys: Sequence[str]) -> DataFrame:
    """Keys, features as doubles with nulls as 0, and a numeric label; unlabeled rows go."""
    rows = features.filter(F.col(label).isNotNull()).select(
        *keys,
        *[F.col(c).cast("double").alias(c) for c in columns],
        F.col(label).cast("int").cast("double").alias("label"),
    )
    return null_as_zero(rows, columns)


def require_rows(df: DataFrame, minimum: int) -> None:
    """Reads at most ``minimum`` rows."""
    found = df.limit(minimum).count()
    if found < minimum:
        raise ValueError(f"{found} rows, at least {minimum} needed for training")


def stratified_split(
    df: DataFrame, key: str, label: str = "label", test_share: float = TEST_SHARE, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows: in every class exactly the share, to the nearest row (halves go up), is held out.

    The rows of a class are ranked by a digest of seed and key, so a split is the same in
    every run and on every cluster.  The order is one range sort over all classes; keys are
    expected to be unique, rows of a repeated key may be split.
    """
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string")))
    ranked = with_global_rank(df.withColumn("__digest", digest), [F.col(label), F.col("__digest"), F.col(key)], "__rank", "__n")
    classes = ranked.groupBy(F.col(label).alias("__class")).agg(
        (F.min("__rank") - 1).alias("__before"), F.floor(F.count(F.lit(1)) * test_share + 0.5).alias("__held")
    )
    # One row per class: sent to the rows, which a shuffle by class would gather in one task each.
    placed = ranked.join(F.broadcast(classes), F.col(label).eqNullSafe(F.col("__class")))
    held_out = F.col("__rank") - F.col("__before") <= F.col("__held")
    return tuple(placed.filter(side).select(*df.columns) for side in (~held_out, held_out))


def spread(rows: DataFrame) -> DataFrame:
    """The rows settled, and dealt evenly to as many tasks as their number is worth.

    Training passes over them hundreds of times; adaptive execution sizes partitions by
    compressed bytes, which are few here, and not by the work.  The layout follows the
    rows' values, so bootstrap samples are the same in every run.
    """
    settled = cut_lineage(rows)
    tasks = min(settled.count() // ROWS_PER_TASK, rows.sparkSession.sparkContext.defaultParallelism)
    if tasks <= 1:
        return settled
    return cut_lineage(settled.repartition(tasks, *rows.columns).sortWithinPartitions(*rows.columns))


def _with_vector(columns: Sequence[str], estimator) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=list(columns), outputCol="features"), estimator])


def detached(model: PipelineModel) -> PipelineModel:
    """The model as saved and loaded again, in the shared folder.

    A freshly fitted classifier holds its training summary, and through it the
    session, which executors cannot receive once the session has used an
    Observation (the sinks do, to count written rows).
    """
    path = fresh_dir(SparkSession.active(), "model")
    model.write().save(path)
    return PipelineModel.load(path)


def churn_estimators() -> dict[str, object]:
    return {
        "Logistic Regression": LogisticRegression(maxIter=LOGISTIC_ITERATIONS),
        "Random Forest": RandomForestClassifier(
            numTrees=CHURN_TREES, maxDepth=FOREST_DEPTH, seed=SEED
        ),
        "Gradient Boosting": GBTClassifier(
            maxIter=CHURN_TREES, maxDepth=CHURN_DEPTH, stepSize=CHURN_RATE, seed=SEED
        ),
    }


def fit_churn(
    train: DataFrame, model: str = "Gradient Boosting", columns: Sequence[str] = churn.FEATURES
) -> PipelineModel:
    return detached(_with_vector(columns, churn_estimators()[model]).fit(train))


def churn_metrics(scored: DataFrame) -> tuple[float, float]:
    """(area under ROC, F1 of the positive class)."""
    auc = BinaryClassificationEvaluator(metricName="areaUnderROC").evaluate(scored)
    f1 = MulticlassClassificationEvaluator(metricName="fMeasureByLabel", metricLabel=1.0).evaluate(scored)
    return float(auc), float(f1)


def prepare_churn(
    features: DataFrame, columns: Sequence[str] = churn.FEATURES
) -> tuple[DataFrame, DataFrame]:
    """Train and test frames, settled so that boosting rounds do not rebuild the features."""
    rows = cut_lineage(training_frame(features, columns, "label", ["user_id"]))
    require_rows(rows, CHURN_MIN_ROWS)
    return tuple(spread(side) for side in stratified_split(rows, "user_id"))


def compare_churn_models(
    train: DataFrame,
    test: DataFrame,
    columns: Sequence[str] = churn.FEATURES,
    names: Sequence[str] | None = None,
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """AUC and F1 per model, and the fitted models."""
    fitted, rows = {}, []
    for name in names or list(churn_estimators()):
        fitted[name] = fit_churn(train, name, columns)
        rows.append((name, *churn_metrics(fitted[name].transform(test))))
    table = train.sparkSession.createDataFrame(rows, "model string, auc double, f1 double")
    return table, fitted


def best_model(metrics: DataFrame, by: str = "auc") -> DataFrame:
    """The winning row of a metrics table; ties go to the first name."""
    return metrics.orderBy(F.desc(by), F.asc("model")).limit(1)


def positive_score(scored: DataFrame | None = None) -> F.Column:
    return vector_to_array(F.col("probability"))[1]


def roc_points(scored: DataFrame) -> DataFrame:
    """False and true positive rate at every distinct score, highest first.

    Rows collapse to one per score before the global sort.
    """
    counts = (
        scored.select(F.col("label"), positive_score(scored).alias("score"))
        .groupBy("score")
        .agg(
            F.count_if(F.col("label") == 1).alias("positives"),
            F.count_if(F.col("label") == 0).alias("negatives"),
        )
    )
    running = with_running_sums(counts, [F.desc("score")], {"tp": "positives", "fp": "negatives"})
    totals = running.agg(F.sum("positives").alias("p"), F.sum("negatives").alias("n"))
    return with_one_row(running, totals).select(
        "score", ratio("fp", "n").alias("fpr"), ratio("tp", "p").alias("tpr")
    )


def scored_by_all(fitted: dict[str, PipelineModel], test: DataFrame) -> DataFrame:
    """model, label and score of every test row under every model."""
    parts = [
        model.transform(test).select(F.lit(name).alias("model"), "label", positive_score().alias("score"))
        for name, model in fitted.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _ranked_scores(scores: DataFrame) -> DataFrame:
    """Per model and distinct score the rows so far, highest score first, and the model's totals.

    Rows collapse to one per model and score; then all models are sorted and summed together,
    and a model's sums start where those of the model before it end.
    """
    counts = scores.groupBy("model", "score").agg(
        F.count_if(F.col("label") == 1).alias("positives"), F.count_if(F.col("label") == 0).alias("negatives")
    )
    running = with_running_sums(counts, [F.col("model"), F.desc("score")], {"__tp": "positives", "__fp": "negatives"})
    totals = running.groupBy(F.col("model").alias("__model")).agg(
        F.min(F.col("__tp") - F.col("positives")).alias("__tp0"),
        F.min(F.col("__fp") - F.col("negatives")).alias("__fp0"),
        F.sum("positives").alias("p"),
        F.sum("negatives").alias("n"),
    )
    return running.join(totals, F.col("model") == F.col("__model")).select(
        "model", "score", "positives", "negatives", "p", "n",
        (F.col("__tp") - F.col("__tp0")).alias("tp"), (F.col("__fp") - F.col("__fp0")).alias("fp"),
    )


def roc_curves(scores: DataFrame) -> DataFrame:
    """False and true positive rate of each model at each of its scores; input: model, label, score."""
    return _ranked_scores(scores).select(
        "model", "score", ratio("fp", "n").alias("fpr"), ratio("tp", "p").alias("tpr")
    )


def areas(scores: DataFrame) -> DataFrame:
    """Area under each model's curve by trapezoids: a positive row counts the negatives scored below
    it, and half of those that tie with it.  Null where a class is missing.
    """
    below = F.col("n") - F.col("fp") + F.col("negatives") / 2
    return (
        _ranked_scores(scores)
        .groupBy("model", "p", "n")
        .agg(F.sum(F.col("positives") * below).alias("__pairs"))
        .select("model", ratio("__pairs", F.col("p") * F.col("n")).alias("auc"))
    )


def confusion(scored: DataFrame, *by: str) -> DataFrame:
    return scored.groupBy(*by, "label", "prediction").agg(F.count(F.lit(1)).alias("rows"))


def has_importances(model: PipelineModel) -> bool:
    return hasattr(model.stages[-1], "featureImportances")


def importances(model: PipelineModel, columns: Sequence[str], spark: SparkSession) -> DataFrame:
    """Feature importance, one row per feature column, the most important one first."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = sorted(((c, float(w)) for c, w in zip(columns, weights)), key=lambda x: (-x[1], x[0]))
    return spark.createDataFrame(
        [(place + 1, *row) for place, row in enumerate(rows)], "place int, feature string, importance double"
    )


def score_churn(features: DataFrame, model: PipelineModel | None) -> DataFrame:
    """Probability, risk flag and segment per user; the rule applies without a model."""
    if model is None:
        return churn.churn_rule_scores(features)
    numbers = null_as_zero(
        features.select(
            "user_id",
            "rfm_segment",
            F.col("days_since_last_order").alias("__days"),
            *[F.col(c).cast("double").alias(c) for c in churn.FEATURES],
        ),
        churn.FEATURES,
    )
    scored = model.transform(numbers)
    return churn.risk_response(scored, positive_score(scored))


def demand_estimator() -> GBTRegressor:
    return GBTRegressor(
        maxIter=DEMAND_TREES, maxDepth=DEMAND_DEPTH, stepSize=DEMAND_RATE, seed=SEED
    )


def fit_demand(train: DataFrame, columns: Sequence[str]) -> PipelineModel:
    return _with_vector(columns, demand_estimator()).fit(train)


def demand_metrics(scored: DataFrame) -> tuple[float, float]:
    """(mean absolute error, R squared)."""
    values = [
        float(RegressionEvaluator(metricName=m).evaluate(scored)) for m in ("mae", "r2")
    ]
    return values[0], values[1]


def _demand_rows(features: DataFrame, columns: Sequence[str], extra: Sequence[str]) -> DataFrame:
    return training_frame(
        features.withColumn("label", F.col("total_orders")), columns, "label", ["order_date", *extra]
    )


def train_demand(daily_revenue: DataFrame) -> tuple[DataFrame, PipelineModel]:
    """Category model on the earlier 80 % of the days, measured on the later 20 %."""
    columns = demand.CATEGORY_FEATURES
    rows = _demand_rows(demand.category_features(daily_revenue), columns, ["primary_category"])
    split = cut_lineage(demand.chronological_split(rows))
    require_rows(split, DEMAND_MIN_ROWS)
    model = fit_demand(split.filter("role = 'train'"), columns)
    mae, r2 = demand_metrics(model.transform(split.filter("role = 'test'")))
    metrics = split.sparkSession.createDataFrame(
        [("demand", mae, r2)], "model string, mae double, r2 double"
    )
    return metrics, model


def cross_validate_demand(daily: DataFrame, splits: int = demand.SPLITS) -> DataFrame:
    """MAE and R squared per expanding fold, plus their mean and population deviation."""
    columns = demand.DAILY_FEATURES
    rows = _demand_rows(demand.daily_features(daily), columns, [])
    folds = cut_lineage(demand.expanding_folds(rows, splits))
    results = []
    for fold in range(1, splits + 1):
        part = folds.filter(F.col("fold") == fold)
        model = fit_demand(part.filter("role = 'train'"), columns)
        results.append((fold, *demand_metrics(model.transform(part.filter("role = 'test'")))))
    table = daily.sparkSession.createDataFrame(results, "fold int, mae double, r2 double")
    everything = W.partitionBy()  # one row per fold
    return table.select(
        "*",
        F.avg("mae").over(everything).alias("mean_mae"),
        F.stddev_pop("mae").over(everything).alias("std_mae"),
        F.avg("r2").over(everything).alias("mean_r2"),
        F.stddev_pop("r2").over(everything).alias("std_r2"),
    )


def forecast_demand(
    daily: DataFrame, as_of: AsOf, model: PipelineModel | None, days_ahead: int = demand.DAYS_AHEAD
) -> DataFrame:
    """Coming days: the newest day's features with the calendar fields replaced."""
    if model is None:
        return demand.rule_forecast(daily, as_of, days_ahead)
    newest = null_as_zero(demand.recent_with_lags(daily)).orderBy(F.desc("order_date")).limit(1)
    ahead = demand.future_days(newest, as_of, days_ahead)
    ahead = demand.calendar_features(ahead, "forecast_date").select(
        "forecast_date", *[F.col(c).cast("double").alias(c) for c in demand.CATEGORY_FEATURES]
    )
    return model.transform(ahead).select(
        "forecast_date", F.round(non_negative("prediction"), 1).alias("predicted_orders")
    )


def actual_and_predicted(
    features: DataFrame, model: PipelineModel, columns: Sequence[str], days: int = demand.RECENT_DAYS
) -> DataFrame:
    """Actual and predicted orders of the newest days."""
    newest = demand.recent_days(_demand_rows(features, columns, []), days)
    return model.transform(newest).select(
        "order_date", F.col("label").alias("actual_orders"), F.col("prediction").alias("predicted_orders")
    )


def log_run(
    spark: SparkSession, path: str, name: str, params: dict, metrics: dict, model: PipelineModel | None = None
) -> None:
    """Append one run row to the run table, and save the model under the run's id."""
    run = uuid.uuid4().hex
    row = [
        (
            run,
            name,
            {k: str(v) for k, v in params.items()},
            {k: float(v) for k, v in metrics.items()},
        )
    ]
    schema = "run_id string, model string, params map<string,string>, metrics map<string,double>"
    runs = spark.createDataFrame(row, schema).withColumn("logged_at", F.current_timestamp())
    runs.coalesce(1).write.mode("append").parquet(f"{path}/runs")
    if model is not None:
        model.write().save(f"{path}/models/{run}")


def best_run(spark: SparkSession, path: str, metric: str = "auc") -> DataFrame:
    """The logged run to promote: the highest metric, newest first on ties."""
    return (
        spark.read.parquet(f"{path}/runs")
        .withColumn("score", F.col("metrics").getItem(metric))
        .orderBy(F.desc_nulls_last("score"), F.desc("logged_at"))
        .limit(1)
    )
