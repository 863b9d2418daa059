"""K-means segmentation of customers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.columns import null_as_zero, with_one_row
from tidemart.functions.numeric import ratio
from tidemart.session import cut_lineage

FEATURES = ("recency_days", "frequency", "monetary")
ELBOW_KS = range(2, 9)
CLUSTERS = 5
SEED = 42


def standardize(scores: DataFrame) -> DataFrame:
    """Features with mean 0 and population deviation 1; a constant feature becomes 0."""
    numbers = null_as_zero(
        scores.select("user_id", *[F.col(c).cast("double").alias(c) for c in FEATURES])
    )
    spread = numbers.agg(
        *[F.avg(c).alias(f"avg_{c}") for c in FEATURES],
        *[F.stddev_pop(c).alias(f"std_{c}") for c in FEATURES],
    )
    return with_one_row(numbers, spread).select(
        "user_id",
        *FEATURES,
        *[
            F.coalesce(ratio(F.col(c) - F.col(f"avg_{c}"), f"std_{c}"), F.lit(0.0)).alias(f"z_{c}")
            for c in FEATURES
        ],
    )


def scaled_features(scores: DataFrame) -> DataFrame:
    """Standardized feature vector per user.

    Iterative training reads the result many times, so it is cut from its lineage.
    """
    assembler = VectorAssembler(inputCols=[f"z_{c}" for c in FEATURES], outputCol="features")
    return cut_lineage(
        assembler.transform(standardize(scores)).select("user_id", *FEATURES, "features")
    )


def elbow(scaled: DataFrame, ks: Iterable[int] = ELBOW_KS, seed: int = SEED) -> DataFrame:
    """Training cost per number of clusters; one model per k, a handful of rows."""
    costs = [
        (k, float(KMeans(k=k, seed=seed).fit(scaled).summary.trainingCost)) for k in ks
    ]
    return scaled.sparkSession.createDataFrame(costs, "k int, inertia double")


def assign_clusters(scaled: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> DataFrame:
    model = KMeans(k=k, seed=seed, predictionCol="kmeans_cluster").fit(scaled)
    return model.transform(scaled).drop("features")


def cluster_profile(assigned: DataFrame) -> DataFrame:
    means = [F.round(F.avg(c), 2).alias(f"mean_{c}") for c in FEATURES]
    return assigned.groupBy("kmeans_cluster").agg(F.count(F.lit(1)).alias("customers"), *means)
