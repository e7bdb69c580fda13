"""Descriptions of a clustering: profiles, centers, metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import StandardScalerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmill.functions.columns import named
from segmill.operators.cluster import LABEL, original_centers

# Fixed value: decimals of the averages in a profile.
PROFILE_DECIMALS = 4


def profiles(labelled: DataFrame, features: Sequence[str], label: str = LABEL) -> DataFrame:
    """Row count and average features per cluster, by cluster.

    Averages are over the values that are there, not over imputed ones. Tasks send one
    row per cluster through the shuffle, however large a cluster is.
    """
    averages = [F.round(F.avg(named(c)), PROFILE_DECIMALS).alias(c) for c in features]
    return labelled.groupBy(label).agg(F.count("*").alias("n"), *averages).orderBy(label)


def centers(
    spark: SparkSession,
    model: KMeansModel,
    scaler: StandardScalerModel,
    features: Sequence[str],
    order: Sequence[int] = (),
) -> DataFrame:
    """One row per cluster: its label, then its center in the units of the features."""
    points = original_centers(model, scaler)
    rows = [(label, *points[raw]) for label, raw in enumerate(order or range(len(points)))]
    schema = T.StructType([T.StructField(LABEL, T.IntegerType())] + [T.StructField(c, T.DoubleType()) for c in features])
    return spark.createDataFrame(rows, schema).orderBy(LABEL)


def metrics(
    spark: SparkSession,
    best_k: int,
    best_score: float,
    rows_total: int,
    rows_working: int,
    features: Sequence[str],
    metric_name: str = "silhouette",
) -> DataFrame:
    """The record of a training run, as a one-row table."""
    row = (best_k, best_score, metric_name, rows_total, rows_working, len(features), list(features))
    return spark.createDataFrame(
        [row],
        "best_k int, best_score double, metric_name string, rows_total bigint, rows_working bigint, "
        "features_count int, features array<string>",
    )
