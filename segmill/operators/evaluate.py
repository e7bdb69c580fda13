"""Quality of a clustering."""

from __future__ import annotations

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from segmill.operators.prepare import VECTOR


def silhouette(
    df: DataFrame,
    label: str = "prediction",
    vector: str = VECTOR,
    distance: str = "squaredEuclidean",
    metric: str = "silhouette",
) -> float:
    """Mean silhouette of the labelled vectors, from sums per cluster: linear in the rows.

    ``distance`` is ``squaredEuclidean`` or ``cosine``. ``df`` is read twice.
    """
    return ClusteringEvaluator(
        featuresCol=vector, predictionCol=label, metricName=metric, distanceMeasure=distance
    ).evaluate(df)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def row_silhouettes(
    df: DataFrame, label: str = "prediction", vector: str = VECTOR, distance: str = "squaredEuclidean"
) -> DataFrame:
    """``label, score``: the silhouette of every row with a label and a vector.

    The mean distance of a row to a cluster follows from the cluster's number of rows, sum of vectors and sum of
    squared norms, so no row meets another one. The driver gets these k rows of sums from a first pass; the result
    is a lazy second pass with k terms per row. A row alone in its cluster scores 0. By ``cosine`` a vector of
    length 0 is at distance 1 from all others. Fewer than two clusters are an error.
    """
    if distance not in ("squaredEuclidean", "cosine"):
        raise ValueError(f"distance must be 'squaredEuclidean' or 'cosine', not {distance!r}")
    x = F.col("x")
    whole = df.where(F.col(label).isNotNull() & F.col(vector).isNotNull())
    rows = whole.select(F.col(label).alias("label"), vector_to_array(vector).alias("x"))
    if distance == "cosine":
        norm = F.sqrt(_dot(x, x))
        rows = rows.withColumn("x", F.when(norm > 0, F.transform(x, lambda v: v / norm)).otherwise(x))
    rows = rows.withColumn("sq", _dot(x, x))
    sums = _cluster_sums(rows)
    if len(sums) < 2:
        raise ValueError("a silhouette needs rows in two clusters or more")
    clusters = F.array(*[
        F.struct(F.lit(s.label).alias("label"), F.lit(float(s.n)).alias("n"), F.lit(s.sq / s.n).alias("sq"), F.array(*map(F.lit, s.mean)).alias("mean"))
        for s in sums
    ])
    if distance == "cosine":
        far = lambda c: 1 - _dot(x, c["mean"])
    else:
        far = lambda c: F.col("sq") + c["sq"] - 2 * _dot(x, c["mean"])
    # The n rows of a row's own cluster hold the row itself, which does not count.
    itself = 1 - F.col("sq") if distance == "cosine" else F.lit(0.0)
    measured = F.transform(clusters, lambda c: F.struct((c["label"] == F.col("label")).alias("own"), c["n"].alias("n"), far(c).alias("far")))
    rows = rows.withColumn("measured", measured)
    own = F.filter("measured", lambda m: m["own"])[0]
    inside = (own["far"] * own["n"] - itself) / (own["n"] - 1)
    outside = F.array_min(F.transform(F.filter("measured", lambda m: ~m["own"]), lambda m: m["far"]))
    rows = rows.select("label", own["n"].alias("n"), F.when(own["n"] > 1, inside).alias("a"), outside.alias("b"))
    score = (
        F.when(F.col("n") == 1, 0.0)
        .when(F.col("a") < F.col("b"), 1 - F.col("a") / F.col("b"))
        .when(F.col("a") > F.col("b"), F.col("b") / F.col("a") - 1)
        .otherwise(0.0)
    )
    return rows.select(F.col("label").alias(label), score.alias("score"))


def _cluster_sums(rows: DataFrame) -> list[Row]:
    """Per cluster ``label, n, sq`` and the ``mean`` vector: one row of sums per cluster and task is shuffled."""
    table = rows.select("label", "sq", array_to_vector("x").alias("v"))
    sums = table.groupBy("label").agg(F.count("*").alias("n"), F.sum("sq").alias("sq"), vector_to_array(Summarizer.mean(F.col("v"))).alias("mean"))
    return sums.orderBy("label").collect()  # one row per cluster


def silhouette_per_cluster(
    df: DataFrame, label: str = "prediction", vector: str = VECTOR, distance: str = "squaredEuclidean"
) -> DataFrame:
    """Rows and mean silhouette of each cluster: ``label, n, score``, by label. Weighted by ``n``, the scores average to ``silhouette``."""
    scores = row_silhouettes(df, label, vector, distance)
    return scores.groupBy(label).agg(F.count("*").alias("n"), F.avg("score").alias("score")).orderBy(label)
