"""K-means fits, the search for the number of clusters, and labelling."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_EXCEPTION, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from threading import Event

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StandardScalerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmill.operators.evaluate import silhouette
from segmill.operators.prepare import VECTOR

LABEL = "prediction"


def fit_kmeans(
    df: DataFrame,
    k: int,
    seed: int = 42,
    vector: str = VECTOR,
    distance: str = "euclidean",
) -> KMeansModel:
    """K-means with Spark's defaults for everything but the arguments.

    Always the row solver: it works on the cached vectors as they are, without a blocked
    copy per fit, and gives a model of fewer clusters when initialisation finds fewer
    centers than asked for (few distinct points, or outliers that draw all the sampling).
    """
    kmeans = KMeans(featuresCol=vector, predictionCol=LABEL, k=k, seed=seed, distanceMeasure=distance, solver="row")
    return kmeans.fit(df)


def original_centers(model: KMeansModel, scaler: StandardScalerModel) -> list[list[float]]:
    """The cluster centers before standardisation, by raw cluster index."""
    mean, std = scaler.mean.toArray(), scaler.std.toArray()
    return [(center * std + mean).tolist() for center in model.clusterCenters()]


def canonical_order(model: KMeansModel, scaler: StandardScalerModel) -> list[int]:
    """Raw cluster indexes in the order of their centers, coordinate by coordinate.

    K-means numbers its clusters by chance. Numbered in this order, clusters that come
    out the same get the same labels in every run.
    """
    centers = original_centers(model, scaler)
    # nine digits, so that noise from the order of summation does not decide
    return sorted(range(len(centers)), key=lambda i: [float(f"{x:.9g}") for x in centers[i]])


def assign(df: DataFrame, model: KMeansModel, order: Sequence[int] = ()) -> DataFrame:
    """Add the label of the nearest center, renumbered by ``order`` if there is one."""
    labelled = model.transform(df)
    if list(order) == list(range(len(order))):
        return labelled
    label_of = {raw: label for label, raw in enumerate(order)}
    lookup = F.array(*[F.lit(label_of[raw]) for raw in range(len(order))])
    return labelled.withColumn(LABEL, F.get(lookup, F.col(model.getPredictionCol())))


@dataclass(frozen=True)
class Sweep:
    """The best model of a search, and the score of every k tried (None where there was nothing to score)."""

    best_k: int
    best_score: float
    model: KMeansModel
    scores: list[tuple[int, float | None]]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.scores, "k int, score double")


def together[A, B](spark: SparkSession, work: Callable[[A], B], of: Sequence[A], parallelism: int) -> list[B]:
    """``work`` of every argument, ``parallelism`` side by side in threads, each with job properties of its own.

    After the first failure no further argument is begun, and jobs that are running or that a call still starts are
    cancelled until all calls have ended. All jobs carry one tag, so jobs of the caller go on.
    """
    context, tag, failed = spark.sparkContext, f"together-{uuid.uuid4().hex}", Event()

    def one(argument: A) -> B | None:
        if failed.is_set():
            return None
        context.addJobTag(tag)
        try:
            return work(argument)
        except BaseException:
            failed.set()
            raise

    with ThreadPoolExecutor(parallelism) as pool:
        calls: list[Future] = [pool.submit(inheritable_thread_target(spark)(one), argument) for argument in of]
        done, open_ = wait(calls, return_when=FIRST_EXCEPTION)
        errors = [call.exception() for call in done if call.exception()]
        while open_:
            for call in open_:
                call.cancel()
            context.cancelJobsWithTag(tag)
            _, open_ = wait(open_, timeout=0.2)
    if errors:
        raise errors[0]
    return [call.result() for call in calls]


def sweep(
    prepared: DataFrame,
    k_min: int = 2,
    k_max: int = 10,
    seed: int = 42,
    distance: str = "squaredEuclidean",
    metric: str = "silhouette",
    fit_distance: str = "euclidean",
    rows: int | None = None,
    parallelism: int = 4,
) -> Sweep:
    """Fit every k from ``k_min`` to ``k_max`` (less than the number of rows) and keep the best score.

    Of equal scores the smallest k wins. The vectors are cached once for all fits and
    released at the end: 8 bytes per row and feature, in memory or on the executors' disks. ``parallelism`` fits run
    side by side, each in its own job group, so that the executors have work while another fit
    is between its jobs. A running fit adds 8 bytes per row (the vectors' norms) and k centers per task.
    If a fit fails, those not begun are dropped and the jobs of the others cancelled, and its error is raised.
    """
    spark = prepared.sparkSession
    vectors = prepared.select(VECTOR).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = vectors.count() if rows is None else rows
        k_max = min(k_max, rows - 1)
        if k_max < k_min:
            raise ValueError(f"too few rows to form {k_min} clusters")

        def fit_and_score(k: int) -> tuple[int, float | None, KMeansModel]:
            spark.sparkContext.setJobGroup(f"kmeans-k-{k}", f"K-means with k={k}: fit and score")
            model = fit_kmeans(vectors, k, seed, distance=fit_distance)
            # Without rows in two clusters there is nothing to score.
            scored = sum(size > 0 for size in model.summary.clusterSizes) > 1
            return k, silhouette(model.transform(vectors), LABEL, VECTOR, distance, metric) if scored else None, model

        # Longest first.
        tried = sorted(together(spark, fit_and_score, range(k_max, k_min - 1, -1), parallelism), key=lambda t: t[0])
    finally:
        vectors.unpersist()

    best_k, best_score, best_model = None, -1.0, None
    for k, score, model in tried:
        if score is not None and score > best_score:
            best_k, best_score, best_model = k, score, model
    if best_model is None:
        raise ValueError(f"no k from {k_min} to {k_max} gives clusters that can be scored")
    return Sweep(best_k, best_score, best_model, [(k, score) for k, score, _ in tried])

