import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from segmill.operators import cluster, summarise
from segmill.operators.evaluate import silhouette, silhouette_per_cluster
from segmill.operators.prepare import fit_preparation


def naive_silhouette(points, labels, distance):
    d = np.array([[distance(p, q) for q in points] for p in points])
    scores = []
    for i, own in enumerate(labels):
        mine = labels == own
        if mine.sum() == 1:
            scores.append(0.0)
            continue
        a = d[i][mine].sum() / (mine.sum() - 1)
        b = min(d[i][labels == c].mean() for c in set(labels) - {own})
        scores.append((b - a) / max(a, b))
    return np.mean(scores)


@pytest.mark.parametrize("name", ["squaredEuclidean", "cosine"])
def test_silhouette_against_all_pairs(spark, name):
    rng = np.random.default_rng(1)
    points, labels = rng.normal(size=(40, 3)), np.array([0] * 15 + [1] * 24 + [2])
    rows = [(p.tolist(), int(c)) for p, c in zip(points, labels)]
    df = spark.createDataFrame(rows, "v array<double>, prediction int")
    df = df.select(array_to_vector("v").alias("features"), "prediction")
    distance = {
        "squaredEuclidean": lambda p, q: ((p - q) ** 2).sum(),
        "cosine": lambda p, q: 1 - p @ q / np.linalg.norm(p) / np.linalg.norm(q),
    }[name]
    assert silhouette(df, distance=name) == pytest.approx(naive_silhouette(points, labels, distance), abs=1e-9)


def prepared_points(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "a double")
    chain = fit_preparation(df, ["a"])
    return chain, chain.apply(df)


def test_sweep_finds_the_groups(spark):
    _, prepared = prepared_points(spark, [g * 100 + i for g in range(4) for i in range(5)])
    best = cluster.sweep(prepared, 2, 6)
    assert best.best_k == 4 and best.best_score > 0.99
    table = best.table(spark)
    assert [r.k for r in table.orderBy("k").collect()] == [2, 3, 4, 5, 6]
    assert table.agg(F.max("score")).first()[0] == best.best_score
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_each_k_has_its_job_group(spark):
    _, prepared = prepared_points(spark, [1, 2, 10, 11, 20, 21])
    cluster.sweep(prepared, 2, 3)
    tracker = spark.sparkContext.statusTracker()
    assert all(len(tracker.getJobIdsForGroup(f"kmeans-k-{k}")) > 2 for k in (2, 3))
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None


def test_sweep_stops_below_the_number_of_rows(spark):
    _, prepared = prepared_points(spark, [1, 2, 10, 11])
    assert [k for k, _ in cluster.sweep(prepared, 2, 10).scores] == [2, 3]
    with pytest.raises(ValueError, match="too few rows"):
        cluster.sweep(prepared, 4, 10)


def test_fewer_distinct_points_than_k(spark):
    _, prepared = prepared_points(spark, [1] * 6 + [5] * 6)
    best = cluster.sweep(prepared, 2, 4)
    assert (best.best_k, best.best_score) == (2, 1.0)  # ties go to the smaller k


def test_one_distinct_point_cannot_be_scored(spark):
    _, prepared = prepared_points(spark, [1] * 6)
    with pytest.raises(ValueError, match="can be scored"):
        cluster.sweep(prepared, 2, 3)


def test_canonical_labels_follow_the_centers(spark):
    chain, prepared = prepared_points(spark, [50, 51, 52, -7, -8, 0.5, 900, 901])
    for seed in range(4):
        model = cluster.fit_kmeans(prepared, 3, seed)
        order = cluster.canonical_order(model, chain.scaler)
        centers = summarise.centers(spark, model, chain.scaler, ["a"], order).collect()
        assert [c.prediction for c in centers] == [0, 1, 2]
        assert [c.a for c in centers] == sorted(c.a for c in centers)
        labelled = cluster.assign(prepared, model, order)
        assert dict(labelled.dtypes)["prediction"] == "int"
        means = {r.prediction: r.a for r in labelled.groupBy("prediction").agg(F.avg("a").alias("a")).collect()}
        assert [means[i] for i in range(3)] == pytest.approx([c.a for c in centers])


def test_assign_is_nearest_center(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame(rng.normal(size=(300, 2)).tolist(), "x double, y double")
    chain = fit_preparation(df, ["x", "y"])
    prepared = chain.apply(df)
    model = cluster.fit_kmeans(prepared, 4)
    order = cluster.canonical_order(model, chain.scaler)
    centers = [[c.x, c.y] for c in summarise.centers(spark, model, chain.scaler, ["x", "y"], order).collect()]
    std = chain.scaler.std.toArray()
    for row in cluster.assign(prepared, model, order).collect():
        gaps = [np.sum(((np.array([row.x, row.y]) - c) / std) ** 2) for c in centers]
        assert row.prediction == int(np.argmin(gaps))


def test_cosine_fit(spark):
    df = spark.createDataFrame([(1.0, 0.1), (9.0, 1.0), (0.1, 1.0), (1.0, 9.0)], "x double, y double")
    vectors = df.select(array_to_vector(F.array("x", "y")).alias("features"))
    model = cluster.fit_kmeans(vectors, 2, distance="cosine")
    labels = [r.prediction for r in model.transform(vectors).collect()]
    assert labels[0] == labels[1] != labels[2] == labels[3]


def test_profiles_skip_missing_values_and_are_sorted(spark):
    rows = [(1, 1.0, None), (1, 2.0, 4.0), (0, 0.00005, None), (0, 0.00006, None)]
    df = spark.createDataFrame(rows, "prediction int, a double, `b.c` double")
    assert [tuple(r) for r in summarise.profiles(df, ["a", "b.c"]).collect()] == [(0, 2, 0.0001, None), (1, 2, 1.5, 4.0)]


def test_metrics_record(spark):
    row = summarise.metrics(spark, 2, 0.5, 100, 20, ["a", "b"]).first()
    assert row.asDict() == {
        "best_k": 2, "best_score": 0.5, "metric_name": "silhouette", "rows_total": 100, "rows_working": 20,
        "features_count": 2, "features": ["a", "b"],
    }


@pytest.mark.parametrize("name", ["squaredEuclidean", "cosine"])
def test_silhouette_per_cluster(spark, name):
    rng = np.random.default_rng(3)
    points, labels = rng.normal(size=(60, 3)) + 1, np.array([0] * 25 + [4] * 34 + [7])
    rows = [(p.tolist(), int(c)) for p, c in zip(points, labels, strict=True)]
    df = spark.createDataFrame(rows, "v array<double>, prediction int").select("prediction", array_to_vector("v").alias("features"))
    odd = df.unionByName(spark.createDataFrame([(None, [1.0, 2.0, 3.0]), (4, None)], "prediction int, v array<double>").select("prediction", F.when(F.col("v").isNotNull(), array_to_vector("v")).alias("features")))
    got = silhouette_per_cluster(odd, distance=name).collect()
    assert [(r.prediction, r.n) for r in got] == [(0, 25), (4, 34), (7, 1)] and got[2].score == 0.0
    whole = sum(r.n * r.score for r in got) / 60
    assert whole == pytest.approx(silhouette(df, distance=name), abs=1e-9)

    def distance(p, q):
        return ((p - q) ** 2).sum() if name == "squaredEuclidean" else 1 - p @ q / np.sqrt((p @ p) * (q @ q))

    assert whole == pytest.approx(naive_silhouette(points, labels, distance), abs=1e-9)


def test_silhouette_needs_two_clusters_and_a_known_distance(spark):
    df = spark.range(4).select(F.lit(1).alias("prediction"), array_to_vector(F.array(F.col("id").cast("double"))).alias("features"))
    with pytest.raises(ValueError, match="two clusters"):
        silhouette_per_cluster(df)
    with pytest.raises(ValueError, match="two clusters"):
        silhouette_per_cluster(df.where("false"))
    with pytest.raises(ValueError, match="distance must be"):
        silhouette_per_cluster(df, distance="manhattan")


def test_zero_vector_is_at_distance_one_by_cosine(spark):
    rows = [(0, [0.0, 0.0]), (0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.0, 2.0])]
    df = spark.createDataFrame(rows, "prediction int, v array<double>").select("prediction", array_to_vector("v").alias("features"))
    assert [r.score for r in silhouette_per_cluster(df, distance="cosine").collect()] == pytest.approx([0.0, 1.0])


def test_a_failed_fit_stops_the_sweep(spark, monkeypatch):
    prepared = spark.range(300).select(array_to_vector(F.array((F.col("id") % 3 * 10).cast("double"), F.rand(1))).alias("features"))
    begun, whole = [], cluster.fit_kmeans

    def fit(df, k, *args, **kwargs):
        begun.append(k)
        if k == 9:
            raise RuntimeError("no fit of nine")
        return whole(df, k, *args, **kwargs)

    monkeypatch.setattr(cluster, "fit_kmeans", fit)
    with pytest.raises(RuntimeError, match="no fit of nine"):
        cluster.sweep(prepared, 2, 10, parallelism=1)
    assert begun == [10, 9]
    tracker = spark.sparkContext.statusTracker()
    assert not tracker.getActiveJobsIds()


def test_running_jobs_are_cancelled_after_a_failure(spark):
    """One call runs jobs for minutes; the failure of the other ends it, and jobs of others go on."""
    from time import monotonic, sleep

    def work(argument):
        if argument == "fails":
            sleep(1.5)
            raise ValueError("failed")
        slow = spark.range(0, 8, 1, 8).select(F.expr("java_method('java.lang.Thread', 'sleep', 60000L + id)"))
        slow.collect()

    start = monotonic()
    with pytest.raises(ValueError, match="failed"):
        cluster.together(spark, work, ["slow", "fails", "never"], 2)
    assert monotonic() - start < 40
    assert spark.range(10).count() == 10
    assert cluster.together(spark, lambda x: x + spark.range(x).count(), [3, 1, 2], 2) == [6, 2, 4]
