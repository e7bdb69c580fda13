import json
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from segmill.operators import commits
from segmill.operators.staging import Scope, stage, staging_root
from segmill.plans import Config, DataPaths, Preprocessing, Training, load_config, predict, prepare_training
from segmill.plans import run_prediction, run_training, train
from segmill.sinks import publish_results, read_published, save_bundle, write_csv, write_document
from segmill.sources import load_bundle, read_json_rows

LABEL_COLUMNS = ["product_name_langs", "product_name_texts", "a", "b", "prediction"]


@pytest.fixture(scope="module")
def products(spark):
    """400 distinct products in two groups, each twice; one feature with gaps, others unusable."""
    n = F.col("id") % 400
    group = (n % 4 == 0).cast("int")
    return spark.range(800).select(
        F.array(F.struct(F.lit("en").alias("lang"), n.cast("string").alias("text"))).alias("product_name"),
        (group * 100 + n % 9).cast("int").alias("a"),
        F.when(n % 20 != 1, group * -50.0 + n % 5).alias("b"),
        F.lit(3).alias("flat"),
        F.when(n % 2 == 0, n).alias("sparse"),
        F.lit("x").alias("other"),
    )


@pytest.fixture(scope="module")
def result(products):
    return train(products, Preprocessing(), Training(k_max=4))


def test_prepared_table(products):
    for sampling in ("hash", "bernoulli"):
        table = prepare_training(products, Preprocessing(target_n=2000, sampling=sampling))
        assert (table.feature_cols, table.text_cols) == (["a", "b"], LABEL_COLUMNS[:2])
        assert (table.rows_total, table.rows_working, table.df.count()) == (800, 400, 400)
        assert table.df.dtypes == [(c, "string") for c in LABEL_COLUMNS[:2]] + [("a", "double"), ("b", "double")]


def test_capped_table(products):
    table = prepare_training(products, Preprocessing(target_n=150))
    assert table.rows_working == table.df.count() == table.df.distinct().count() == 150
    table = prepare_training(products, Preprocessing(target_n=150, sampling="bernoulli"))
    assert table.rows_working == table.df.count() == table.df.distinct().count() <= 150


def test_training_result(result):
    assert result.best_k == 2 and result.best_score > 0.9
    assert result.labelled.columns == LABEL_COLUMNS
    assert [(r.prediction, r.n) for r in result.profiles.collect()] == [(0, 300), (1, 100)]
    assert result.centers.columns == ["prediction", "a", "b"]
    metrics = result.metrics.first()
    assert (metrics.rows_total, metrics.rows_working, metrics.features) == (800, 400, ["a", "b"])
    assert sum(r.n for r in result.profiles.collect()) == metrics.rows_working
    assert result.scores.count() == 3
    # the profile averages what is there, the center the imputed values
    profile, center = result.profiles.first(), result.centers.first()
    assert profile.a == pytest.approx(center.a, abs=1e-4)
    assert profile.b != pytest.approx(center.b, abs=1e-3)


def test_uncanonical_labels_are_the_raw_ones(products):
    result = train(products, Preprocessing(), Training(k_max=3, canonical_labels=False))
    assert result.bundle.label_order == []
    assert sorted(r.n for r in result.profiles.collect()) == [100, 300]


def test_bundle_round_trip_gives_the_same_labels(spark, products, result, tmp_path):
    root = str(tmp_path / "bundle")
    save_bundle(spark, result.bundle, root)
    loaded = load_bundle(spark, root)
    assert (loaded.feature_cols, loaded.text_cols, loaded.best_k) == (["a", "b"], LABEL_COLUMNS[:2], 2)
    predicted = predict(products, loaded)
    assert sorted(map(str, predicted.collect())) == sorted(map(str, result.labelled.collect()))
    info = loaded.info(spark, root).first()
    assert info.artifacts.kmeans_model == f"{root}/kmeans_model"
    assert info.imputed_cols == ["a_imp", "b_imp"]


def test_predict_options(products, result):
    keyed = products.withColumn("id", F.monotonically_increasing_id())
    kept = predict(keyed, result.bundle, dedup=False, keep=["id"])
    assert kept.count() == 800 and kept.columns == ["id", *LABEL_COLUMNS]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    lacking = predict(products.drop("b", "product_name"), result.bundle)
    assert lacking.columns == LABEL_COLUMNS
    assert lacking.where("b is not null or product_name_langs is not null").count() == 0


def test_dotted_feature_names_from_training_to_prediction(spark, products, tmp_path):
    dotted = products.withColumnRenamed("a", "a.x").withColumnRenamed("b", "b`y")
    result = train(dotted, Preprocessing(), Training(k_max=3))
    assert result.best_k == 2 and result.profiles.columns == ["prediction", "n", "a.x", "b`y"]
    save_bundle(spark, result.bundle, str(tmp_path / "bundle"))
    predicted = predict(dotted, load_bundle(spark, str(tmp_path / "bundle")))
    assert sorted(map(str, predicted.collect())) == sorted(map(str, result.labelled.collect()))


def test_score_and_profile_follow_from_the_labelled_rows(spark, products):
    """A capped run: what is reported is what the labelled rows of the sample give."""
    result = train(products, Preprocessing(target_n=120), Training(k_max=4))
    rows = result.labelled.collect()
    assert len(rows) == len(set(rows)) == result.metrics.first().rows_working == 120
    for profile in result.profiles.collect():
        own = [r for r in rows if r.prediction == profile.prediction]
        present = [r.b for r in own if r.b is not None]
        assert profile.n == len(own)
        assert profile.a == pytest.approx(sum(r.a for r in own) / len(own), abs=1e-4)
        assert profile.b == pytest.approx(sum(present) / len(present), abs=1e-4)
    middle = sorted(r.b for r in rows if r.b is not None)
    middle = middle[(len(middle) + 1) // 2 - 1]
    points = np.array([[r.a, middle if r.b is None else r.b] for r in rows])
    points = (points - points.mean(axis=0)) / points.std(axis=0, ddof=1)
    labels = np.array([r.prediction for r in rows])
    gaps = ((points[:, None] - points[None]) ** 2).sum(axis=2)
    scores = []
    for i, label in enumerate(labels):
        near = gaps[i][labels == label].sum() / ((labels == label).sum() - 1)
        far = min(gaps[i][labels == other].mean() for other in set(labels) - {label})
        scores.append((far - near) / max(near, far))
    assert result.best_score == pytest.approx(np.mean(scores), abs=1e-9)


def test_missing_bundle_is_an_error(spark, tmp_path):
    with pytest.raises(Exception):
        load_bundle(spark, str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_bundle_record_without_label_order(spark, result, tmp_path):
    """A record as one indented document, without the fields this engine adds."""
    root = Path(save_bundle(spark, result.bundle, str(tmp_path / "bundle")))
    record = result.bundle.info(spark, str(root)).first().asDict(recursive=True)
    del record["label_order"]
    folder = tmp_path / "other"
    folder.mkdir()
    for name in ("kmeans_model", "imputer_model", "scaler_model"):
        (folder / name).symlink_to(root / name)
    (folder / "model_info.json").write_text(json.dumps(record, indent=2))
    loaded = load_bundle(spark, str(folder))
    assert loaded.label_order == [] and loaded.feature_cols == ["a", "b"]


def test_save_that_dies_leaves_the_earlier_bundle(spark, products, result, tmp_path, monkeypatch):
    root = str(tmp_path / "bundle")
    first = save_bundle(spark, result.bundle, root)
    other = train(products, Preprocessing(), Training(k_min=3, k_max=3))
    from segmill.sinks import bundle as sink

    with monkeypatch.context() as patch:
        patch.setattr(sink, "write_document", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            save_bundle(spark, other.bundle, root)
    assert load_bundle(spark, root).best_k == 2
    second = save_bundle(spark, other.bundle, root)
    assert first != second and load_bundle(spark, root).best_k == 3


def test_run_published_last_is_the_latest_whatever_its_id(spark, result, tmp_path):
    root, tables = str(tmp_path / "results"), (result.profiles, result.centers, result.metrics, result.bundle.info(spark))
    publish_results(spark, root, *tables, run_id="v2")
    last = publish_results(spark, root, *tables)
    assert {r.run_id for r in read_published(spark, root, "training_metrics").collect()} == {last}


def test_default_training_uses_every_row(spark):
    df = spark.range(5000).select((F.col("id") % 2 * 100 + F.col("id") / 5000).alias("x"))
    table = prepare_training(df)
    assert (table.rows_total, table.rows_working) == (5000, 5000)


def test_capped_table_is_not_read_by_few_tasks(spark, tmp_path):
    """The scan of the whole table keeps its tasks; only the staged sample is read by a number that follows from its rows."""
    spark.range(0, 40_000, 1, 8).select(F.col("id").cast("double").alias("x")).write.parquet(str(tmp_path / "t"))
    source = spark.read.parquet(str(tmp_path / "t"))
    for sampling in ("hash", "bernoulli"):
        table = prepare_training(source, Preprocessing(target_n=9000, sampling=sampling))
        plan = table.df._jdf.queryExecution().executedPlan().toString()
        assert "Coalesce" not in plan and str(tmp_path / "t") not in plan
        assert table.rows_working == table.df.count() <= 9000


def test_features_called_like_results(spark, tmp_path):
    n = F.col("id")
    df = spark.range(60).select(
        (n % 2 * 100 + n % 3).alias("n"), (n % 2 * 50.0 + n).alias("prediction"), (n % 5).alias("features"), n.alias("a"), (n % 7).alias("a_imp")
    )
    result = train(df, Preprocessing(), Training(k_max=3))
    assert result.profiles.columns == ["prediction", "n", "n_", "prediction_", "features_", "a", "a_imp"]
    assert result.labelled.columns == ["n_", "prediction_", "features_", "a", "a_imp", "prediction"]
    save_bundle(spark, result.bundle, str(tmp_path / "b"))
    assert sorted(predict(df, load_bundle(spark, str(tmp_path / "b"))).collect()) == sorted(result.labelled.collect())


def test_kept_feature_appears_once_as_it_was(products, result):
    kept = predict(products, result.bundle, keep=["a", "a"])
    assert kept.columns == ["a", "product_name_langs", "product_name_texts", "b", "prediction"]
    assert dict(kept.dtypes)["a"] == "int" and kept.count() == 400


def test_release_deletes_the_working_table(spark):
    df = spark.range(100).select((F.col("id") % 2 * 100 + F.col("id")).alias("x"))
    result = train(df, Preprocessing(), Training(k_max=3))
    files = result.prepared.df.inputFiles()
    result.release()
    assert files and not any(Path(f.removeprefix("file://")).exists() for f in files)


def test_malformed_json(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a": 1}\n{"a": \n')
    with pytest.raises(Exception):
        read_json_rows(spark, str(tmp_path / "x.json"), "a int").collect()
    assert [r.a for r in read_json_rows(spark, str(tmp_path / "x.json"), "a int", on_bad="null").collect()] == [1, None]


def test_configured_jobs_write_every_output(spark, products, tmp_path):
    source = str(tmp_path / "products.parquet")
    products.write.parquet(source)
    paths = {f: str(tmp_path / f) for f in DataPaths.__dataclass_fields__ if f != "input_path"}
    config = Config(DataPaths(input_path=source, **paths), Preprocessing(median_error=0.001), Training(k_max=3))
    result = run_training(spark, config)
    run_prediction(spark, config)

    def csv(name):
        return spark.read.option("header", True).csv(paths[name])

    assert csv("clusters_csv_path").columns == LABEL_COLUMNS and csv("clusters_csv_path").count() == 400
    assert csv("predictions_csv_path").count() == 400
    assert csv("profiles_csv_path").columns == ["prediction", "n", "a", "b"]
    assert csv("centers_csv_path").columns == ["prediction", "a", "b"]
    assert len(list(Path(paths["profiles_csv_path"]).glob("part-*.csv"))) == 1
    document = [json.loads(p.read_text()) for p in Path(paths["metrics_json_path"]).glob("part-*.json")]
    assert [d["best_k"] for d in document] == [result.best_k]
    assert read_published(spark, paths["results_root"], "model_info").first().input_path == source
    with pytest.raises(ValueError, match="needs a model path"):
        run_prediction(spark, Config())
    with pytest.raises(ValueError, match="no input_path"):
        run_training(spark, Config())


def test_readers_see_the_latest_whole_run(spark, result, tmp_path):
    root = str(tmp_path / "results")
    tables = (result.profiles, result.centers, result.metrics, result.bundle.info(spark))
    first = publish_results(spark, root, *tables)
    broken = result.profiles.withColumn("n", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        publish_results(spark, root, result.profiles, broken, result.metrics, tables[3])
    assert {r.run_id for r in read_published(spark, root, "cluster_profiles").collect()} == {first}
    second = publish_results(spark, root, result.profiles.limit(1), *tables[1:])
    assert second > first
    assert read_published(spark, root, "cluster_profiles").count() == 1
    for table in ("cluster_centers", "training_metrics", "model_info"):
        assert {r.run_id for r in read_published(spark, root, table).collect()} == {second}
    assert read_published(spark, root, "cluster_profiles", first).count() == 2
    with pytest.raises(ValueError, match="no such result table"):
        read_published(spark, root, "clusters")


def test_csv_text_forms(spark, tmp_path):
    df = spark.createDataFrame([("", None, 1.48e9, 'say "a, b"')], "e string, n string, d double, q string")
    write_csv(df, str(tmp_path / "t"), single=True)
    part = next((tmp_path / "t").glob("part-*.csv"))
    assert part.read_text() == 'e,n,d,q\n"",,1.48E9,"say \\"a, b\\""\n'
    write_csv(df.select("d"), str(tmp_path / "t"))
    assert spark.read.option("header", True).csv(str(tmp_path / "t")).columns == ["d"]


def test_document_keeps_nulls(spark, tmp_path):
    write_document(spark.createDataFrame([(1, None)], "a int, b string"), str(tmp_path / "d"))
    assert json.loads(next((tmp_path / "d").glob("part-*")).read_text()) == {"a": 1, "b": None}
    assert tuple(read_json_rows(spark, str(tmp_path / "d"), "a int, b string").first()) == (1, None)


def test_config_file(tmp_path):
    path = tmp_path / "config.json"
    path.write_text(json.dumps({"spark": {"master": "x"}, "preprocessing": {"target_n": 5}, "training": {"k_max": 3}}))
    config = load_config(str(path))
    assert (config.preprocessing.target_n, config.preprocessing.min_non_null_ratio) == (5, 0.9)
    assert (config.training.k_min, config.training.k_max, config.training.seed) == (2, 3, 42)
    path.write_text(json.dumps({"training": {"kmax": 3}}))
    with pytest.raises(ValueError, match="unknown Training options: kmax"):
        load_config(str(path))


def test_a_reused_run_id_is_never_seen_half_written(spark, result, tmp_path, monkeypatch):
    """Readers look after every table of a second publication under the same id."""
    root, info = str(tmp_path / "results"), result.bundle.info(spark)
    publish_results(spark, root, result.profiles, result.centers, result.metrics, info, "same")
    seen, whole = [], commits.append

    def look():
        seen.append(tuple(read_published(spark, root, t, "same").count() for t in ("cluster_profiles", "cluster_centers", "training_metrics")))

    def append(*args):
        look()
        return whole(*args)

    monkeypatch.setattr(commits, "append", append)
    publish_results(spark, root, result.profiles.limit(1), result.centers.limit(1), result.metrics, info, "same")
    look()
    assert seen == [(2, 2, 1), (1, 1, 1)]
    with pytest.raises(ValueError, match="nothing published"):
        read_published(spark, root, "model_info", "other")
    with pytest.raises(ValueError, match="nothing published"):
        read_published(spark, str(tmp_path / "none"), "model_info")


def test_the_later_commit_wins_whatever_the_clocks_say(spark, result, tmp_path, monkeypatch):
    import time
    from dataclasses import replace

    root = str(tmp_path / "bundle")
    for n, clock in enumerate((2_000, 1_000)):
        monkeypatch.setattr(time, "time_ns", lambda clock=clock: clock)
        monkeypatch.setattr(time, "time", lambda clock=clock: clock / 1e9)
        save_bundle(spark, replace(result.bundle, best_score=float(n)), root)
    monkeypatch.undo()
    assert load_bundle(spark, root).best_score == 1.0


def test_writers_of_one_number_get_different_ones(spark, tmp_path):
    """A hundred entries by ten writers at once, all of which may look before any has written."""
    from concurrent.futures import ThreadPoolExecutor

    folder = str(tmp_path / "log")
    with ThreadPoolExecutor(10) as pool:
        numbers = list(pool.map(lambda i: commits.append(spark, folder, {"version": f"v{i}"}), range(100)))
    assert sorted(numbers) == list(range(1, 101))
    rows = commits.entries(spark, folder, "version string").collect()
    assert {(r.entry, r.version) for r in rows} == {(n, f"v{i}") for i, n in enumerate(numbers)}


def test_an_entry_without_text_does_not_count(spark, tmp_path):
    folder = str(tmp_path / "log")
    assert commits.entries(spark, folder, "version string").count() == 0
    commits.append(spark, folder, {"version": "a"})
    assert commits.create_once(spark, f"{folder}/{2:020d}.json", "")
    assert not commits.create_once(spark, f"{folder}/{2:020d}.json", "x")
    assert [tuple(r) for r in commits.entries(spark, folder, "version string").collect()] == [(1, "a")]
    assert commits.append(spark, folder, {"version": "b"}) == 3


def staged(spark):
    return set(Path(staging_root(spark).removeprefix("file:")).glob("*"))


@pytest.mark.parametrize("options", [Preprocessing(), Preprocessing(target_n=100), Preprocessing(target_n=100, sampling="bernoulli")])
def test_training_leaves_its_working_table_only(spark, products, options):
    before = staged(spark)
    trained = train(products, options, Training(k_max=2))
    left = staged(spark) - before
    assert len(left) == 1 and trained.labelled.count() == trained.prepared.rows_working
    trained.release()
    assert staged(spark) == before


def test_failed_training_leaves_nothing(spark, products):
    before = staged(spark)
    with pytest.raises(ValueError, match="too few rows"):
        train(products, Preprocessing(), Training(k_min=5000, k_max=6000))
    assert staged(spark) == before


def test_scopes_in_scopes(spark):
    before = staged(spark)
    with Scope() as outer:
        with Scope() as inner:
            kept, _ = stage(spark.range(3), "kept"), stage(spark.range(3), "gone")
            inner.keep(kept.where("id > 0"))
        assert len(staged(spark) - before) == 1
        with pytest.raises(RuntimeError), Scope() as failed:
            failed.keep(stage(spark.range(3), "kept"))
            raise RuntimeError
        assert len(staged(spark) - before) == 1
        outer.keep(kept)
    assert kept.count() == 3
    with Scope():
        stage(spark.range(3), "gone")
    assert len(staged(spark) - before) == 1
