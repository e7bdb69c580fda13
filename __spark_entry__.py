"""

Every query reads whole tables. Inputs that the generated tables do not offer
(gaps, constants, nested names, well-separated clusters) are derived from them row
by row, with the same expressions on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segmill.functions import named
from segmill.operators import cluster, summarise
from segmill.operators.evaluate import silhouette, silhouette_per_cluster
from segmill.operators.features import column_stats, numeric_columns, usable_features
from segmill.operators.prepare import VECTOR, fit_imputer, fit_preparation
from segmill.operators.project import align, flatten_names, json_safe, training_columns
from segmill.operators.sampling import cap_rows, distinct_sample
from segmill.operators.staging import owned, stage, staging_path
from segmill.operators.text import word_count
from segmill.plans import (
    Config, DataPaths, Preprocessing, Training, TrainResult, predict, prepare_training, run_prediction, run_training, train,
)
from segmill.sinks import publish_results, read_published, save_bundle, write_csv, write_document, write_json_rows
from segmill.sources import load_bundle, read_json_quarantine, read_json_rows, read_lines, read_table

try:
    from segmill.llm import queries as llm_queries
except ModuleNotFoundError as error:
    if not (error.name or "").startswith("segmill.llm"):
        raise  # the subpackage is there, but something that it needs is not
    llm_queries = None

ENTRY_DIR = "/root/testdata/sf0.001"
LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def _rounded(column: Column, digits: int, name: str) -> Column:
    return (F.round(column, digits) + F.lit(0.0)).alias(name)


# Derived inputs


def _events_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with one feature filled to 95 % and one to 80 %, and a constant."""
    return _read(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.when(F.col("event_id") % 20 != 0, F.col("value")).alias("value"),
        F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("sparse"),
        F.lit(1.0).alias("flat"),
    )


def _events_flawed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a column that holds one NaN and one that holds one infinity."""
    first = F.col("event_id") == 1
    return _events_gaps(spark, sf_dir).select(
        "*",
        F.when(first, float("nan")).otherwise(F.col("value")).alias("with_nan"),
        F.when(first, float("inf")).otherwise(F.col("value")).alias("with_inf"),
    )


def _banded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items labelled by quantity."""
    quantity = F.col("l_quantity")
    label = F.when(quantity < 17, 0).when(quantity < 34, 1).otherwise(2)
    return _read(spark, sf_dir, "lineitem").select(*LINE_FEATURES, label.alias("prediction"))


def _blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as points around three far-apart centers; ``product_name`` tells the rows apart."""
    group = F.col("o_orderkey") % 3
    return _read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("product_name"),
        (group * 1000 + F.col("o_custkey") % 10).alias("x"),
        (group * -500 + F.col("o_custkey") % 7).alias("y"),
    )


def _uneven_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as points around two near centers and a far one: two clusters are as plain as three."""
    group = F.col("o_orderkey") % 3
    return _read(spark, sf_dir, "orders").select(
        (F.when(group == 2, 9000).otherwise(group * 1000) + F.col("o_custkey") % 10).alias("x"),
        (group * -500 + F.col("o_custkey") % 7).alias("y"),
    )


def _train_blobs(spark: SparkSession, sf_dir: str) -> TrainResult:
    options = Preprocessing(target_n=None)
    return train(_blobs(spark, sf_dir), options, Training(k_min=2, k_max=4), f"{sf_dir}/orders.parquet")


def _prepared_blobs(spark: SparkSession, sf_dir: str):
    blobs = stage(training_columns(_blobs(spark, sf_dir), ["x", "y"]), "blobs")
    chain = fit_preparation(blobs, ["x", "y"])
    return chain, chain.apply(blobs)


# Feature choice and projections


def column_fill_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _events_gaps(spark, sf_dir)
    return column_stats(df, numeric_columns(df.schema)).select(
        "column", "rows", "filled", _rounded(F.col("fill_ratio"), 6, "fill_ratio"),
        _rounded(F.col("stddev"), 4, "stddev"),
    )


def feature_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _events_flawed(spark, sf_dir)
    return usable_features(column_stats(df, numeric_columns(df.schema))).select("column", "filled")


def cast_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _read(spark, sf_dir, "part").withColumnRenamed("p_name", "product_name")
    return training_columns(df, numeric_columns(df.schema))


def flatten_names_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    other = F.when(F.col("doc_id") % 3 != 0, F.col("source"))
    names = F.array(
        F.struct(F.col("lang"), F.col("text")), F.struct(other.alias("lang"), F.col("source").alias("text"))
    )
    df = _read(spark, sf_dir, "documents").withColumn("product_name", F.when(F.col("doc_id") % 7 != 0, names))
    return flatten_names(df, keep=["doc_id"])


def flatten_names_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _read(spark, sf_dir, "documents")
    df = df.withColumn("product_name", F.when(F.col("doc_id") % 7 != 0, F.struct("lang", "source", "n_chars")))
    return flatten_names(df, keep=["doc_id"])


def flatten_names_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_names(_read(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "product_name"))


def align_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _read(spark, sf_dir, "orders").withColumn("product_name", F.struct(F.col("o_orderstatus").alias("lang")))
    return align(
        df,
        features=["o_totalprice", "lost_feature", "o_custkey"],
        text_cols=["product_name_lang", "product_name_text"],
        keep=["o_orderkey"],
    )


def json_safe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    tenth = F.col("event_id") % 10
    bad = F.when(tenth == 0, float("nan")).when(tenth == 1, float("inf")).when(tenth == 2, float("-inf"))
    value = F.coalesce(bad, F.col("value"))
    df = _read(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        value.alias("value"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
        F.struct(value.alias("v"), F.array(F.struct(value.alias("w"), F.col("ts").alias("at"))).alias("items")).alias("s"),
        F.create_map(F.lit("v"), value).alias("m"),
    )
    return json_safe(df).select(
        "event_id", "ts", "value", "amount",
        F.col("s.v").alias("in_struct"),
        F.col("s.items")[0]["w"].alias("in_array"),
        F.col("s.items")[0]["at"].alias("time_in_array"),
        F.col("m")["v"].alias("in_map"),
    )


# Duplicates and sampling


def dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _read(spark, sf_dir, "lineitem").select("l_quantity", "l_discount", "l_tax")
    rows = lines.count()
    return distinct_sample(lines, rows, 42, rows)[0]


def sample_bernoulli(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return cap_rows(_read(spark, sf_dir, "lineitem"), 2000, seed=42, mode="bernoulli", keys=keys)


def sample_repeatable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_rows(_read(spark, sf_dir, "orders"), 1000, seed=42, mode="hash", keys=["o_orderkey"])


def sample_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of the distinct parts per supplier, from a table that has each of them several times."""
    lines = _read(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    lines = lines.unionByName(lines)
    return distinct_sample(lines, 1000, 42, lines.count(), ["l_partkey", "l_suppkey"])[0]


def prepare_training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_training(_events_flawed(spark, sf_dir), Preprocessing(target_n=None)).df


def prepare_training_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = Preprocessing(target_n=2000, sample_keys=("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    return prepare_training(_read(spark, sf_dir, "lineitem"), options).df


def default_train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training with default options: every distinct row counts."""
    result = train(_read(spark, sf_dir, "lineitem").select(*LINE_FEATURES), training=Training(k_max=3))
    in_profiles = result.profiles.agg(F.sum("n").alias("rows_in_profiles"))
    return result.metrics.select("rows_total", "rows_working").join(in_profiles)


# Imputation and standardisation


def _fitted_values(spark: SparkSession, sf_dir: str, columns: list[str], strategy: str) -> DataFrame:
    lines = _read(spark, sf_dir, "lineitem").select(*columns)
    return fit_imputer(lines, columns, strategy).surrogateDF


def median_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted_values(spark, sf_dir, LINE_FEATURES, "median").select(*LINE_FEATURES)


def median_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians of columns that spread over hundreds of powers of two, and of one that is mostly one value."""
    lines = _read(spark, sf_dir, "lineitem").select(
        F.pow(F.lit(2.0), F.col("l_orderkey") % 2000 - 1000).alias("wide"),
        (F.pow(F.lit(2.0), F.col("l_partkey") % 600 - 300) * F.when(F.col("l_suppkey") % 2 == 0, -1).otherwise(1)).alias("signed"),
        F.when(F.col("l_linenumber") < 5, 1.0).otherwise(F.col("l_extendedprice")).alias("heavy"),
    )
    return fit_imputer(lines, lines.columns, "median").surrogateDF.select(*lines.columns)


def mean_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = _fitted_values(spark, sf_dir, LINE_FEATURES, "mean")
    return means.select(*[_rounded(F.col(c), 4, c) for c in LINE_FEATURES])


def mode_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted_values(spark, sf_dir, LINE_FEATURES, "mode").select(*LINE_FEATURES)


def impute_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events_gaps(spark, sf_dir)
    imputer = fit_imputer(events, ["value", "sparse"], "median")
    return imputer.transform(events).select("event_id", "value", "sparse", "value_imp", "sparse_imp")


def standardise_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = ["p_size", "p_retailprice"]
    part = _read(spark, sf_dir, "part")
    scaled = vector_to_array(F.col(VECTOR))
    return (
        fit_preparation(part, features)
        .apply(part)
        .select("p_partkey", *[_rounded(scaled[i], 6, f"{c}_scaled") for i, c in enumerate(features)])
    )


# Clusters


def cluster_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarise.profiles(_banded(spark, sf_dir), LINE_FEATURES)


def _score_row(spark: SparkSession, score: float) -> DataFrame:
    return spark.createDataFrame([(score,)], "score double").select(_rounded(F.col("score"), 6, "score"))


def silhouette_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _banded(spark, sf_dir).select("prediction", array_to_vector(F.array(*LINE_FEATURES)).alias(VECTOR))
    return _score_row(spark, silhouette(df))


def silhouette_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _banded(spark, sf_dir).select("prediction", array_to_vector(F.array(*LINE_FEATURES)).alias(VECTOR))
    return _score_row(spark, silhouette(df, distance="cosine"))


def silhouettes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silhouettes per cluster by both distances; one of the clusters is a single row."""
    price = F.col("o_totalprice")
    label = F.when(F.col("o_orderkey") == 0, 3).when(price < 100_000, 0).when(price < 250_000, 1).otherwise(2)
    rows = _read(spark, sf_dir, "orders").select(
        label.alias("prediction"), array_to_vector(F.array(price / 1000, F.col("o_custkey").cast("double"))).alias(VECTOR)
    )
    tables = [silhouette_per_cluster(rows, distance=d).withColumn("distance", F.lit(d)) for d in ("squaredEuclidean", "cosine")]
    return tables[0].unionByName(tables[1]).select("distance", "prediction", "n", _rounded(F.col("score"), 6, "score"))


def kmeans_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    chain, prepared = _prepared_blobs(spark, sf_dir)
    model = cluster.fit_kmeans(prepared.select(VECTOR), k=3, seed=42)
    order = cluster.canonical_order(model, chain.scaler)
    return cluster.assign(prepared, model, order).select("product_name", "x", "y", "prediction")


def kmeans_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, prepared = _prepared_blobs(spark, sf_dir)
    best = cluster.sweep(prepared, 2, 4)
    return best.table(spark).where(F.col("k") == best.best_k).select("k", _rounded(F.col("score"), 6, "score"))


def sweep_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    blobs = _uneven_blobs(spark, sf_dir)
    prepared = fit_preparation(blobs, ["x", "y"]).apply(blobs)
    return cluster.sweep(prepared, 2, 3).table(spark).select("k", _rounded(F.col("score"), 6, "score"))


def cluster_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    chain, prepared = _prepared_blobs(spark, sf_dir)
    model = cluster.fit_kmeans(prepared.select(VECTOR), k=3, seed=42)
    order = cluster.canonical_order(model, chain.scaler)
    table = summarise.centers(spark, model, chain.scaler, ["x", "y"], order)
    return table.select("prediction", *[_rounded(named(c), 6, c) for c in ("x", "y")])


def _line_segments(spark: SparkSession, sf_dir: str) -> TrainResult:
    """The whole of lineitem: prepared, searched for k = 2 to 10, profiled."""
    return train(_read(spark, sf_dir, "lineitem").select(*LINE_FEATURES))


def lineitem_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold for any clustering: rows and averages add up, and every row has the label of the nearest center."""
    result = _line_segments(spark, sf_dir)
    profiles, scaler = result.profiles, result.bundle.scaler
    averages = [
        F.round(F.sum(F.col("n") * F.col(c)) / F.sum("n"), 2).alias(c) for c in LINE_FEATURES
    ]  # profiles are rounded to four digits
    std = scaler.std.toArray().tolist()
    gaps = [
        F.struct(
            sum(((F.col(c) - F.lit(float(center[c]))) / F.lit(s)) ** 2 for c, s in zip(LINE_FEATURES, std)).alias("gap"),
            F.lit(center["prediction"]).alias("label"),
        )
        for center in result.centers.collect()  # k rows
    ]
    nearest = F.array_min(F.array(*gaps))
    own = F.filter(F.array(*gaps), lambda g: g["label"] == F.col("prediction"))[0]["gap"]
    wrong = result.labelled.where(own > nearest["gap"] * (1 + 1e-9) + 1e-9).agg(F.count("*").alias("misplaced"))
    return profiles.agg(F.sum("n").alias("rows"), *averages).join(wrong)


# Whole jobs


def train_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _train_blobs(spark, sf_dir).labelled


def training_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = _train_blobs(spark, sf_dir).metrics
    path = staging_path(spark, "metrics")
    write_document(metrics, path)
    return read_json_rows(spark, path, metrics.schema).select(
        "best_k", _rounded(F.col("best_score"), 6, "best_score"), "metric_name", "rows_total", "rows_working",
        "features_count", F.concat_ws(",", "features").alias("features"),
    )


def model_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = staging_path(spark, "bundle")
    save_bundle(spark, _train_blobs(spark, sf_dir).bundle, root)
    return load_bundle(spark, root).info(spark).select(
        "model_type", "best_k", _rounded(F.col("best_score"), 6, "best_score"), "metric_name",
        F.concat_ws(",", "feature_cols").alias("feature_cols"),
        F.concat_ws(",", "imputed_cols").alias("imputed_cols"),
        F.concat_ws(",", "product_cols").alias("product_cols"),
    )


def train_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = staging_path(spark, "bundle")
    save_bundle(spark, _train_blobs(spark, sf_dir).bundle, root)
    return predict(_blobs(spark, sf_dir), load_bundle(spark, root))


def predict_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels for a table with every row twice, without one feature and without names: gaps take the medians."""
    bundle = _train_blobs(spark, sf_dir).bundle
    blobs = _blobs(spark, sf_dir).select("x", F.lit("?").alias("other"))
    return predict(blobs.unionByName(blobs), bundle).select("product_name", "x", "y", (F.col("prediction") >= 0).alias("labelled"))


def predict_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with a key that is a feature as well: it comes once, as it is in the table."""
    group = F.col("o_orderkey") % 3
    keyed = _read(spark, sf_dir, "orders").select((group * 1000 + F.col("o_custkey") % 10).alias("key"), (group * -500).alias("y"))
    bundle = train(keyed, training=Training(k_min=3, k_max=3)).bundle
    return predict(keyed, bundle, dedup=False, keep=["key"])


def feature_called_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of a table whose features are called like columns of the result."""
    group = F.col("o_orderkey") % 3
    orders = _read(spark, sf_dir, "orders").select(
        (group * 1000 + F.col("o_custkey") % 10).alias("n"), (group * -500 + F.col("o_orderkey") % 1000 / 1000).alias("prediction")
    )
    return train(orders, training=Training(k_min=3, k_max=3)).profiles


def _published(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The result table after two runs of which the later one has the smaller id."""
    result, root = _train_blobs(spark, sf_dir), staging_path(spark, "results")
    info = result.bundle.info(spark, "bundles/blobs")
    publish_results(spark, root, result.profiles.limit(0), result.centers.limit(0), result.metrics.limit(0), info.limit(0), "v2")
    publish_results(spark, root, result.profiles, result.centers, result.metrics, info, "v1")
    return read_published(spark, root, table)


def published_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(spark, sf_dir, "cluster_profiles").drop("run_id")


def published_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    centers = _published(spark, sf_dir, "cluster_centers")
    return centers.select("run_id", "prediction", *[_rounded(named(c), 6, c) for c in ("x", "y")])


def published_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(spark, sf_dir, "training_metrics").select(
        "run_id", "best_k", _rounded(F.col("best_score"), 6, "best_score"), "metric_name", "rows_total", "rows_working",
        "features_count", F.concat_ws(",", "features").alias("features"),
    )


def published_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(spark, sf_dir, "model_info").select(
        "run_id", "model_type", "best_k", F.regexp_extract("input_path", r"[^/]+$", 0).alias("input_file"),
        F.concat_ws(",", "feature_cols").alias("feature_cols"), F.concat_ws(",", "label_order").rlike("^[012],[012],[012]$").alias("ordered"),
        F.concat_ws(",", "artifacts.kmeans_model", "artifacts.imputer_model", "artifacts.scaler_model").alias("artifacts"),
    )


def configured_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train and predict from a configuration with paths only; what the written files hold."""
    root = staging_path(spark, "configured")
    _blobs(spark, sf_dir).write.parquet(f"{root}/input")
    outputs = {f: f"{root}/{f}" for f in DataPaths.__dataclass_fields__ if f != "input_path"}
    config = Config(DataPaths(input_path=f"{root}/input", **outputs), training=Training(k_max=3))
    run_training(spark, config)
    run_prediction(spark, config)
    csv = spark.read.option("header", True)
    labelled = csv.csv(outputs["predictions_csv_path"]).groupBy("prediction").agg(F.count("*").alias("labelled"))
    trained = csv.csv(outputs["clusters_csv_path"]).groupBy("prediction").agg(F.count("*").alias("trained"))
    profiles = csv.csv(outputs["profiles_csv_path"]).select("prediction", F.col("n").cast("long").alias("n"))
    centers = csv.csv(outputs["centers_csv_path"])
    files = csv.csv(outputs["profiles_csv_path"]).select(F.input_file_name().alias("file"))
    single = files.agg(F.count_distinct("file").alias("files"))
    rows = profiles.join(labelled, "prediction").join(trained, "prediction").join(centers.select("prediction", _rounded(F.col("x").cast("double"), 4, "x")), "prediction")
    return rows.join(single).withColumn("prediction", F.col("prediction").cast("int"))


def guard_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each guard says of a table it cannot take."""
    events, nation = _events_gaps(spark, sf_dir), _read(spark, sf_dir, "nation")
    tables = {
        "no_numbers": nation.select("n_name"),
        "no_rows": events.where("false"),
        "no_filled": events.select(F.when(F.col("event_id") % 2 == 0, F.col("event_id")).alias("half")),
        "no_varying": events.select("flat"),
        "few_rows": events.agg(F.max("event_id").alias("m")).select(F.explode(F.array(F.col("m"), F.lit(0).cast("long"))).alias("m")),
    }
    said = []
    for name, table in tables.items():
        try:
            train(table)
        except ValueError as error:
            said.append((name, str(error)))
    return spark.createDataFrame(said, "guard string, message string")


def job_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job groups of a search, one per k, and whether each ran jobs."""
    _, prepared = _prepared_blobs(spark, sf_dir)
    scores = cluster.sweep(prepared, 2, 4).scores
    tracker = spark.sparkContext.statusTracker()
    rows = [(f"kmeans-k-{k}", len(tracker.getJobIdsForGroup(f"kmeans-k-{k}")) > 0) for k, _ in scores]
    return spark.createDataFrame(rows, "job_group string, ran boolean")


# Files and text


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, path = _read(spark, sf_dir, "customer"), staging_path(spark, "csv")
    write_csv(customers, path)
    return spark.read.schema(customers.schema).option("header", True).csv(path)


def json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts, path = _read(spark, sf_dir, "part"), staging_path(spark, "json")
    write_json_rows(parts, path)
    return read_json_rows(spark, path, parts.schema)


def json_rows_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as JSON lines of which some are cut off and some hold a text for a number: good rows typed, bad lines as they are."""
    parts, path = _read(spark, sf_dir, "part"), staging_path(spark, "json")
    key = F.col("p_partkey").cast("string")
    torn = F.concat(F.lit('{"p_partkey":'), key, F.lit(',"p_name":"'), "p_name")
    text = F.concat(F.lit('{"p_partkey":'), key, F.lit(',"p_size":"large","p_name":"'), "p_name", F.lit('"}'))
    line = F.when(F.col("p_partkey") % 7 == 0, torn).when(F.col("p_partkey") % 11 == 0, text).when(F.col("p_partkey") % 13 == 0, " ")
    parts.select(F.coalesce(line, F.to_json(F.struct("*"))).alias("value")).write.text(path)
    good, bad = read_json_quarantine(spark, path, parts.schema)
    return good.unionByName(bad.select(F.col("value").alias("bad_line")), allowMissingColumns=True)


def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(_read(spark, sf_dir, "documents"), "text")


def word_counts_from_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "lines")
    _read(spark, sf_dir, "documents").select("text").write.text(path)
    return word_count(read_lines(spark, path))


def entry(spark: SparkSession) -> DataFrame:
    """Segments of the line items: profile per cluster of the best clustering."""
    return _line_segments(spark, ENTRY_DIR).profiles


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = [
        column_fill_stats, feature_selection, cast_features, flatten_names_array, flatten_names_struct,
        flatten_names_scalar, align_schema, json_safe_rows, dedup_rows, sample_bernoulli, sample_repeatable,
        sample_distinct, prepare_training_rows, prepare_training_capped, default_train_rows, median_values, median_skewed, mean_values, mode_values,
        impute_rows, standardise_rows, cluster_profile, silhouette_by_label, silhouette_cosine, silhouettes, kmeans_labels,
        kmeans_sweep, sweep_scores, cluster_centers, lineitem_segments, train_labels, training_metrics, model_info,
        train_predict, predict_gaps, predict_keyed, feature_called_n, published_profiles, published_centers,
        published_metrics, published_info, configured_run, guard_messages, job_groups, csv_round_trip, json_rows, json_rows_quarantine, word_counts, word_counts_from_lines,
    ]
    named = {query.__name__: owned(query) for query in registered}
    return named | llm_queries.queries() if llm_queries else named


# SQL counterparts

_GAPS = """gaps as (
    select event_id, user_id,
        case when event_id % 20 <> 0 then value end as value,
        case when event_id % 5 <> 0 then value end as sparse,
        1.0::double as flat
    from events)"""

_FLAWED = f"""{_GAPS}, flawed as (
    select *,
        case when event_id = 1 then 'nan'::double else value end as with_nan,
        case when event_id = 1 then 'inf'::double else value end as with_inf
    from gaps)"""

_BLOBS = """blobs as (
    select o_orderkey::varchar as product_name,
        (o_orderkey % 3) * 1000 + o_custkey % 10 as x,
        (o_orderkey % 3) * -500 + o_custkey % 7 as y,
        (o_orderkey % 3)::integer as prediction
    from orders)"""

_UNEVEN_BLOBS = """blobs as (
    select (case when o_orderkey % 3 = 2 then 9000 else o_orderkey % 3 * 1000 end) + o_custkey % 10 as x,
        o_orderkey % 3 * -500 + o_custkey % 7 as y,
        {label}::integer as prediction
    from orders)"""

_BLOB_POINTS = """points as (
    select prediction, [(x - avg(x) over ()) / stddev_samp(x) over (),
                        (y - avg(y) over ()) / stddev_samp(y) over ()] as v
    from blobs)"""

_BANDED = """banded as (
    select l_quantity, l_extendedprice, l_discount, l_tax,
        (case when l_quantity < 17 then 0 when l_quantity < 34 then 1 else 2 end)::integer as prediction
    from lineitem)"""

_BAND_VECTORS = "select prediction, [l_quantity, l_extendedprice, l_discount, l_tax] as v from banded"


def _silhouette_sql(points: str, dims: int, cosine: bool = False) -> str:
    """CTEs up to ``row_scores(prediction, score)`` and ``score(score)``: the closed form over a relation (prediction, v)."""
    unit = "list_transform(v, lambda e: e / sqrt(list_inner_product(v, v)))" if cosine else "v"
    sums = ", ".join(f"sum(v[{i + 1}])" for i in range(dims))
    if cosine:
        mean_distance = "1 - list_inner_product(p.v, c.total) / c.n"
    else:
        mean_distance = "p.sq + c.sq / c.n - 2 * list_inner_product(p.v, c.total) / c.n"
    return f"""
    vectors as (select row_number() over () as id, prediction, {unit} as v, list_inner_product(v, v) as sq from {points}),
    sums as (select prediction, count(*) as n, sum(sq) as sq, [{sums}] as total from vectors group by prediction),
    far as (
        select p.id, p.prediction, p.prediction = c.prediction as own, c.n, {mean_distance} as d
        from vectors p, sums c),
    sides as (
        select id, any_value(prediction) as prediction,
            max(case when own then n end) as n,
            max(case when own then d * n / nullif(n - 1, 0) end) as a,
            min(case when not own then d end) as b
        from far group by id),
    row_scores as (
        select prediction, case when n = 1 then 0 when a < b then 1 - a / b when a > b then b / a - 1 else 0 end as score from sides),
    score as (select avg(score) as score from row_scores)"""


def oracle_sql() -> dict[str, str]:
    stats = "union all".join(
        f"""
        select '{c}' as column, count(*) as rows, count({c}) as filled,
            round(count({c}) / count(*), 6) as fill_ratio, round(stddev_samp({c}), 4) as stddev
        from gaps """
        for c in ("event_id", "user_id", "value", "sparse", "flat")
    )
    choice = "union all".join(
        f"""
        select '{c}' as column, count({c}) as filled from flawed
        having count({c}) / count(*) >= 0.9 and count(*) filter (not isfinite({c}::double)) = 0
            and stddev_samp({c}) filter (isfinite({c}::double)) > 0 """
        for c in ("event_id", "user_id", "value", "sparse", "flat", "with_nan", "with_inf")
    )
    modes = ", ".join(
        f"(select {c} from lineitem group by {c} order by count(*) desc, {c} limit 1) as {c}" for c in LINE_FEATURES
    )
    iso = "strftime(ts, '%Y-%m-%dT%H:%M:%S') || case when microsecond(ts) % 1000000 <> 0 then strftime(ts, '.%f') else '' end"
    safe = "case when event_id % 10 > 2 then value end"
    blob_score = _silhouette_sql("points", 2)
    word_sql = """
        select word, count(*) as count
        from (select unnest(string_split_regex(text, '\\s+')) as word from documents)
        where word <> '' group by word"""
    profile = ", ".join(f"round(avg({c}), 4) as {c}" for c in LINE_FEATURES)
    statements = {
        "column_fill_stats": f"with {_GAPS} {stats}",
        "feature_selection": f"with {_FLAWED} {choice}",
        "cast_features": """
            select p_name as product_name, p_partkey::double as p_partkey, p_size::double as p_size, p_retailprice
            from part""",
        "flatten_names_array": """
            select doc_id,
                case when doc_id % 7 = 0 then ''
                    else concat_ws(' | ', lang, case when doc_id % 3 <> 0 then source end) end as product_name_langs,
                case when doc_id % 7 = 0 then '' else concat_ws(' | ', text, source) end as product_name_texts
            from documents""",
        "flatten_names_struct": """
            select doc_id,
                case when doc_id % 7 <> 0 then lang end as product_name_lang,
                case when doc_id % 7 <> 0 then source end as product_name_source,
                case when doc_id % 7 <> 0 then n_chars::varchar end as product_name_n_chars
            from documents""",
        "flatten_names_scalar": "select l_orderkey::varchar as product_name from lineitem",
        "align_schema": """
            select o_orderkey, o_orderstatus as product_name_lang, null::varchar as product_name_text,
                o_totalprice, null::double as lost_feature, o_custkey::double as o_custkey
            from orders""",
        "json_safe_rows": f"""
            select event_id, {iso} as ts, {safe} as value, value::decimal(18,2)::double as amount,
                {safe} as in_struct, {safe} as in_array, {iso} as time_in_array, {safe} as in_map
            from events""",
        "dedup_rows": "select distinct l_quantity, l_discount, l_tax from lineitem",
        "sample_repeatable": """
            select * from orders order by md5(concat(o_orderkey, '#42')), o_orderkey limit 1000""",
        "sample_bernoulli": """
            select * exclude (h) from (select *, md5(concat_ws('#', l_orderkey, l_partkey, l_suppkey, l_linenumber, 42)) as h from lineitem)
            where substr(h, 1, 15) < format('{:015x}', floor(2000::double / (select count(*) from lineitem) * 1152921504606846976::double)::bigint)
            order by h limit 2000""",
        "sample_distinct": """
            select distinct on (l_partkey, l_suppkey) l_partkey, l_suppkey from lineitem
            qualify dense_rank() over (order by md5(concat_ws('#', l_partkey, l_suppkey, 42)), l_partkey, l_suppkey) <= 1000""",
        "prepare_training_capped": """
            select l_orderkey::double as l_orderkey, l_partkey::double as l_partkey, l_suppkey::double as l_suppkey,
                l_linenumber::double as l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
            from (select distinct l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
                from lineitem)
            order by md5(concat_ws('#', l_orderkey::double, l_partkey::double, l_suppkey::double, l_linenumber::double, 42))
            limit 2000""",
        "default_train_rows": f"""
            select (select count(*) from lineitem) as rows_total, count(*) as rows_working, count(*) as rows_in_profiles
            from (select distinct {", ".join(LINE_FEATURES)} from lineitem)""",
        "lineitem_segments": f"""
            select count(*) as rows, {", ".join(f"round(avg({c}), 2) as {c}" for c in LINE_FEATURES)}, 0::bigint as misplaced
            from (select distinct {", ".join(LINE_FEATURES)} from lineitem)""",
        "median_skewed": """
            select quantile_disc(power(2.0::double, l_orderkey % 2000 - 1000), 0.5) as wide,
                quantile_disc(power(2.0::double, l_partkey % 600 - 300) * case when l_suppkey % 2 = 0 then -1 else 1 end, 0.5) as signed,
                quantile_disc(case when l_linenumber < 5 then 1.0::double else l_extendedprice end, 0.5) as heavy
            from lineitem""",
        "prepare_training_rows": f"""
            with {_FLAWED}
            select distinct event_id::double as event_id, user_id::double as user_id, value from flawed""",
        "median_values": "select "
        + ", ".join(f"quantile_disc({c}, 0.5) as {c}" for c in LINE_FEATURES)
        + " from lineitem",
        "mean_values": f"select {profile} from lineitem",
        "mode_values": f"select {modes}",
        "impute_rows": f"""
            with {_GAPS}, middle as (
                select quantile_disc(value, 0.5) as value, quantile_disc(sparse, 0.5) as sparse from gaps)
            select event_id, g.value, g.sparse,
                coalesce(g.value, m.value) as value_imp, coalesce(g.sparse, m.sparse) as sparse_imp
            from gaps g, middle m""",
        "standardise_rows": """
            select p_partkey,
                round((p_size - avg(p_size) over ()) / stddev_samp(p_size) over (), 6) + 0.0 as p_size_scaled,
                round((p_retailprice - avg(p_retailprice) over ()) / stddev_samp(p_retailprice) over (), 6) + 0.0
                    as p_retailprice_scaled
            from part""",
        "cluster_profile": f"""
            with {_BANDED} select prediction, count(*) as n, {profile} from banded group by prediction""",
        "silhouette_by_label": f"""
            with {_BANDED}, {_silhouette_sql(f"({_BAND_VECTORS})", 4)} select round(score, 6) as score from score""",
        "silhouette_cosine": f"""
            with {_BANDED}, {_silhouette_sql(f"({_BAND_VECTORS})", 4, cosine=True)}
            select round(score, 6) as score from score""",
        "silhouettes": " union all ".join(
            f"""
            select * from (
                with points as (
                    select (case when o_orderkey = 0 then 3 when o_totalprice < 100000 then 0 when o_totalprice < 250000 then 1 else 2 end)::integer
                        as prediction, [o_totalprice / 1000, o_custkey::double] as v from orders),
                {_silhouette_sql("points", 2, cosine)}
                select '{distance}' as distance, prediction, count(*) as n, round(avg(score), 6) + 0.0 as score from row_scores group by prediction)"""
            for distance, cosine in (("squaredEuclidean", False), ("cosine", True))
        ),
        "kmeans_labels": f"with {_BLOBS} select product_name, x::double as x, y::double as y, prediction from blobs",
        "kmeans_sweep": f"""
            with {_BLOBS}, {_BLOB_POINTS}, {blob_score} select 3::integer as k, round(score, 6) as score from score""",
        "sweep_scores": " union all ".join(
            f"""
            select * from (
                with {_UNEVEN_BLOBS.format(label=label)}, {_BLOB_POINTS}, {blob_score}
                select {k}::integer as k, round(score, 6) as score from score)"""
            for k, label in ((2, "(o_orderkey % 3) // 2"), (3, "(o_orderkey % 3)"))
        ),
        "cluster_centers": f"""
            with {_BLOBS}
            select prediction, round(avg(x), 6) as x, round(avg(y), 6) as y from blobs group by prediction""",
        "train_labels": f"with {_BLOBS} select product_name, x::double as x, y::double as y, prediction from blobs",
        "training_metrics": f"""
            with {_BLOBS}, {_BLOB_POINTS}, {blob_score}
            select 3::integer as best_k, round(score, 6) as best_score, 'silhouette' as metric_name,
                (select count(*) from blobs) as rows_total, (select count(*) from blobs) as rows_working,
                2::integer as features_count, 'x,y' as features
            from score""",
        "model_info": f"""
            with {_BLOBS}, {_BLOB_POINTS}, {blob_score}
            select 'pyspark.ml.clustering.KMeansModel' as model_type, 3::integer as best_k,
                round(score, 6) as best_score, 'silhouette' as metric_name, 'x,y' as feature_cols,
                'x_imp,y_imp' as imputed_cols, 'product_name' as product_cols
            from score""",
        "train_predict": f"with {_BLOBS} select product_name, x::double as x, y::double as y, prediction from blobs",
        "published_profiles": f"""
            with {_BLOBS}
            select prediction, count(*) as n, round(avg(x), 4) as x, round(avg(y), 4) as y
            from blobs group by prediction""",
        "predict_gaps": f"""
            with {_BLOBS} select distinct null::varchar as product_name, x::double as x, null::double as y, true as labelled from blobs""",
        "predict_keyed": """
            select (o_orderkey % 3) * 1000 + o_custkey % 10 as key, ((o_orderkey % 3) * -500)::double as y,
                (o_orderkey % 3)::integer as prediction
            from orders""",
        "feature_called_n": """
            select prediction, count(*) as n, round(avg(a), 4) as n_, round(avg(b), 4) as prediction_
            from (select distinct (o_orderkey % 3)::integer as prediction, (o_orderkey % 3) * 1000 + o_custkey % 10 as a,
                    (o_orderkey % 3) * -500 + o_orderkey % 1000 / 1000 as b from orders)
            group by prediction""",
        "published_centers": f"""
            with {_BLOBS} select 'v1' as run_id, prediction, round(avg(x), 6) as x, round(avg(y), 6) as y from blobs group by prediction""",
        "published_metrics": f"""
            with {_BLOBS}, {_BLOB_POINTS}, {blob_score}
            select 'v1' as run_id, 3::integer as best_k, round(score, 6) as best_score, 'silhouette' as metric_name,
                (select count(*) from blobs) as rows_total, (select count(*) from blobs) as rows_working,
                2::integer as features_count, 'x,y' as features
            from score""",
        "published_info": """
            select 'v1' as run_id, 'pyspark.ml.clustering.KMeansModel' as model_type, 3::integer as best_k, 'orders.parquet' as input_file,
                'x,y' as feature_cols, true as ordered,
                'bundles/blobs/kmeans_model,bundles/blobs/imputer_model,bundles/blobs/scaler_model' as artifacts""",
        "configured_run": f"""
            with {_BLOBS}
            select prediction, count(*) as n, count(*) as labelled, count(*) as trained, round(avg(x), 4) as x, 1::bigint as files
            from blobs group by prediction""",
        "guard_messages": """
            select * from (values ('no_numbers', 'no numeric columns in the input table'), ('no_rows', 'the input table is empty'),
                ('no_filled', 'no numeric column is filled in at least 0.9 of the rows'),
                ('no_varying', 'no numeric feature column is left: all of them are constant or hold non-finite values'),
                ('few_rows', 'too few rows to form 2 clusters')) as t(guard, message)""",
        "job_groups": "select 'kmeans-k-' || k as job_group, true as ran from generate_series(2, 4) as t(k)",
        "csv_round_trip": "select * from customer",
        "json_rows": "select * from part",
        "json_rows_quarantine": """
            select *, null::varchar as bad_line from part where p_partkey % 7 <> 0 and p_partkey % 11 <> 0 and p_partkey % 13 <> 0
            union all by name
            select concat('{"p_partkey":', p_partkey, ',"p_name":"', p_name) as bad_line from part where p_partkey % 7 = 0
            union all by name
            select concat('{"p_partkey":', p_partkey, ',"p_size":"large","p_name":"', p_name, '"}') as bad_line
            from part where p_partkey % 7 <> 0 and p_partkey % 11 = 0""",
        "word_counts": word_sql,
        "word_counts_from_lines": word_sql,
    }
    return statements | llm_queries.oracle_sql() if llm_queries else statements
