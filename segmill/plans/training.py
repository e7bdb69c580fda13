"""Training: from a raw table to labelled rows, descriptions and a model bundle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from segmill.functions.columns import named
from segmill.functions.names import name_columns
from segmill.operators import cluster, summarise
from segmill.operators.features import choose_features
from segmill.operators.prepare import Preparation, fit_preparation
from segmill.operators.project import NAME_COLUMN, plain_results, training_columns
from segmill.operators.sampling import cap_rows, distinct_sample
from segmill.operators.staging import Scope, drop_staged, stage
from segmill.plans.config import Config, Preprocessing, Training
from segmill.sinks import publish_results, save_bundle, write_csv, write_document
from segmill.sources import Bundle, read_table

#: Rows per partition of the working table, at every size.
ROWS_PER_PARTITION = 50_000


@dataclass(frozen=True)
class PreparedTable:
    """The distinct rows to train on, with what was learned on the way."""

    df: DataFrame
    feature_cols: list[str]
    text_cols: list[str]
    rows_total: int
    rows_working: int


def prepare_training(
    raw: DataFrame,
    options: Preprocessing = Preprocessing(),
    seed: int = 42,
    name_column: str = NAME_COLUMN,
) -> PreparedTable:
    """Choose features, flatten names, remove duplicates, cap the number of rows.

    Fill ratios and variances are those of the raw rows. With ``hash`` sampling the
    raw table is read twice, once for the numeric columns only, and no more than the
    rows that can be in the sample are shuffled. ``bernoulli`` needs the number of
    distinct rows, hence removes duplicates from the whole table first. The working table
    is staged, and read in partitions of about ROWS_PER_PARTITION rows whatever its size.
    Features that are called like a result column get a trailing underscore. What else is staged on the way is deleted.
    """
    with Scope() as scope:
        table = _prepared(raw, options, seed, name_column)
        scope.keep(table.df)
    return table


def _prepared(raw: DataFrame, options: Preprocessing, seed: int, name_column: str) -> PreparedTable:
    raw = plain_results(raw)
    features, rows_total = choose_features(raw, options.min_non_null_ratio)
    texts = list(name_columns(raw.schema, name_column))
    table = training_columns(raw, features, name_column)

    target = rows_total if options.target_n is None else min(options.target_n, rows_total)
    if target == rows_total or options.sampling == "hash":
        working, rows_working = distinct_sample(table, target, seed, rows_total, options.sample_keys)
    else:
        distinct = stage(table.dropDuplicates(), "distinct")
        working = cap_rows(distinct, target, seed, options.sampling, options.sample_keys)
        rows_working = working.count()
    partitions = rows_working // ROWS_PER_PARTITION + 1
    if target < rows_total:
        working = stage(working.repartition(partitions), "working")
    else:  # a staged table already: fewer tasks read it, nothing is shuffled
        working = working.coalesce(partitions)
    return PreparedTable(working, features, texts, rows_total, rows_working)


@dataclass(frozen=True)
class TrainResult:
    """What a training run found. ``labelled`` is a plan over the staged working table."""

    bundle: Bundle
    labelled: DataFrame
    profiles: DataFrame
    centers: DataFrame
    metrics: DataFrame
    scores: DataFrame
    prepared: PreparedTable

    def release(self) -> None:
        """Delete the staged working table; ``labelled`` cannot be computed any more."""
        drop_staged(self.prepared.df)

    @property
    def best_k(self) -> int:
        return self.bundle.best_k

    @property
    def best_score(self) -> float:
        return self.bundle.best_score


def train(
    raw: DataFrame,
    preprocessing: Preprocessing = Preprocessing(),
    training: Training = Training(),
    input_path: str | None = None,
    name_column: str = NAME_COLUMN,
) -> TrainResult:
    """Prepare ``raw``, search for the best number of clusters and describe the outcome.

    Of what is staged on the way only the working table is left, and after a failure nothing.
    """
    with Scope() as scope:
        result = _trained(raw, preprocessing, training, input_path, name_column)
        scope.keep(result.prepared.df)
    return result


def _trained(
    raw: DataFrame, preprocessing: Preprocessing, training: Training, input_path: str | None, name_column: str
) -> TrainResult:
    spark = raw.sparkSession
    table = prepare_training(raw, preprocessing, training.seed, name_column)
    preparation = fit_preparation(
        table.df, table.feature_cols, preprocessing.imputer_strategy, preprocessing.median_error
    )
    prepared = preparation.apply(table.df)
    best = cluster.sweep(
        prepared,
        training.k_min,
        training.k_max,
        training.seed,
        training.distance_measure,
        training.metric_name,
        training.fit_distance,
        table.rows_working,
        training.parallelism,
    )
    return _describe(spark, table, preparation, prepared, best, training, input_path)


def _describe(
    spark: SparkSession,
    table: PreparedTable,
    preparation: Preparation,
    prepared: DataFrame,
    best: cluster.Sweep,
    training: Training,
    input_path: str | None,
) -> TrainResult:
    scaler, features = preparation.scaler, table.feature_cols
    order = cluster.canonical_order(best.model, scaler) if training.canonical_labels else []
    labelled = cluster.assign(prepared, best.model, order).select(
        *[named(c) for c in table.text_cols + features], cluster.LABEL
    )
    profiles = summarise.profiles(labelled, features)
    # One row per cluster: kept, so that writing and publishing do not label the table again.
    profiles = spark.createDataFrame(profiles.collect(), profiles.schema).orderBy(cluster.LABEL)
    return TrainResult(
        bundle=Bundle(
            best.model, preparation.imputer, scaler, features, table.text_cols,
            best.best_k, best.best_score, training.metric_name, input_path, order,
        ),
        labelled=labelled,
        profiles=profiles,
        centers=summarise.centers(spark, best.model, scaler, features, order),
        metrics=summarise.metrics(
            spark, best.best_k, best.best_score, table.rows_total, table.rows_working, features, training.metric_name
        ),
        scores=best.table(spark),
        prepared=table,
    )


def run_training(spark: SparkSession, config: Config) -> TrainResult:
    """Train on the configured table and write every output that has a path."""
    paths = config.data
    if paths.input_path is None:
        raise ValueError("no input_path configured")
    result = train(read_table(spark, paths.input_path), config.preprocessing, config.training, paths.input_path)
    if paths.clusters_csv_path:
        write_csv(result.labelled, paths.clusters_csv_path)
    if paths.profiles_csv_path:
        write_csv(result.profiles, paths.profiles_csv_path, single=True)
    if paths.centers_csv_path:
        write_csv(result.centers, paths.centers_csv_path, single=True)
    if paths.metrics_json_path:
        write_document(result.metrics, paths.metrics_json_path)
    folder = save_bundle(spark, result.bundle, paths.model_root) if paths.model_root else None
    if paths.results_root:
        info = result.bundle.info(spark, folder)
        publish_results(spark, paths.results_root, result.profiles, result.centers, result.metrics, info)
    return result
