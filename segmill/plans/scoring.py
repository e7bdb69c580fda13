"""Labelling of new rows with a model bundle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from segmill.functions.columns import named
from segmill.operators.cluster import LABEL, assign
from segmill.operators.prepare import Preparation
from segmill.operators.project import NAME_COLUMN, align, plain_results
from segmill.plans.config import Config
from segmill.sinks import write_csv
from segmill.sources import Bundle, load_bundle, read_table


def predict(
    raw: DataFrame,
    bundle: Bundle,
    dedup: bool = True,
    keep: Sequence[str] = (),
    on_bad: str = "error",
    name_column: str = NAME_COLUMN,
) -> DataFrame:
    """Text columns, features and label of each distinct row: one lazy plan.

    Its only shuffle is the duplicate removal, and without ``dedup`` there is none.
    ``keep`` names columns of ``raw`` to carry along, such as a key; one that is a
    feature as well appears once, as it is in ``raw``.
    """
    held = {c: f"__keep_{i}" for i, c in enumerate(dict.fromkeys(keep))}
    source = raw.withColumns({name: named(c) for c, name in held.items()})
    rows = align(plain_results(source), bundle.feature_cols, bundle.text_cols, name_column, on_bad, list(held.values()))
    if dedup:
        rows = rows.dropDuplicates()
    chain = Preparation(bundle.feature_cols, bundle.imputer, bundle.scaler)
    labelled = assign(chain.apply(rows), bundle.kmeans, bundle.label_order)
    kept = [named(name).alias(c) for c, name in held.items()]
    return labelled.select(*kept, *[named(c) for c in [*bundle.text_cols, *bundle.feature_cols] if c not in held], LABEL)


def run_prediction(
    spark: SparkSession,
    config: Config,
    model_path: str | None = None,
    input_path: str | None = None,
    output_path: str | None = None,
) -> DataFrame:
    """Label the table at ``input_path`` with the bundle at ``model_path`` and write CSV.

    Arguments left out come from the configuration.
    """
    root = model_path or config.data.model_root
    source = input_path or config.data.input_path
    target = output_path or config.data.predictions_csv_path
    if not (root and source and target):
        raise ValueError("prediction needs a model path, an input path and an output path")
    labelled = predict(read_table(spark, source), load_bundle(spark, root))
    write_csv(labelled, target)
    return labelled
