"""The model bundle: imputer, scaler and K-means model with a record that describes them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import ImputerModel, StandardScalerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmill.operators import commits
from segmill.operators.prepare import imputed_names

# Names inside the bundle, the recorded model type, and the record's fields.
KMEANS_DIR = "kmeans_model"
IMPUTER_DIR = "imputer_model"
SCALER_DIR = "scaler_model"
INFO_DOCUMENT = "model_info.json"
VERSIONS = "versions"
LOG = "versions/log"
LOG_SCHEMA = "version string"
MODEL_TYPE = "pyspark.ml.clustering.KMeansModel"
INFO_SCHEMA = (
    "model_type string, best_k int, best_score double, metric_name string, "
    "feature_cols array<string>, imputed_cols array<string>, product_cols array<string>, "
    "input_path string, label_order array<int>, "
    "artifacts struct<kmeans_model:string,imputer_model:string,scaler_model:string>"
)


@dataclass(frozen=True)
class Bundle:
    """Everything needed to label new rows.

    ``label_order[i]`` is the raw cluster index that carries the label ``i``; an
    empty list leaves the raw indexes as they are.
    """

    kmeans: KMeansModel
    imputer: ImputerModel
    scaler: StandardScalerModel
    feature_cols: list[str]
    text_cols: list[str]
    best_k: int
    best_score: float
    metric_name: str = "silhouette"
    input_path: str | None = None
    label_order: list[int] = field(default_factory=list)

    def info(self, spark: SparkSession, root: str | None = None) -> DataFrame:
        """The record as a one-row table; ``root`` is where the bundle is, or will be, saved."""
        places = [f"{root.rstrip('/')}/{d}" for d in (KMEANS_DIR, IMPUTER_DIR, SCALER_DIR)] if root else None
        row = (
            MODEL_TYPE, self.best_k, self.best_score, self.metric_name,
            self.feature_cols, imputed_names(self.feature_cols), self.text_cols,
            self.input_path, self.label_order, tuple(places) if places else None,
        )
        return spark.createDataFrame([row], INFO_SCHEMA)


def bundle_folder(spark: SparkSession, root: str) -> str:
    """Where the bundle saved last under ``root`` is; ``root`` itself if it holds a bundle without versions."""
    root = root.rstrip("/")
    version = commits.entries(spark, f"{root}/{LOG}", LOG_SCHEMA).agg(F.max_by("version", "entry")).first()[0]
    return root if version is None else f"{root}/{VERSIONS}/{version}"


def load_bundle(spark: SparkSession, root: str) -> Bundle:
    """Load the bundle saved last under ``root``; a missing one is an error and nothing is created."""
    root = bundle_folder(spark, root)
    info = spark.read.schema(INFO_SCHEMA).option("multiLine", True).json(f"{root}/{INFO_DOCUMENT}").first()
    if info is None:
        raise ValueError(f"no model record in {root}/{INFO_DOCUMENT}")
    return Bundle(
        kmeans=KMeansModel.load(f"{root}/{KMEANS_DIR}"),
        imputer=ImputerModel.load(f"{root}/{IMPUTER_DIR}"),
        scaler=StandardScalerModel.load(f"{root}/{SCALER_DIR}"),
        feature_cols=list(info.feature_cols),
        text_cols=list(info.product_cols or []),
        best_k=info.best_k,
        best_score=info.best_score,
        metric_name=info.metric_name,
        input_path=info.input_path,
        label_order=list(info.label_order or []),
    )
