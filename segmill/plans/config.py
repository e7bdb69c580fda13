"""Options of the jobs, with their defaults, and a reader for them."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields

# Section names, option names and defaults below. Sections and options
# not listed (session and service settings) are the caller's business and skipped.


@dataclass(frozen=True)
class DataPaths:
    """Where things are read and written; an output without a path is not written."""

    input_path: str | None = None
    clusters_csv_path: str | None = None
    profiles_csv_path: str | None = None
    centers_csv_path: str | None = None
    metrics_json_path: str | None = None
    predictions_csv_path: str | None = None
    model_root: str | None = None
    results_root: str | None = None


@dataclass(frozen=True)
class Preprocessing:
    min_non_null_ratio: float = 0.9
    target_n: int | None = None
    """Rows to train on at most; None, the default, trains on all."""
    sample_keys: tuple[str, ...] | None = None
    """Columns whose MD5 orders the rows of a ``hash`` sample; by default it is a hash of the whole row."""
    imputer_strategy: str = "median"
    median_error: float = 0.0
    """0 for the exact median, else the relative rank error of an approximate one."""
    sampling: str = "hash"
    """``hash`` (repeatable) or ``bernoulli``, see ``operators.sampling``."""


@dataclass(frozen=True)
class Training:
    k_min: int = 2
    k_max: int = 10
    seed: int = 42
    metric_name: str = "silhouette"
    distance_measure: str = "squaredEuclidean"
    fit_distance: str = "euclidean"
    canonical_labels: bool = True
    parallelism: int = 4
    """Fits run side by side over one cached copy of the vectors, see ``operators.cluster.sweep``."""


@dataclass(frozen=True)
class Config:
    data: DataPaths = field(default_factory=DataPaths)
    preprocessing: Preprocessing = field(default_factory=Preprocessing)
    training: Training = field(default_factory=Training)


def _section(kind: type, values: dict) -> object:
    known = {f.name for f in fields(kind)}
    unknown = sorted(set(values) - known)
    if unknown:
        raise ValueError(f"unknown {kind.__name__} options: {', '.join(unknown)}")
    return kind(**{name: tuple(v) if isinstance(v, list) else v for name, v in values.items()})


def load_config(path: str) -> Config:
    """Read the sections ``data``, ``preprocessing`` and ``training`` of a JSON file on the driver."""
    with open(path, encoding="utf-8") as f:
        sections = json.load(f)
    return Config(
        data=_section(DataPaths, sections.get("data", {})),
        preprocessing=_section(Preprocessing, sections.get("preprocessing", {})),
        training=_section(Training, sections.get("training", {})),
    )
