"""Whole jobs: prepare, train, predict."""

from segmill.plans.config import Config, DataPaths, Preprocessing, Training, load_config
from segmill.plans.scoring import predict, run_prediction
from segmill.plans.training import PreparedTable, TrainResult, prepare_training, run_training, train

__all__ = [
    "Config",
    "DataPaths",
    "Preprocessing",
    "PreparedTable",
    "TrainResult",
    "Training",
    "load_config",
    "predict",
    "prepare_training",
    "run_prediction",
    "run_training",
    "train",
]
