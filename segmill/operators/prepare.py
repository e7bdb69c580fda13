"""Imputation, assembly and standardisation of the features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Imputer, ImputerModel, StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmill.functions.columns import as_double, named
from segmill.operators.quantiles import exact_quantiles

RAW_VECTOR = "features_raw"
VECTOR = "features"


def imputed_names(features: Sequence[str]) -> list[str]:
    """``<feature>_imp``, with underscores after it where that is a feature itself."""
    names: list[str] = []
    for c in features:
        name = f"{c}_imp"
        while name in features or name in names:
            name += "_"
        names.append(name)
    return names


def _plain_names(features: Sequence[str]) -> list[str]:
    """Names that Spark ML can address: it reads a dot in a column name as a field access."""
    plain: list[str] = []
    for c in features:
        name = c.replace(".", "_").replace("`", "_")
        while name != c and (name in features or name in plain):
            name += "_"
        plain.append(name)
    return plain


def with_plain_names(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``df`` with a further column for each feature whose name Spark ML cannot address."""
    return df.withColumns({p: named(c) for c, p in zip(features, _plain_names(features)) if p != c})


def fit_imputer(
    df: DataFrame,
    features: Sequence[str],
    strategy: str = "median",
    relative_error: float = 0.0,
) -> ImputerModel:
    """Learn what replaces null and NaN: the median, mean or mode of each feature.

    The median is an element of the data within ``relative_error`` of the middle rank.
    0, the default, is the exact one, from a few passes over ``df`` that scale with the
    number of tasks; Spark's approximate one takes a single pass but merges a sketch
    per task and column in one place. Equally frequent values give the smallest as mode.
    """
    plain = _plain_names(features)
    imputer = Imputer(inputCols=plain, outputCols=imputed_names(plain), strategy=strategy)
    if relative_error:
        imputer = imputer.setRelativeError(relative_error)
    data = with_plain_names(df, features).select(*[named(c) for c in plain])
    if strategy == "median" and relative_error == 0:
        medians = exact_quantiles(data, plain)
        empty = [c for c, p in zip(features, plain) if medians[p] is None]
        if empty:
            raise ValueError(f"features without any value: {', '.join(empty)}")
        # The median of a one-row table is that row, so this fits exactly these values.
        data = df.sparkSession.createDataFrame(
            [tuple(medians[p] for p in plain)], ", ".join(f"`{p}` double" for p in plain)
        )
    try:
        return imputer.fit(data)
    except Exception as error:
        if "surrogate cannot be computed" in str(error):
            values = [F.count(F.nanvl(as_double(named(p)), F.lit(None))).alias(p) for p in plain]
            counts = data.agg(*values).first()
            empty = [c for c, n in zip(features, counts) if n == 0]
            raise ValueError(f"features without any value: {', '.join(empty)}") from error
        raise


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Gather the imputed features into the vector ``features_raw``."""
    return VectorAssembler(inputCols=imputed_names(_plain_names(features)), outputCol=RAW_VECTOR).transform(df)


def fit_scaler(df: DataFrame) -> StandardScalerModel:
    """Learn mean and sample deviation of ``features_raw``; a constant feature will scale to 0."""
    return StandardScaler(inputCol=RAW_VECTOR, outputCol=VECTOR, withMean=True, withStd=True).fit(df)


@dataclass(frozen=True)
class Preparation:
    """A fitted chain: imputer, assembly, scaler."""

    features: list[str]
    imputer: ImputerModel
    scaler: StandardScalerModel

    def impute(self, df: DataFrame) -> DataFrame:
        """Add ``<feature>_imp`` columns; the features themselves keep their gaps."""
        return self.imputer.transform(with_plain_names(df, self.features))

    def apply(self, df: DataFrame) -> DataFrame:
        """Add the imputed columns, ``features_raw`` and the standardised ``features``."""
        return self.scaler.transform(assemble(self.impute(df), self.features))


def fit_preparation(
    df: DataFrame,
    features: Sequence[str],
    strategy: str = "median",
    relative_error: float = 0.0,
) -> Preparation:
    """Fit the chain on ``df``, which should be a table or staged: it is read several times."""
    imputer = fit_imputer(df, features, strategy, relative_error)
    imputed = imputer.transform(with_plain_names(df, features))
    return Preparation(list(features), imputer, fit_scaler(assemble(imputed, features)))
