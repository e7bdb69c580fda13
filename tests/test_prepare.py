import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from segmill.operators import quantiles
from segmill.operators.prepare import fit_imputer, fit_preparation
from segmill.operators.quantiles import exact_quantiles

NAN, INF = float("nan"), float("inf")


def lower_quantile(values, p):
    values = sorted(v for v in values if v is not None and not math.isnan(v))
    return values[max(1, math.ceil(p * len(values))) - 1] if values else None


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(*[st.one_of(st.none(), st.floats(width=64), st.sampled_from([0.0, 1.0, 5e-324, 1e308, -1e308]))] * 2),
        min_size=1,
        max_size=60,
    ),
    st.sampled_from([0.5, 0.01, 0.9]),
    st.sampled_from([1, 10_000]),
)
def test_exact_quantiles(spark, rows, p, settle):
    quantiles._SETTLE_ROWS, before = settle, quantiles._SETTLE_ROWS
    try:
        df = spark.createDataFrame(rows, "a double, b double").coalesce(2)
        found = exact_quantiles(df, ["a", "b"], p)
    finally:
        quantiles._SETTLE_ROWS = before
    assert found == {c: lower_quantile([r[i] for r in rows], p) for i, c in enumerate("ab")}


@pytest.mark.parametrize(("settle", "sketch"), [(1, 2048), (10_000, 2048), (1, 64), (5, 8), (5, 200)])
def test_exact_quantiles_of_many_rows(spark, monkeypatch, settle, sketch):
    monkeypatch.setattr(quantiles, "_SETTLE_ROWS", settle)
    monkeypatch.setattr(quantiles, "_SKETCH", sketch)
    rng = np.random.default_rng(0)
    columns = [
        rng.lognormal(0, 8, 30_000),
        np.where(rng.random(30_000) < 0.4, 7.0, rng.normal(7, 1e-9, 30_000)),
        np.where(rng.random(30_000) < 0.5, -1e300, 1e300),
        np.arange(30_000.0),
    ]
    df = spark.createDataFrame(list(zip(*[c.tolist() for c in columns])), "a double, b double, c double, `d.d` double")
    for p in (0.5, 0.123):
        found = exact_quantiles(df, df.columns, p)
        assert list(found.values()) == [lower_quantile(c.tolist(), p) for c in columns]


def test_imputer_strategies(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (4.0,), (4.0,), (11.0,), (None,), (NAN,)], "a double")
    for strategy, error, value in (("median", 0, 2.0), ("median", 0.001, 2.0), ("mean", 0.001, 4.0), ("mode", 0.001, 2.0)):
        model = fit_imputer(df, ["a"], strategy, error)
        assert [r.a_imp for r in model.transform(df).collect()] == [1.0, 2.0, 2.0, 4.0, 4.0, 11.0, value, value]


@pytest.mark.parametrize("error", [0, 0.001])
def test_features_without_values_are_named(spark, error):
    df = spark.createDataFrame([(1.0, None, NAN)], "a double, b double, `c.d` double")
    with pytest.raises(ValueError, match="without any value: b, c.d"):
        fit_imputer(df, ["a", "b", "c.d"], relative_error=error)


def test_chain_fills_assembles_and_standardises(spark):
    df = spark.createDataFrame(
        [(1.0, 5.0, 1.0), (None, 5.0, 2.0), (3.0, 5.0, 6.0)], "a double, flat double, `x.y` double"
    )
    chain = fit_preparation(df, ["a", "flat", "x.y"])
    out = chain.apply(df)
    assert [r.a for r in out.collect()] == [1.0, None, 3.0]
    assert [r.a_imp for r in out.collect()] == [1.0, 1.0, 3.0]
    scaled = np.array([r.v for r in out.select(vector_to_array("features").alias("v")).collect()])
    raw = np.array([[1, 5, 1], [1, 5, 2], [3, 5, 6]], float)
    std = raw.std(axis=0, ddof=1)
    assert np.allclose(scaled, (raw - raw.mean(axis=0)) / np.where(std == 0, np.inf, std))


def test_plain_names_do_not_collide(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0)], "`a.b` double, a_b double")
    chain = fit_preparation(df, ["a.b", "a_b"])
    assert chain.apply(df).select(vector_to_array("features_raw").alias("v")).first().v == [1.0, 2.0]


@pytest.mark.parametrize("rows", [20_001, 60_000])
def test_passes_do_not_depend_on_the_shape(spark, rows):
    """Values over 600 powers of two: bins of equal width would need a pass for every few of them."""
    rng = np.random.default_rng(2)
    values = [2.0 ** rng.uniform(-300, 300) for _ in range(rows)]
    found, passes = quantiles.search(spark.createDataFrame([(v,) for v in values], "a double"), ["a"], 0.5)
    assert found == {"a": lower_quantile(values, 0.5)} and passes <= 3


def test_passes_over_the_skewed_columns_of_the_contract(spark):
    """The columns of ``median_skewed`` at sf0.1."""
    lines = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet").select(
        F.pow(F.lit(2.0), F.col("l_orderkey") % 2000 - 1000).alias("wide"),
        F.when(F.col("l_linenumber") < 5, 1.0).otherwise(F.col("l_extendedprice")).alias("heavy"),
    )
    found, passes = quantiles.search(lines, lines.columns, 0.5)
    whole = lines.toPandas()
    assert found == {c: lower_quantile(whole[c].tolist(), 0.5) for c in whole} and passes <= 3


@pytest.mark.parametrize("p", [0.0, 0.01, 0.5, 0.999, 1.0])
def test_rounds_of_small_sketches(spark, monkeypatch, p):
    """Ranges that the sketches cut too narrowly are found again by the exact counts."""
    monkeypatch.setattr(quantiles, "_SKETCH", 8)
    monkeypatch.setattr(quantiles, "_SETTLE_ROWS", 50)
    rng = np.random.default_rng(5)
    values = [*rng.normal(size=3000).tolist(), *[0.25] * 1000, float("inf"), float("-inf")]
    found, _ = quantiles.search(spark.createDataFrame([(v,) for v in values], "a double"), ["a"], p)
    assert found == {"a": lower_quantile(values, p)}


def test_a_thousand_columns(spark):
    df = spark.range(50).select(*[(F.col("id") * (i + 1)).alias(f"c{i}") for i in range(1000)])
    assert exact_quantiles(df, df.columns) == {f"c{i}": 24.0 * (i + 1) for i in range(1000)}
