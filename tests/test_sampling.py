import re

import pytest
from pyspark.sql import functions as F

from segmill.operators import sampling
from segmill.operators.sampling import cap_rows, distinct_sample, row_rank, smallest
from segmill.operators.staging import stage


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def brute_force(df, rank, n):
    return sorted(tuple(r)[:-1] for r in sorted(df.withColumn("r", rank).collect(), key=lambda r: r.r)[:n])


@pytest.fixture(scope="module")
def numbers(spark):
    return stage(spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7 / 2).alias("x")), "numbers")


def test_small_table_is_unchanged(numbers):
    for mode in ("bernoulli", "hash"):
        assert cap_rows(numbers, 5000, mode=mode).count() == 5000


def test_bernoulli_keeps_at_most_n(numbers):
    sampled = cap_rows(numbers, 500, seed=1)
    assert 350 < sampled.count() <= 500
    assert set(rows_of(sampled)) <= set(rows_of(numbers))


@pytest.mark.parametrize("edge", [0, 3, 100_000])
@pytest.mark.parametrize("n", [1, 777, 4999])
def test_hash_keeps_exactly_the_smallest(numbers, monkeypatch, n, edge):
    monkeypatch.setattr(sampling, "_EDGE_ROWS", edge)
    for keys in (None, ["k"]):
        assert rows_of(cap_rows(numbers, n, 7, "hash", keys)) == brute_force(numbers, row_rank(numbers, 7, keys), n)


def test_hash_does_not_depend_on_partitions_or_order(numbers):
    shuffled = numbers.orderBy(F.desc("k")).repartition(13, "x")
    assert rows_of(cap_rows(numbers, 100, mode="hash")) == rows_of(cap_rows(shuffled, 100, mode="hash"))
    assert rows_of(cap_rows(numbers, 100, mode="hash")) != rows_of(cap_rows(numbers, 100, seed=1, mode="hash"))


def test_bernoulli_beyond_one_task_cuts_exactly(numbers, monkeypatch):
    monkeypatch.setattr(sampling, "_EDGE_ROWS", 10)
    assert 1500 < cap_rows(numbers, 2000, mode="bernoulli").count() <= 2000


@pytest.mark.parametrize("edge", [0, 100_000])
def test_hot_key_and_identical_rows(spark, monkeypatch, edge):
    monkeypatch.setattr(sampling, "_EDGE_ROWS", edge)
    df = stage(spark.range(3000).select(F.when(F.col("id") < 2000, -1).otherwise(F.col("id")).alias("k")), "hot")
    assert cap_rows(df, 1000, mode="hash", keys=["k"]).count() == 1000
    assert cap_rows(df.where("k = -1"), 1999, mode="hash").count() == 1999


def test_maps_count_for_the_order(spark):
    df = spark.range(50).select(F.create_map(F.lit("b"), F.lit(0).cast("long"), F.lit("a"), F.col("id")).alias("m"))
    other = spark.range(50).select(F.create_map(F.lit("a"), F.col("id"), F.lit("b"), F.lit(0).cast("long")).alias("m"))
    ranks = [sorted(r[0] for r in d.repartition(n).select(row_rank(d)).collect()) for d, n in ((df, 3), (other, 7))]
    assert ranks[0] == ranks[1] and len(set(ranks[0])) == 50


def test_cut_through_equal_rows_sorts_few_of_them(spark, monkeypatch):
    """One row is two thirds of the table, and the cut lies among its copies."""
    monkeypatch.setattr(sampling, "_EDGE_ROWS", 50)
    df = stage(spark.range(9000).select(F.when(F.col("id") < 6000, -1).otherwise(F.col("id")).alias("k")), "equal")
    for n in (3001, 4500, 8999):
        cut = cap_rows(df, n, mode="hash")
        limits = re.findall(r"TakeOrderedAndProject\(limit=(\d+)", cut._jdf.queryExecution().executedPlan().toString())
        assert cut.count() == n and all(int(x) <= 50 for x in limits)


@pytest.mark.parametrize("n", [49, 51])
def test_bernoulli_acts_alike_around_the_old_threshold(numbers, monkeypatch, n):
    monkeypatch.setattr(sampling, "_EDGE_ROWS", 50)
    sampled = rows_of(cap_rows(numbers, n, seed=3, keys=["k"]))
    drawn = numbers.where(F.conv(F.substring(row_rank(numbers, 3, ["k"]), 1, 15), 16, 10).cast("long") < int(n / 5000 * 16**15))
    assert sampled == brute_force(drawn, row_rank(drawn, 3, ["k"]), n)


def test_distinct_sample_by_keys(spark):
    df = spark.range(4000).select((F.col("id") % 1000).alias("k"), (F.col("id") % 1000 / 7).alias("x"))
    sample, rows = distinct_sample(df, 120, 42, 4000, ["k"])
    whole = df.dropDuplicates()
    assert rows == 120 and rows_of(sample) == brute_force(whole, row_rank(whole, 42, ["k"]), 120)


def test_arguments(numbers):
    with pytest.raises(ValueError, match="mode"):
        cap_rows(numbers, 5, mode="first")
    with pytest.raises(ValueError, match="at least 1"):
        cap_rows(numbers, 0)


@pytest.mark.parametrize(
    ("copies", "distinct", "n"),
    [(1, 6000, 100), (3, 3000, 50), (100, 60, 40), (100, 60, 60), (100, 60, 500), (1, 500, 500), (2000, 3, 2)],
)
def test_distinct_sample_equals_removing_duplicates_first(spark, copies, distinct, n):
    df = spark.range(copies * distinct).select(
        (F.col("id") % distinct).cast("string").alias("t"),
        F.when(F.col("id") % distinct % 5 != 0, F.col("id") % distinct / 3).alias("x"),
    )
    sample, rows = distinct_sample(df, n, 42, copies * distinct)
    whole = df.dropDuplicates()
    assert rows == min(n, distinct)
    assert rows_of(sample.fillna(-1)) == sorted(
        (t, -1 if x is None else x) for t, x in brute_force(whole, row_rank(whole, 42), n)
    )


def test_distinct_sample_with_one_row_holding_a_third(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).cast("double").alias("x"))
    sample, rows = distinct_sample(df, 6001, 1, 9000)
    assert rows == 6001 and sample.distinct().count() == 6001


def test_zero_and_nan_forms_are_one_row(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),), (None,), (None,)], "x double")
    assert distinct_sample(df, 10, 42, 6)[1] == 3


def test_smallest_is_filter_without_wide_shuffle(numbers, monkeypatch):
    monkeypatch.setattr(sampling, "_EDGE_ROWS", 50)
    plan = smallest(numbers, row_rank(numbers), 1000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("TakeOrderedAndProject") == 1 and "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("edge", [5, 100_000])
@pytest.mark.parametrize("seed", range(6))
def test_keyed_bernoulli_draws_the_same_rows_everywhere(numbers, monkeypatch, seed, edge):
    monkeypatch.setattr(sampling, "_EDGE_ROWS", edge)
    rank = F.substring(row_rank(numbers, seed, ["k"]), 1, 15)
    ranked = sorted((r.rank, r.k, r.x) for r in numbers.withColumn("rank", rank).collect())
    expected = sorted((k, x) for rank, k, x in ranked[:1000] if int(rank, 16) < int(1000 / 5000 * 16**15))
    for table in (numbers, numbers.orderBy(F.desc("k")).repartition(3)):
        assert rows_of(cap_rows(table, 1000, seed, "bernoulli", ["k"])) == expected


def test_bernoulli_draws_copies_apart_without_keys_and_together_with(spark):
    df = stage(spark.range(4000).select((F.col("id") % 2).alias("k")), "copies")
    assert 1700 < cap_rows(df, 2000, 3).count() <= 2000
    assert cap_rows(df, 2000, 3, keys=["k"]).count() in (0, 2000)


def test_bernoulli_is_one_pass(spark, monkeypatch):
    """Rows are numbered once: what is too much is cut in the written sample."""
    passes = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            passes.add(batch.num_rows)
            yield batch

    df = spark.range(3000).mapInArrow(seen, "id long")
    sampling._drawn(df, 1000, 3000, 1, ["id"]).count()
    assert passes.value == 3000
