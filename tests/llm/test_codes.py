"""Vector codes: exact products, codebooks against plain integer arithmetic, odd tables."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from segmill.llm import codes

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, parts=8, entries=16, rounds=6):
    """The rows with code, error, label_error and the digest of the codebooks, in Python's integers."""
    good = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    cut = [[[math.floor(4096 * x) for x in v[p * len(v) // parts : (p + 1) * len(v) // parts]] for p in range(parts)] for _, v, _ in good]
    first = sorted(range(len(good)), key=lambda i: (good[i][0] is None, good[i][0] or 0, good[i][1]))[:entries]
    books = [[cut[i][p] for i in first] for p in range(parts)]

    def assign(v):
        far = [[sum((a - b) ** 2 for a, b in zip(v[p], e, strict=True)) for e in books[p]] for p in range(parts)]
        return [(d.index(min(d)), min(d)) for d in far]

    for _ in range(rounds):
        members = defaultdict(list)
        for v in cut:
            for p, (e, _) in enumerate(assign(v)):
                members[p, e].append(v[p])
        for (p, e), m in members.items():
            books[p][e] = [sum(x) // len(m) for x in zip(*m, strict=True)]
    found = [assign(v) for v in cut]
    total = defaultdict(int)
    for (_, _, label), f in zip(good, found, strict=True):
        total[label] += sum(d for _, d in f)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{e:02x}" for e, _ in f), sum(d for _, d in f), total[label], digest) for (i, _, label), f in zip(good, found, strict=True)), key=repr)


def got(df):
    rows = codes.compress(df).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    return sorted((tuple(r) for r in rows), key=repr)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 60), st.integers(1, 5), st.integers(0, 2**32))
def test_products_are_exact(bits, dims, seed):
    rng = random.Random(seed)
    bits = min(bits, (62 - dims.bit_length()) // 2 if seed % 2 else bits)
    other = 62 - dims.bit_length() - bits
    a = np.array([[rng.randint(-(1 << bits), 1 << bits) for _ in range(dims)] for _ in range(4)], np.int64)
    b = np.array([[rng.randint(-(1 << max(other, 0)), 1 << max(other, 0)) for _ in range(dims)] for _ in range(3)], np.int64)
    expected = [[sum(int(x) * int(y) for x, y in zip(r, c, strict=True)) for c in b] for r in a]
    assert codes.products(a, b).tolist() == expected


@pytest.mark.parametrize("size", [1, 1 << 12, 1 << 29, 1 << 40, 1 << 61])
def test_nearest_of_any_size(size):
    rng = random.Random(size)
    a = [[rng.randint(-size, size) for _ in range(8)] for _ in range(50)]
    b = [[rng.randint(-size, size) for _ in range(8)] for _ in range(6)]
    b += [b[0], a[3]]
    which, far = codes.nearest(np.array(a, np.int64), np.array(b, np.int64))
    for x, w, d in zip(a, which, far, strict=True):
        all_ = [sum((p - q) ** 2 for p, q in zip(x, e, strict=True)) for e in b]
        assert int(d) == min(all_) and int(w) == all_.index(min(all_))


def odd_rows():
    rng = random.Random(3)
    rows = [(i, [rng.choice([rng.gauss(0, 1), rng.gauss(0, 1), -0.5, 0.0, 1e-9, -1e-9]) for _ in range(16)], rng.choice([1, 1, 1, 2, None])) for i in range(300)]
    rows += [rows[40]] * 5 + [(7, rows[50][1], 1), (None, rows[51][1], None), (None, None, None)]
    bad = [None, float("nan"), float("inf"), -float("inf")]
    return rows + [(-1 - i, [x] + [1.0] * 15, 2) for i, x in enumerate(bad)] + [(-9, [12345.678] * 16, 3), (900, [1000.0] * 16, None)]


@pytest.mark.parametrize("labels", [codes.BROADCAST_LABELS, 0])
def test_codes_against_plain_integers(spark, monkeypatch, labels):
    monkeypatch.setattr(codes, "BROADCAST_LABELS", labels)
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    clash = df.withColumns({c: F.lit("x") for c in ("row", "v", "code", "error", "n", "sums", "codebooks_sha256", "__salt_")})
    assert got(clash) == brute(rows)


def test_few_and_no_vectors(spark):
    rows = [(5, [1.0, -1.0] * 8, 1), (2, [0.25] * 16, None)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    for none in ([], [(1, None, 1)], [(1, [float("nan")] * 8, 1)]):
        assert got(spark.createDataFrame(none, SCHEMA)) == []


def test_unequal_lengths_are_an_error(spark):
    with pytest.raises(Exception, match="same number"):
        got(spark.createDataFrame([(1, [1.0] * 8, 1), (2, [1.0] * 16, 1)], SCHEMA))
    with pytest.raises(ValueError, match="equal parts"):
        got(spark.createDataFrame([(1, [1.0] * 9, 1)], SCHEMA))


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(1, [1.0] * 8, 4)], SCHEMA).withColumn("name", F.lit("n"))
    assert codes.compress(df).columns == ["vec_id", "label", "name", "code", "error", "label_error", "codebooks_sha256"]


def test_op12_against_plain_integers(spark):
    from segmill.llm import queries

    sf = "/root/testdata/sf0.001"
    rows = [(r[0], [float(x) for x in r[1]], r[2]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted((tuple(r) for r in queries.queries()["op12_vector_codes"](spark, sf).collect()), key=repr) == brute(rows)
