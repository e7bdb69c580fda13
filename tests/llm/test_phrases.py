"""Collocations: tries and the operator against plain counting, with and without every bound."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from segmill.llm import phrases, tries
from segmill.llm.common import Scratch

SCHEMA = "doc_id long, text string, lang string"


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 5), st.sampled_from([2, 40, 300, 70_000, 20_000_000]))
def test_tries_find_every_sequence_and_no_other(seed, length, largest):
    rng = np.random.default_rng(seed)
    rows = np.unique(rng.integers(1, largest + 1, (int(rng.integers(0, 400)), length)), axis=0)
    rng.shuffle(rows)
    trie = tries.build(rows.reshape(-1, length))
    text = rng.integers(0, largest * 2, 1500)
    for row in rows[:60]:
        at = rng.integers(0, len(text) - length)
        text[at : at + length] = row
    known = {tuple(r): i for i, r in enumerate(rows.tolist())}
    expected = [known.get(tuple(text[i : i + length].tolist()), -1) if i + length <= len(text) else -1 for i in range(len(text))]
    assert trie.ends(text, length).tolist() == expected


def brute(rows, least, inside=100, most=2000, longest=5):
    counts, out = {}, []
    for _, text, lang in rows:
        c = counts.setdefault("und" if lang is None else lang, Counter())
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            c.update(tuple(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    for lang, c in counts.items():
        n = sum(a for p, a in c.items() if len(p) == 1)
        candidates = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        gone = {p[i:j] for p, a in candidates.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and 100 * a >= inside * c[p[i:j]]}
        found = []
        for p, a in candidates.items():
            if p not in gone:
                score, k = min((1000 * a * n // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                found.append((score, a, " ".join(p), c[p[:k]], c[p[k:]]))
        found.sort(key=lambda f: (-f[0], -f[1], f[2].encode()))
        out += [(lang, i + 1, p, a, left, right, n, score) for i, (score, a, p, left, right) in enumerate(found[:most])]
    return sorted(out)


def odd_rows(seed=1):
    rng = random.Random(seed)
    pool = ["New", "york", "new", "York", "É", "é", "a'b", "漢字", "😀", "\x1c", "ÿ", " ", "x" * 3000, *[f"w{i}" for i in range(20)]]
    text = lambda n: "".join(rng.choice(pool) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "\r\n"]) for _ in range(n))
    rows = [(i, text(rng.randint(0, 60)), rng.choice(["en", "en", "en", "de", None, "und"])) for i in range(80)]
    rows += [(i, "one two three four five six seven", "en") for i in range(12)] + [(i, "loop " * 40, "en") for i in range(3)]
    return rows + [(None, None, None), (1, "", ""), (2, "... !!", "zz"), (3, text(20_000), "fr")] + [rows[0]] * 4


BOUNDS = [{}, {"TRIE": 400, "BUCKETS": 512, "VOCABULARY": 0, "_TEXTS": 400, "_BLOCK": 500, "BROADCAST_LANGS": 0}]


@pytest.mark.parametrize("bounds", BOUNDS)
def test_collocations_against_plain_counting(spark, monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(phrases, name, value)
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumns({c: F.lit(1) for c in ("n", "word", "key", "salt", "score", "words")})
    got = phrases.best(phrases.mine(df, least=3)).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 3)
    assert len(got) > 100


def test_shares_and_ranks(spark):
    rows = odd_rows(2)
    df = spark.createDataFrame(rows, SCHEMA)
    got = phrases.best(phrases.mine(df, least=2, inside=60, longest=3), 7).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 2, 60, 7, 3)


def test_empty_tables(spark):
    for rows in ([], [(1, None, None)], [(1, "no two words twice", "en")]):
        assert phrases.best(phrases.mine(spark.createDataFrame(rows, SCHEMA), least=2)).count() == 0


def test_large_products_stay_exact(spark):
    """Scores of counts whose products pass 64 bits."""
    big = 10**13
    row = spark.createDataFrame([(b"", big, "en", "a b", "b", [big], [big])], phrases._PHRASE)
    total = spark.createDataFrame([("en", None, 10**15)], "lang string, word string, n long")
    out = phrases.scored(row, 2, total).first()
    assert out["score"] == 1000 * big * 10**15 // (big * big)


def test_op13_against_plain_counting(spark):
    from segmill.llm import queries

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()]
    assert sorted(tuple(r) for r in queries.queries()["op13_collocations"](spark, sf).collect()) == brute(rows, 100)


@pytest.mark.parametrize("held", [phrases._HELD, 1])
def test_windows_of_a_large_corpus_are_looked_up_in_one_pass(spark, monkeypatch, held):
    monkeypatch.setattr(phrases, "_HELD", held)
    blocks = [np.array([1, 2, 3, 0, 1, 2, 4, 0, 5, 6, 0], "<i4"), np.array([1, 2, 3, 0, 7, 8, 0], "<i4")]
    corpus = spark.createDataFrame([(bytearray(b.tobytes()),) for b in blocks], "ids binary").repartition(1)
    scratch = Scratch()
    pairs = phrases._candidates(corpus, 2, [], 1_700_000_000, 2, scratch)  # the words of about 6 GB
    assert len(scratch.tables) == 1
    frequent = np.array(sorted(np.frombuffer(r["key"], "<i4").tolist() for r in pairs.collect()), np.int64)
    assert frequent.tolist() == [[1, 2], [2, 3]]
    triples = phrases._candidates(corpus, 3, [frequent], 1_700_000_000, 2, scratch).collect()
    assert len(scratch.tables) == 2 and [np.frombuffer(r["key"], "<i4").tolist() for r in triples] == [[1, 2, 3]]
    scratch.drop()
