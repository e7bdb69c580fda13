"""Token files: exact round trips of the words, ids equal to those of whole texts, odd tables."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from segmill.llm import queries, token_files

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def whole(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


number = st.one_of(st.just(0), st.integers(0, 3), st.integers(0, 50_000), st.integers(0, 2**64 - 1), st.sampled_from([2**60 - 2, 2**60 - 1, 2**60]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.lists(number, min_size=1, max_size=40), st.integers(1, 700).map(lambda n: [0] * n)), max_size=6))
def test_words_round_trip_document_by_document(docs):
    ids = np.array([x for d in docs for x in d], np.uint64)
    words, counts, escapes = token_files.pack(ids, np.cumsum([len(d) for d in docs], dtype=np.int64))
    assert token_files.unpack(words, escapes).tolist() == ids.tolist()
    block = {"words": words.tobytes(), "escapes": escapes.tobytes(), "word_counts": counts.tolist(), "escape_counts": [sum(x >= 2**60 - 1 for x in d) for d in docs]}
    for i, d in enumerate(docs):
        assert token_files.read_document(block, i).tolist() == d


@pytest.mark.parametrize(("ids", "words"), [([0] * 240, 1), ([0] * 241, 2), ([1] * 60, 1), ([3] * 30, 1), ([7] * 20, 1), ([50_000] * 3, 1), ([50_000] * 4, 2), ([2**30 - 1] * 2, 1), ([2**60 - 2], 1)])
def test_words_take_as_many_ids_as_fit(ids, words):
    assert len(token_files.pack(np.array(ids, np.uint64), np.array([len(ids)]))[0]) == words


blanks = st.lists(st.sampled_from([*"ab1.,!'é ß漢😀", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", " ", "​", "'s", "<|endoftext|>", "ɐ."]), max_size=25).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(blanks, min_size=1, max_size=4))
def test_cut_texts_have_the_ids_of_whole_ones(texts):
    import pyarrow as pa

    for path in (BPE, WORDS):
        ids, counts = ENCODERS[path](pa.array(texts))
        expected = [whole_of[path](t) for t in texts]
        assert ids.tolist() == [x for e in expected for x in e] and counts.tolist() == [len(e) for e in expected]


whole_of = {path: whole(path) for path in (BPE, WORDS)}
ENCODERS = {path: token_files.Encoder(path) for path in (BPE, WORDS)}


def expected(rows, end=0):
    """Rows in order, with ids from the whole texts."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*whole_of[BPE](text), end]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def test_op11_against_whole_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    got = [tuple(r) for r in queries.queries()["op11_token_ids"](spark, SF).orderBy("doc_id").collect()]
    assert got == [row[:4] for row in expected(docs)]


@pytest.mark.parametrize(("shards", "block"), [(1, 1), (3, 50), (7, 65_536)])
def test_odd_table(spark, tmp_path, monkeypatch, shards, block):
    rng = random.Random(5)
    long = " ".join(f"w{rng.randrange(3000)}" for _ in range(30_000))
    texts = [None, "", " ", "a  b", "x" * 30_000, long, "é ü ß 漢字 😀", "<|endoftext|>", "one two", "one two."]
    rows = [(i if i % 4 else None, t) for i, t in enumerate(texts * 3)] + [(5, "same")] * 20
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("place", "shard", "block", "ids", "start")})
    monkeypatch.setattr(token_files, "BLOCK_IDS", block)
    path = str(tmp_path / "tokens")
    token_files.write_tokens(df.repartition(3), path, BPE, end_id=50_256, shards=shards)
    got = [tuple(r) for r in token_files.read_tokens(spark, path).orderBy("start").collect()]
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
    given_ = sorted((repr(i), [*whole_of[BPE](t), 50_256]) for i, t in rows)
    assert sorted((repr(r[0]), r[4]) for r in got) == given_
    start = 0
    for r in got:
        assert r[1] == start and r[2] == len(r[4]) and r[3] == zlib.crc32(np.array(r[4], "<u4").tobytes())
        start += r[2]
    again = str(tmp_path / "again")
    token_files.write_tokens(df.repartition(5), again, BPE, end_id=50_256, shards=2)
    rows_of = lambda where: sorted(map(repr, token_files.read_tokens(spark, where).collect()))
    assert rows_of(again) == rows_of(path)


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    token_files.write_tokens(df, str(tmp_path / "none"), BPE)
    assert token_files.read_tokens(spark, str(tmp_path / "none")).count() == 0


def test_files_ascend(spark, tmp_path):
    path = str(tmp_path / "files")
    token_files.write_tokens(spark.read.parquet(f"{SF}/documents.parquet"), path, BPE, shards=5)
    blocks = spark.read.parquet(path).select("shard", "block", "doc_ids", F.input_file_name().alias("file")).orderBy("shard", "block").collect()
    ids = [i for b in blocks for i in b["doc_ids"]]
    assert ids == sorted(ids) and [b["file"] for b in blocks] == sorted(b["file"] for b in blocks)


@pytest.mark.parametrize("few", [0, 3, 1000])
def test_words_of_many_documents_start_as_if_followed_one_by_one(monkeypatch, few):
    monkeypatch.setattr(token_files, "_FEW", few)
    rng = np.random.default_rng(3)
    lengths = np.append(rng.integers(1, 40, 50), [400, 1])
    ends = np.cumsum(lengths)
    step = np.minimum(rng.integers(1, 9, ends[-1]), np.repeat(ends, lengths) - np.arange(ends[-1])).astype(np.uint8)
    expected, at = [], 0
    while at < ends[-1]:
        expected.append(at)
        at += int(step[at])
    assert token_files._starts(step, ends).tolist() == expected
    assert token_files._starts(np.zeros(0, np.uint8), np.zeros(0, np.int64)).tolist() == []
