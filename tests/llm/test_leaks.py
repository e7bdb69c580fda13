"""Decontamination against an aligner that tries everything, and repetitive texts."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from segmill.llm import templates

from .brute import brute_leaks
from .test_pipeline import SF


def leaks(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows, found = templates.find_leaks(docs, benchmark, keep=["doc_id"])
    found = rows.select("row.doc_id", "row_no").join(found, "row_no").collect()
    return {(r["doc_id"], r["item_id"]): (r["n_windows"], r["item_windows"], r["n_slots"], r["n_changed"]) for r in found}


def test_every_alignment_of_mixed_texts(spark):
    rng = random.Random(83)
    vocabulary = "row your boat Gently down the stream Merrily life is but a dream".split()

    def passage(n):
        return [rng.choice([*vocabulary, str(rng.randint(1, 9)), f"{rng.randint(1, 9)} km", rng.choice(["Ann", "Bob", "Eve Smith"])]) for _ in range(n)]

    items = [passage(rng.randint(9, 40)) for _ in range(6)] + [("row your 3 boat " * 12).split(), ("the Bob " * 15).split(), passage(4), ["a", "b"]]
    texts = []
    for _ in range(40):
        copied = [rng.choice(["Ann", "Carl", "7", w]) if rng.random() < 0.1 else w for w in rng.choice(items)]
        texts.append(" ".join(passage(rng.randint(0, 30)) + copied * rng.choice([1, 1, 3]) + passage(rng.randint(0, 30))))
    texts += ["", None, "row your 5 boat " * 60, "row your 5 boat row your 6 boat " * 40, "The Bob and the Bob " * 30, "the Eve " * 70]
    items = [" ".join(i) for i in items]
    expected = brute_leaks(texts, items, templates.UNITS)
    assert len(expected) >= 20 and leaks(spark, texts, items) == expected


@pytest.mark.parametrize(("text", "item"), [("row your boat ", 133), ("row 5 boats and 7 Dogs in Paris ", 50)])
def test_repetitive_text_against_repetitive_item(spark, text, item):
    n = (20_000 // len(text.split())) * len(text.split())
    got = leaks(spark, [" ".join((text * (n // len(text.split()))).split()[:n]), "row"], [text * item])
    (key, (n_windows, item_windows, _, n_changed)), = got.items()
    assert key == (0, 0) and n_windows == item_windows and n_changed == 0


def test_op4_equals_every_alignment(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    ids, names = list(texts), list(items)
    expected = {(ids[d], names[i]): v for (d, i), v in brute_leaks(texts.values(), items.values(), templates.UNITS).items()}
    got = contract.queries()["op4_decontamination"](spark, SF).select("doc_id", "item_id", F.array("n_windows", "item_windows", "n_slots", "n_changed").alias("n"))
    assert {(r["doc_id"], r["item_id"]): tuple(r["n"]) for r in got.collect()} == expected


def test_only_texts_with_enough_windows_are_read_again(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"{a}{b}" for a in ("ba", "ko", "mi", "ru", "se") for b in ("lan", "dor", "fin", "tes", "pul", "gra")]
    item = " ".join(rng.choice(words) for _ in range(30))
    texts = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(40)]
    texts[7] += f" {item}"
    texts[9] = f"{item} {texts[9]} {item}"
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame([(0, item)], "item_id long, text string")
    found = []
    for most in (templates.BROADCAST_ROWS, 0):  # 0: the row numbers are shuffled, not broadcast
        monkeypatch.setattr(templates, "BROADCAST_ROWS", most)
        rows, leaked = templates.find_leaks(docs, benchmark, keep=["doc_id"])
        read = {file.rsplit("/", 2)[-2].rsplit("-", 1)[0] for file in leaked.inputFiles()}
        assert "leak-rows" not in read and "leak-values" in read
        values = {file.rsplit("/", 1)[0] for file in leaked.inputFiles() if "/leak-values-" in file}
        assert spark.read.parquet(*values).count() == 2
        found.append(sorted(map(tuple, rows.join(leaked, "row_no").select("row.doc_id", *templates.RESULTS).collect())))
    assert found[0] == found[1] and [r[0] for r in found[0]] == [7, 9]


def test_windows_are_hashed_by_generated_code(spark, monkeypatch):
    plans, stage = {}, templates.stage

    def staged(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stage(df, name)

    monkeypatch.setattr(templates, "stage", staged)
    item = "one two three four five six seven eight nine ten"
    for items, n_found in (([item], 2), ([item, "a b c d"], 3)):  # one width of windows, and two
        assert len(leaks(spark, [f"so {item}", f"{item} a b c d", "one two three", "", None], items)) == n_found
        steps = [line.lstrip(" :+-") for line in plans["leak-lines"].splitlines()]
        made = [step for step in steps if step.startswith("Generate ")]
        assert made and not any("lambda" in step for step in made)
        assert sum("regexp_extract_all" in step for step in steps) == 1


@pytest.mark.parametrize(("word", "gap"), [("Von", " "), ("12", ",")])
def test_thousands_of_names_or_numbers_in_a_row_are_one_token(spark, word, gap):
    long = f"the {gap.join([word] * 50_000)} end"
    tokens = spark.createDataFrame([(long,)], "text string").select(templates.raw_tokens(F.col("text")), templates.canonical_tokens(F.col("text")))
    raw, canonical = tokens.first()
    kind = templates.NAME if word == "Von" else templates.NUMBER
    assert raw == ["the", gap.join([word] * 50_000), "end"] and canonical == ["the", kind, "end"]
