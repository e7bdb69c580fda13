"""License scan: copies that lack words, templates of any kind, many finds, and an aligner of its own."""

import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from segmill.llm import patience, queries

KNOWN = patience.templates()
LONG = [t for t in KNOWN if len(t.words) >= 20]


def lcs(a, b):
    """Length of the longest common subsequence, by rows."""
    row = [0] * (len(b) + 1)
    for x in a:
        above = 0
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], above + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@settings(max_examples=150, deadline=None)
@given(st.sampled_from(KNOWN), st.integers(0, 2**32))
def test_a_copy_that_lacks_a_fifth_is_found(template, seed):
    """Any words may go, signals before all others, and other words stand around."""
    rng = random.Random(seed)
    n, spare = len(template.words), template.spare(patience.COVERAGE)
    order = sorted(range(n), key=lambda i: (seed % 2 == 0 and template.words[i] not in template.signals, rng.random()))
    gone = set(order[:spare])
    copy = [w for i, w in enumerate(template.words) if i not in gone]
    around = [" ".join(f"x{rng.randrange(50)}" for _ in range(rng.randint(0, 60))) for _ in range(2)]
    text = f"{around[0]} {' '.join(copy)} {around[1]}"
    found = patience.find_licenses(text, [template])
    assert [(f[0], f[2]) for f in found] == [(template.license, n - spare)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["row", "your", "boat", "the", "a", "stream"]), min_size=1, max_size=40), st.integers(0, 2**32))
def test_templates_of_any_words(words, seed):
    rng = random.Random(seed)
    (template,) = [patience._template("X", " ".join(words))]
    gone = set(rng.sample(range(len(words)), template.spare(0.8)))
    text = " ".join(w for i, w in enumerate(words) if i not in gone)
    found = patience.find_licenses(f"before {text} after", [template])
    assert found and found[0][2] >= 0.8 * len(words) and found[0][2] <= lcs(re.findall(r"\w+", text), template.words)


def test_texts_of_the_caller_need_no_certain_word():
    own = patience.templates({"own": ["Do what the f you want to public"]})
    assert [f[0] for f in patience.find_licenses("so: DO what the f you want to public.", own)] == ["own"]
    assert patience.find_licenses("do what public", own) == [] and patience.find_licenses(None, own) == []
    assert patience.find_licenses("anything", []) == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abcdefgh"), max_size=30), st.lists(st.sampled_from("abcdefgh"), max_size=30))
def test_alignment_rises_and_is_never_longer_than_the_longest(a, b):
    pairs = patience.align(a, b)
    assert all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert len(pairs) <= lcs(a, b)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=30), st.integers(0, 2**32))
def test_what_is_left_of_a_text_aligns_whole(words, seed):
    rng = random.Random(seed)
    left = [w for w in words if rng.random() < 0.7]
    assert len(patience.align(left, words)) == len(left) or len(set(words)) < len(words)


def test_many_finds_take_time_in_proportion():
    def seconds(n):
        start = time.process_time()
        assert len(patience.find_licenses("Released under the MIT License. Some words of others. " * n, KNOWN)) == n
        return time.process_time() - start

    assert seconds(8000) < 8 * seconds(2000) + 2


@pytest.mark.parametrize("template", LONG, ids=lambda t: f"{t.license}-{len(t.words)}")
def test_finds_have_the_coverage_of_the_longest_common_subsequence(template):
    rng = random.Random(len(template.words))
    words = list(template.words)
    for i in rng.sample(range(len(words)), len(words) // 10):
        words[i] = f"other{i}"
    text = " ".join(["x"] * 30 + words + ["y"] * 30)
    (found,) = [f for f in patience.find_licenses(text, [template])]
    assert found[2] == lcs(text.split(), template.words)


def test_op1_against_an_aligner_of_its_own(spark):
    """Every report has the coverage of an exact alignment of its span, and every document that holds a template is reported there."""
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    reports = {}
    for r in queries.queries()["op1_licenses"](spark, sf).collect():
        span = re.findall(r"\w+", texts[r["doc_id"]][r["start"] : r["end"]].lower())
        assert any(t.license == r["license"] and len(t.words) == r["n_template"] and lcs(span, t.words) >= r["n_matched"] >= 0.8 * len(t.words) for t in KNOWN)
        assert r["coverage"] == r["n_matched"] / r["n_template"]
        reports.setdefault(r["doc_id"], []).append((r["start"], r["end"], r["n_matched"]))
    assert reports
    for doc_id, text in texts.items():
        tokens = list(re.finditer(r"\w+", (text or "").lower()))
        words = [m[0] for m in tokens]
        held = set(words)
        for t in KNOWN:
            n, spare = len(t.words), len(t.words) - 0.8 * len(t.words)
            if len(set(t.words) - held) > spare + 1e-9:
                continue
            rare = min(set(t.words), key=words.count)
            for i in range(0, len(words), max(1, n // 2)):
                part = words[i : i + 2 * n]
                if rare in part and len(set(t.words) - set(part)) <= spare and lcs(part, t.words) >= 0.8 * n:
                    a, b = tokens[i].start(), tokens[min(i + 2 * n, len(words)) - 1].end()
                    assert any(s < b and a < e for s, e, _ in reports.get(doc_id, [])), (doc_id, t.license)
