"""The numpy and text parts of the operators against brute force, without Spark."""

import random
import re
from html import escape

import numpy as np
import pandas as pd
import pytest
import xxhash
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from segmill.llm import darts, html_text, long_matches, multi_index, patience, quality, secrets, toxicity
from segmill.llm.run_index import matching_statistics

# Patience alignment


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abcdefgh"), max_size=25), st.lists(st.sampled_from("abcdefgh"), max_size=25))
def test_alignment_is_a_common_subsequence(a, b):
    pairs = patience.align(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:], strict=False))


def test_alignment_of_unique_words_is_the_longest_rising_run():
    rng = random.Random(3)
    for _ in range(50):
        n = rng.randint(1, 9)
        order = rng.sample(range(n), n)
        text = [f"w{i}" for i in order]
        best = max(bin(m).count("1") for m in range(1 << n) if sorted(p := [order[i] for i in range(n) if m >> i & 1]) == p)
        assert len(patience._increasing(list(enumerate(order)))) == best
        assert len(patience.align(text, [f"w{i}" for i in range(n)])) >= 1


def test_licenses_are_found_whole_changed_and_twice():
    known = patience.templates()
    mit = patience.TEMPLATES["MIT"][0]
    words = mit.split()
    changed = " ".join("thing" if i % 9 == 4 else w for i, w in enumerate(words))
    found = patience.find_licenses(f"Before it. {changed} After it.", known)
    assert [f[0] for f in found] == ["MIT"] and 0.8 <= found[0][1] < 1
    text = "x " * 30 + "Released under the MIT License. " * 3
    found = patience.find_licenses(text, known)
    assert [text[f[4] : f[5]] for f in found] == ["Released under the MIT License"] * 3
    lesser = "This work is licensed under the GNU Lesser General Public License, version 3."
    assert [f[0] for f in patience.find_licenses(lesser, known)] == ["LGPL-3.0"]
    assert [f[0] for f in patience.find_licenses(lesser.replace("Lesser ", ""), known)] == ["GPL-3.0"]


def test_signal_words_before_a_license_do_not_split_it():
    known = patience.templates()
    notice = "Licensed under the Apache License, Version 2.0"
    for before in ("License / ", "License ", "Version 2 of the license of X: ", "apache version 2 0 license licensed "):
        text = before + notice + ". More."
        assert [(f[0], text[f[4] : f[5]]) for f in patience.find_licenses(text, known)] == [("Apache-2.0", notice)]
    assert [f[0] for f in patience.find_licenses("Version 2 of X is licensed under the Apache License, Version 2.0", known)] == ["Apache-2.0"]
    work = "License: This work is licensed under the GNU General Public License, version 3"
    assert [f[0] for f in patience.find_licenses(work, known)] == ["GPL-3.0"]
    mit = patience.TEMPLATES["MIT"][0]
    for word in ("so", "all", "following", "so all following"):
        assert [(f[0], f[1]) for f in patience.find_licenses(f"And {word} it is. {mit} The end.", known)] == [("MIT", 1.0)]


@pytest.mark.parametrize("text", [None, "", " ", "the software license of that", "licensed", "a" * 100_000, "copyright " * 20_000])
def test_no_license(text):
    assert patience.find_licenses(text, patience.templates()) == []


# Secrets


def _base_brute(text):
    out = []
    for kind, pattern in enumerate((secrets.ASSIGN, secrets.ACCESS, secrets.HEX)):
        at = 0
        while m := pattern.search(text, at):
            at = m.end()
            size = len(m[2]) if kind == 0 else len(m[0])
            if size >= (6, 20, 24)[kind]:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet='tokenTOKENsecret=:" AKIA0189abcdefé-', max_size=120))
def test_fixed_patterns(text):
    assert secrets.base_spans(text) == _base_brute(text)


def test_short_match_hides_what_it_covers():
    assert secrets.base_spans("token:token:abcdef1") == []
    assert secrets.base_spans("ſecret: abcdefg") == []  # only ASCII letters count as either case
    assert secrets.base_spans('API_KEY" : "abc123x"') == [(0, 0, 19)]


def test_what_a_fixed_pattern_leaves_of_a_run_is_a_candidate():
    rest = "q7Xn2LpZ9vKc4RtYb8WmD1sHfJ6gTeUa3oNiQxBk"
    for text, first, last in (("AKIA" + "Q7" * 10 + "/" + rest, 0, 24), ("0a1b2c3d" * 4 + "_" + rest, 0, 32), (rest + "/" + "0a1b2c3d" * 4, 41, 73)):
        spans = secrets.base_spans(text)
        assert [(a, b) for a, _, b in spans] == [(first, last)]
        found = secrets.candidates(text, spans)
        assert len(found) == 1 and rest in text[int(found[0][0]) : int(found[0][1])] and found[0][3] >= 0
        assert all(c[1] <= first or c[0] >= last for c in found)


def test_random_strings_pass_the_battery_and_words_do_not():
    rng = random.Random(5)
    alphabets = [a for _, a in secrets._ALPHABETS]
    passed = [secrets.measure("".join(rng.choices(a, k=40)))[3] >= secrets.LEAST_RANDOM for a in alphabets for _ in range(60)]
    assert np.mean(passed) > 0.97
    for token in ("a" * 40, "abcdefghijklmnopqrstuvwxyz0123456789", "01" * 20, "internationalisationinternationalisation"):
        assert secrets.measure(token)[3] < secrets.LEAST_RANDOM


def test_rule_of_benjamini_and_hochberg():
    rng = random.Random(7)
    for _ in range(50):
        steps = [rng.randint(0, 60) for _ in range(rng.randint(1, 40))]
        counts = {}
        for s in steps:
            counts[0, s] = counts.get((0, s), 0) + 1
        p = sorted(10 ** (-s / 10) for s in steps)
        passing = [x for i, x in enumerate(p, 1) if x <= 0.05 * i / len(p)]
        cuts = secrets._cuts(counts, 0.05)
        assert sum(s >= cuts.get(0, 10**9) for s in steps) == (len([x for x in p if x <= passing[-1]]) if passing else 0)


# Darts


@pytest.mark.parametrize("n", [1, 3, 60, 800])
@pytest.mark.parametrize("share", [0.3, 0.8, 0.95])
def test_signatures_estimate_weighted_similarity(n, share):
    rng = np.random.default_rng(n)
    x = rng.integers(0, 2**63, 2 * n, dtype=np.uint64)
    both = max(1, round(2 * n * share / (1 + share)))
    a, b = np.unique(x[:n]), np.unique(x[n - both : 2 * n - both])
    weight = {e: int(rng.integers(1, 5)) for e in x}
    wa, wb = (np.array([weight[e] for e in s]) for s in (a, b))
    exact = darts.similarity((a, wa), (b, wb))
    k = 2000
    same = (darts.signature(a, wa.astype(float), k) == darts.signature(b, wb.astype(float), k)).mean()
    assert abs(same - exact) < 0.06


def test_fractional_weights_are_regions_too():
    a = np.array([3, 5, 9], np.uint64)
    one, two = np.array([0.5, 2.25, 1.0]), np.array([1.0, 1.5, 1.0])
    exact = np.minimum(one, two).sum() / np.maximum(one, two).sum()
    same = (darts.signature(a, one, 4000) == darts.signature(a, two, 4000)).mean()
    assert abs(same - exact) < 0.05


def test_shingles_of_short_and_repeated_texts():
    assert len(darts.shingles(None)[0]) == len(darts.shingles("... !")[0]) == 0
    assert darts.shingles("one two")[1].tolist() == [1]
    assert darts.shingles("a " * 10)[1].tolist() == [6]


# Long matches


def test_matching_statistics():
    rng = random.Random(1)
    for _ in range(60):
        base = bytes(rng.choice(b"ab\0") for _ in range(rng.randint(1, 40)))
        strings = []
        for _ in range(rng.randint(1, 5)):
            a = rng.randint(0, len(base))
            s = bytearray(base[a : rng.randint(a, len(base))])
            if s and rng.random() < 0.5:
                s[rng.randrange(len(s))] = rng.choice(b"abc\xff")
            strings.append(bytes(s))
        places = [(i, p) for i, s in enumerate(strings) for p in range(len(s) + 1)]

        def match(one, two, strings=strings):
            a, b = strings[one[0]][one[1] :], strings[two[0]][two[1] :]
            return next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))

        expected = [max((match(p, q) for q in places if q != p), default=0) for p in places]
        assert matching_statistics(strings)[0].tolist() == expected


def test_stretches_cover_every_window_once():
    rng = random.Random(2)
    for data in (bytes(rng.choices(b"abcd", k=3000)), b"x" * 5000, bytes(200), bytes(199)):
        _, starts, ends, _ = long_matches.stretches(data)
        assert [i for a, b in zip(starts, ends, strict=True) for i in range(a, b)] == list(range(max(0, len(data) - 199)))


# HTML


def page(article, before="", after=""):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{before}{article}{after}</body></html>"


PARAGRAPHS = ["First of all, this is a long sentence; it has marks.", "A second one, with more & more words, follows it.", "Short."]


def test_article_among_everything_else():
    body = "<h1>Title</h1>" + "".join(f"<p>{escape(p)}</p>" for p in PARAGRAPHS)
    rest = (
        '<nav><a href="/">Home, of the site.</a></nav><header><h2>Site, name.</h2></header><div class="ad">Buy, buy, buy it now, please.</div>'
        '<aside>Side, notes, are here.</aside><div id="cookie-notice">We use cookies, as everyone does, for no reason.</div>'
        '<form><label>Mail, please</label><input></form><script>var t = "</p>, text, text";</script>'
    )
    comments = '<section class="comments"><h2>Comments</h2><p>I, a reader, disagree with this, and that.</p></section>'
    expected = "\n".join(["Title", *PARAGRAPHS])
    assert html_text.main_text(page(f"<article>{body}</article>", rest, comments + "<footer>Made, by us.</footer>")) == expected
    assert html_text.main_text(page(f"<article>{body}{comments}</article>", rest)) == expected
    assert html_text.main_text(page(f'<div class="post"><div>{body}</div></div>', rest, comments)) == expected


LONG = "<p>" + "A long sentence, with marks and words, goes on here. " * 30 + "</p>"


@pytest.mark.parametrize("out", ["article", "main", "div role=main", "div"])
def test_nothing_of_the_article_is_left_out(out):
    rest = '<nav><a href="/">Home, of the site.</a></nav>'
    close = out.split()[0]
    for body, lost in [
        (f"<section>{LONG}</section><section><p>A second, short section.</p></section>", "A second, short section."),
        (f"<h1>The title</h1><div>{LONG}{LONG}</div>", "The title"),
        (f"<div><p>A lead, of a line.</p></div><div>{LONG}{LONG}</div>", "A lead, of a line."),
    ]:
        text = html_text.main_text(page(f"<{out}>{body}</{close}>", rest, "<footer>Made, by us.</footer>"))
        assert lost in text.split("\n") and "Home" not in text and "Made" not in text
    if out != "div":
        text = html_text.main_text(page(f'<{out}>{LONG}<ul><li><a href="x">A source</a></li></ul></{close}>', '<ul><li><a href="y">Menu</a></li></ul>'))
        assert text.endswith("\nA source") and "Menu" not in text
    links = '<div><ul><li><a href="y">Menu</a></li></ul></div>'
    assert "Menu" not in html_text.main_text(page(f"<div><div>{LONG}</div></div>", links))


@pytest.mark.parametrize(
    "part",
    [
        "<section id='related-work'><h2>Work</h2><p>It is, as said, related.</p></section>", "<h2 id='search-algorithms'>Search</h2>",
        "<div id='social-history'><p>It is, as said, social.</p></div>", "<section id='comments-on-the-method'><p>It is, as said.</p></section>",
        "<p class='notice-period'>Four weeks, as said.</p>", "<p>Choose <span class='menu'>File</span> there.</p>",
    ],
)
def test_marks_in_an_article_do_not_take_its_sections(part):
    expected = " ".join(re.sub("<[^>]*>", " ", part).split())
    ads = '<div class="ad">Buy, buy it.</div><div class="share-buttons">Share it Tweet it</div><div class="post-related"><a href="x">More, of it.</a></div>'
    text = html_text.main_text(page(f"<article>{LONG}{part}{ads}</article>"))
    assert text.split("\n", 1)[1].replace("\n", " ") == expected


def test_broken_markup_and_references():
    html = "<body><nav>Menu, of all</nav><article><h1>T</h1><p><b>One &amp;amp; two,<br><p>three&nbsp; \n four &#8212; five.</p><br></article><footer>x"
    assert html_text.main_text(html) == "T\nOne &amp; two,\nthree four — five."


@pytest.mark.parametrize("html", [None, "", "   ", "<html></html>", "<nav>only, a menu</nav>", "<!-- x -->"])
def test_no_text(html):
    assert html_text.main_text(html) == ""


def test_plain_and_very_long_pages():
    assert html_text.main_text("just, text") == "just, text"
    assert html_text.main_text("<article>" + "<div>" * 500 + "deep, text" + "</div>" * 500 + "</article>") == "deep, text"
    assert len(html_text.main_text("<article><p>" + "word, " * 50_000 + "</p></article>")) == 299_999


# Index


def test_walk_takes_cells_by_rising_sum():
    rng = np.random.default_rng(4)
    first, second, sizes = rng.random(7), rng.random(7), rng.integers(0, 4, 49)
    cells = multi_index.walk(first, second, sizes, sizes.sum())
    sums = [first[c // 7] + second[c % 7] for c in cells]
    assert sums == sorted(sums) and sorted(cells) == np.flatnonzero(sizes).tolist()


def test_blocks_hold_whole_cells_or_parts_of_one():
    sizes = np.array([3, 0, 9, 30, 1, 1, 8, 25])
    first, parts, n = multi_index._blocks(sizes, 10)
    assert parts.tolist() == [1, 1, 1, 3, 1, 1, 1, 3]
    load = np.zeros(n + 3)
    for f, p, s in zip(first, parts, sizes, strict=True):
        load[f : f + p] += s / p
    assert load.max() <= 10 and n >= first.max()


# Classifiers


def test_forest_learns_and_walks_like_single_rows():
    rng = np.random.default_rng(6)
    x = rng.random((800, 5))
    y = ((x[:, 1] > 0.4) ^ (x[:, 3] > 0.7)).astype(float)
    forest = quality.fit_forest(x[:600], y[:600], trees=40)
    p = forest.score(x)
    assert ((p[600:] > 0.5) == y[600:]).mean() > 0.95
    for row in range(5):
        margin = forest.base
        for t in range(len(forest.feature)):
            node = 0
            while node < forest.feature.shape[1]:
                node = 2 * node + 1 + int(x[row, forest.feature[t, node]] > forest.cut[t, node])
            margin += forest.leaf[t, node - forest.feature.shape[1]]
        assert p[row] == pytest.approx(1 / (1 + np.exp(-margin)))


@pytest.mark.parametrize("y", [[], [1.0, 1.0], [0.0]])
def test_forest_without_two_classes(y):
    p = quality.fit_forest(np.zeros((len(y), 3)), np.array(y)).score(np.zeros((2, 3)))
    assert p.shape == (2,) and (0 < p).all() and (p < 1).all()


@pytest.mark.parametrize("text", [None, "", " ", "\n\n", "x", "!" * 5, "é" * 100_000, "a b " * 50_000, "😀 ok"])
def test_statistics_are_finite(text):
    assert np.isfinite(quality.statistics(text)).all()
    assert np.isfinite(toxicity.coordinates(text)).all()


def test_words_hash_by_content_only():
    h, _ = toxicity.word_hashes("Alpha, beta (ALPHA) été alpha_1 beta")
    assert h[0] == h[2] and h[1] == h[5] and len(set(h.tolist())) == 4
    assert len(re.findall(r"\w+", "Alpha, beta (ALPHA) été alpha_1 beta")) == len(h)


def test_ftrl_is_sparse_and_separates():
    rng = np.random.default_rng(8)
    examples = []
    for i in range(600):
        noise = rng.integers(100, 4000, 60)
        examples.append((np.unique([7, *noise] if i % 6 == 0 else noise), int(i % 6 == 0)))
    model = toxicity.ftrl(examples[:500], bits=12)
    scores = np.array([model.score(x) for x, _ in examples[500:]])
    truth = np.array([y for _, y in examples[500:]])
    assert ((scores >= 0.3) == truth).mean() > 0.97
    assert len(model.index) < 400


def _stretch_rows(n, length):
    texts = [bytes([65 + i % 26]) * i + bytes(range(97, 97 + 26)) * 2 for i in range(n)]
    wanted = [[{"key": i, "content": -i, "crowded": False, "alone": i % 2 == 0, "first": 1, "windows": len(t) - length}] for i, t in enumerate(texts)]
    return texts, wanted


def test_stretches_of_many_texts_share_a_frame():
    texts, wanted = _stretch_rows(300, 40)
    squeeze = zstandard.ZstdCompressor().compress
    batch = pd.DataFrame({"packed": [squeeze(t) for t in texts], "wanted": wanted})
    frames = list(long_matches._cut(iter([batch.iloc[:150], batch.iloc[150:]]), 40))
    assert len(frames) == 1 and frames[0]["data"].tolist() == [t[1:] for t in texts]
    assert frames[0]["key"].tolist() == list(range(300)) and frames[0]["content"].tolist() == [-i for i in range(300)]


def test_windows_of_many_stretches_share_a_frame(monkeypatch):
    texts, _ = _stretch_rows(60, 40)
    batch = pd.DataFrame({"key": range(60), "content": [-i for i in range(60)], "alone": [i % 2 == 0 for i in range(60)], "data": texts})
    expected = [
        (*np.frombuffer(xxhash.xxh3_128_digest(t[at : at + 40]), np.int64).tolist(), i, -i, i % 2 == 0, at)
        for i, t in enumerate(texts) for at in range(len(t) - 39)
    ]
    columns = ["w1", "w2", "key", "content", "alone", "low"]
    for most, frames in ((50_000, 1), (1000, 3)):
        monkeypatch.setattr(long_matches, "_FRAME_WINDOWS", most)
        got = list(long_matches._windowed(iter([batch]), 40))
        assert len(got) == frames
        assert [tuple(r) for f in got for r in f[columns].itertuples(index=False)] == expected


def test_marks_of_a_block_stay_within_their_stretch():
    shared = bytes(range(97, 123)) * 2
    strings = [b"1" + shared, shared + b"2", b"x" * 30 + bytes(range(30)), shared]
    batch = pd.DataFrame({"key": [1, 1, 2, 3], "content": [5, 6, 7, 8], "alone": [True, False, True, True], "data": strings})
    (got,) = long_matches._indexed(iter([batch]), 40, 1 << 20)
    assert [tuple(r) for r in got[["key", "content", "low", "high"]].itertuples(index=False)] == [(1, 5, 1, 14), (3, 8, 0, 13)]
