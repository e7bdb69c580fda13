"""Main text of pages: what goes and what stays, pages of many layouts, malformed and deep pages in linear time."""

import time

import pytest

from segmill.llm import html_text

LONG = "<p>" + "A long sentence, with marks and words, goes on here. " * 30 + "</p>"
NAV = '<nav><a href="/">Home, of the site.</a></nav>'


def in_html(inner, around):
    close = "</article></main" if "><" in around else f"</{around.split()[0]}"
    return f"<html><body>{NAV}<{around}>{LONG}{inner}{LONG}{close}><footer>Made, by us.</footer></body></html>"


DROPPED = [
    "<section id=comments class=comments-area><h2>Comments</h2><p>GONE, I say.</p></section>",
    "<section id=comments><h2>Comments</h2><div class=comment-author>GONE, Ann.</div><p>GONE, I say.</p></section>",
    "<div id=respond><h3>Leave a word</h3><p>GONE, please.</p></div>",
    "<section id=respond><h3>Respond</h3><p><time>GONE, today.</time></p></section>",
    "<ol class=comment-list><li>GONE, I say.</li></ol>",
    "<div class=cookie-banner><p>GONE, we use them.</p></div>",
    "<div class='ad-slot wide'>GONE, buy it.</div>",
    "<div class='box newsletter-signup'>GONE, sign up.</div>",
    "<div class=sidebar-box>GONE, aside.</div>",
    "<div class=site-notice>GONE, take note.</div>",
    "<p class=advert-text>GONE, buy it.</p>",
    "<div class=site-header><p>GONE, the site.</p></div>",
    "<ul class=menu-items><li>GONE, one.</li></ul>",
    "<div class=relatedPosts><p>GONE, more.</p></div>",
    "<div id=ad-1>GONE, buy it.</div>",
    "<div role=complementary>GONE, aside.</div>",
    "<div hidden>GONE, unseen.</div>",
    "<div style='color:red; display : none'>GONE, unseen.</div>",
    "<form><p>GONE, fill in.</p></form>",
    "<script>var GONE = '<p>GONE, text.</p>';</script>",
    "<noscript>GONE, no script.</noscript>",
    "<!-- GONE, <p>hidden</p> -->",
]
KEPT = [
    "<section id=related-work><h2>Work</h2><p>KEPT, as said.</p></section>",
    "<section id=search><h2>Search</h2><p>KEPT, as said.</p></section>",
    "<h2 id=search>KEPT, search</h2>",
    "<h2 id=search-algorithms>KEPT, search</h2>",
    "<div id=social-history><p>KEPT, as said.</p></div>",
    "<section id=comments-on-the-method><p>KEPT, as said.</p></section>",
    "<p class=notice-period>KEPT, four weeks.</p>",
    "<p>Choose <span class=menu>KEPT, File</span> there.</p>",
    "<div class=shared-memory><p>KEPT, as said.</p></div>",
    "<header><h1>KEPT, title</h1></header>",
    "<section><p>KEPT, one.</p></section>",
    "<table><tr><td>KEPT, cell.</td></tr></table>",
    "<pre>KEPT, code</pre>",
    "<blockquote>KEPT, said.</blockquote>",
    "<div class=adventure><p>KEPT, a trip.</p></div>",
]


@pytest.mark.parametrize("around", ["article", "main", "main><article", "div role=main"])
@pytest.mark.parametrize("inner", DROPPED)
def test_what_goes(inner, around):
    text = html_text.main_text(in_html(inner, around))
    assert "GONE" not in text and "Home" not in text and "Made" not in text and text.count("A long") == 60


@pytest.mark.parametrize("around", ["article", "main", "main><article", "div role=main"])
@pytest.mark.parametrize("inner", KEPT)
def test_what_stays(inner, around):
    text = html_text.main_text(in_html(inner, around))
    assert "KEPT" in text and "Home" not in text and "Made" not in text


A, B = "The first one, in full, is here.", "The second one, too, is long enough."
LAYOUTS = [
    f"<article><h1>T</h1><p>{A}</p><p>{B}</p></article>",
    f"<main><h1>T</h1><p>{A}</p><p>{B}</p></main>",
    f"<div id=content><h1>T</h1><p>{A}</p><p>{B}</p></div>",
    f"<div><div><h1>T</h1></div><div><p>{A}</p><p>{B}</p></div></div>",
    f"<nav><a>x</a></nav><article><h1>T</h1><p>{A}<p>{B}</article><footer>f, f.</footer>",
    f"<table><tr><td><a>m</a></td><td><h1>T</h1><p>{A}</p><p>{B}</p></td></tr></table>",
    f"<article><header><h1>T</h1></header><section><p>{A}</p></section><section><p>{B}</p></section></article>",
    f"<article><h1>T</h1><div class=text>{A}<br></div><div>{B}</div></article>",
    f"<ARTICLE><H1>T</H1><P>{A}</P><P>{B}</P></ARTICLE>",
    f"<article><h1>T</h1><p>{A}</p><aside>no, no.</aside><p>{B}</p></article>",
    f"<article><h1>T</h1><p>{A}</p><figure><img src=x></figure><p>{B}</p></article>",
    f"<article><h1>T</h1><p>{A}</p><!-- <p>no, no.</p> --><p>{B}</p></article>",
    f"<article><h1>T</h1><p>{A}</p><script>if (a < b) x('</p>')</script><p>{B}</p></article>",
    f"<article><h1>T</h1><ul><li>{A}<li>{B}</ul></article>",
    f"<article><h1>T</h1><dl><dt>{A}<dd>{B}</dl></article>",
    f"<article><h1>T</h1><p><b>{A[:9]}</b>{A[9:]}</p><p>{B[:5]}<i>{B[5:]}</i></p></article>",
    f"<article><h1>T</h1><p title='a > b'>{A}</p><p data-x=\"<p>\">{B}</p></article>",
    f"<article><h1>T</h1><p>{A}</p><div class=comments><p>no, no.</p></div><p>{B}</p></article>",
    f"<body class=has-sidebar><article><h1>T</h1><p>{A}</p><p>{B}</p></article>",
    f"<article><h1>T</h1><p>{A}</p></section></div><p>{B}</p></article>",
    f"<?xml version='1'?><!DOCTYPE html><article><h1>T</h1><p>{A}</p></><p>{B}</p></article>",
    f"<title>no, no</title><article><h1 >T</h1 ><p\n>{A}</p><p/>{B}</article>".replace("<title>no, no</title>", "<head><title>no, no</title></head>"),
]


@pytest.mark.parametrize("html", LAYOUTS)
def test_layouts(html):
    assert html_text.main_text(html) == f"T\n{A}\n{B}"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<article>a &lt;b&gt; &amp;amp; &#65;&#x42; &nbsp; x</article>", "a <b> &amp; AB x"),
        ("<article>a < b and 5 <3, yes</article>", "a < b and 5 <3, yes"),
        ("<article><p>one, a<p>two, b<unfinished", "one, a\ntwo, b"),
        ("<article><p>one, a<p title='x>two, b</p></article>", "one, a\ntwo, b"),
        ("<article><p>one, a<!-- the rest <p>two, b", "one, a"),
        ("<article><p>one, a<script>x <p>two, b", "one, a"),
        ("<article><p>one, a</p><", "one, a\n<"),
        ("<article><p>one, a<p =x y>two, b", "one, a\ntwo, b"),
        ("\0<article>\0a, b</article>", "\0a, b"),
    ],
)
def test_broken_markup(html, text):
    assert html_text.main_text(html) == text


MEGABYTE = 1_000_000
MALFORMED = [
    "<a ", "<a href=\"", "<a href='x ", "<!--", "<!-- -", "</", "</a ", "<", "<![CDATA[", "<p><b>", "<div>", "</div>", "<title>", "<textarea>",
    "<b><div>", "<li><ul>", "<td><table>", "<a b=c ", "&amp", "&#", "<p", "<script", "<svg><title>", "x<p>", "<b></i>", "<div></b>", "<i><p></i>",
    "<section id=search>", "<article class=notice-x>", "<h1 id=a>", "< ", "a=\"", "<a = ", "<a / ", "\t\n ",
]


@pytest.mark.parametrize("piece", MALFORMED)
def test_malformed_megabytes_take_linear_time(piece):
    start = time.process_time()
    html_text.main_text("<article><p>one, a</p>" + piece * (MEGABYTE // len(piece)))
    assert time.process_time() - start < 20  # of a slow machine with other work; the old reader took hours
    small = time.process_time()
    html_text.main_text("<article><p>one, a</p>" + piece * (MEGABYTE // 4 // len(piece)))
    quarter = time.process_time() - small
    assert (small - start) < 8 * quarter + 1.0


@pytest.mark.parametrize("depth", [500, 5000])
def test_deep_pages_with_many_blocks(depth):
    html = "<article>" + "<div>" * depth + "".join(f"<p>Line {i}, of many.</p>" for i in range(3000)) + "</div>" * depth + "<p>After, all.</p></article>"
    start = time.process_time()
    text = html_text.main_text(html)
    assert text.count("\n") == 3000 and text.endswith("After, all.") and time.process_time() - start < 8


def test_articles_below_any_depth_are_told_apart():
    deep = "<div>" * 2000 + f"<article>{LONG}<p>In, it.</p></article><div class=other><a href=x>Out, of it.</a></div>" + "</div>" * 2000
    text = html_text.main_text(deep)
    assert "In, it." in text and "Out" not in text
