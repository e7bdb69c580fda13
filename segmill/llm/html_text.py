"""Main text of web pages by tag-path ratios.

A page is read into blocks, each with its path of tags from the root. Zones that are never
article text (menus, headers, footers, sidebars, notices, adverts, forms, scripts, comments of
readers) are told by tag, role, class and id. Within an article a class tells if it holds a mark and otherwise
only marks and words of layout (``comment-list``, ``ad-slot``); an id of that kind does too, unless the element opens
with that very title and nothing in it is signed or dated by readers. Where another part of a class or id is a mark, links and
punctuation decide. For the other blocks, text length and
punctuation are summed per tag path and divided by the number of blocks, smoothed over
neighbouring paths and multiplied; paths above one standard deviation hold content. The
smallest element that holds nearly all of that content is a seed: the main text is every block of
the article or main around it, or else of the highest element around it that adds no zone and no links.
All of it takes time linear in the page.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from segmill.llm.html_reader import Block, Node, Reader

#: Share of the content that the seed must hold.
HELD = 0.9
_PUNCTUATION = re.compile(r"[.,;:!?…。，、؟¿¡]")
_WORDS = re.compile(r"[^\W_]+")


def _sums(values: list[float]) -> np.ndarray:
    return np.concatenate([[0.0], np.cumsum(np.array(values, float))])


def _chars(block: Block) -> int:
    return len(block.text) - block.text.count(" ")


def _marks(block: Block) -> int:
    return len(_PUNCTUATION.findall(block.text))


def read_page(html: str | None) -> tuple[list[Node], list[Block]]:
    """Elements, and blocks outside the zones in page order; none of either for a null or empty page."""
    if not html:
        return [], []
    reader = Reader(html)
    nodes, blocks = reader.nodes, reader.blocks
    for b in blocks:
        b.text = " ".join("".join(b.parts).split())
    chars, linked, marks = (_sums([f(b) for b in blocks]) for f in (_chars, lambda b: b.linked, _marks))
    kept = np.array([bool(b.text) for b in blocks], bool)
    for n in nodes:
        size, links, signs = (x[n.end] - x[n.first] for x in (chars, linked, marks))
        low = n.doubtful and size and (links >= 0.5 * size or not signs)
        if low or (n.anchor and not _is_titled(n, blocks)):
            kept[n.first : n.end] = False
    place = np.concatenate([[0], np.cumsum(kept)])
    for n in nodes:
        n.first, n.end = int(place[n.first]), int(place[n.end])
    return nodes, [b for b, k in zip(blocks, kept.tolist()) if k]


def _is_titled(node: Node, blocks: list[Block]) -> bool:
    """Whether the element's first text is its id spelt out, and no reader wrote in it."""
    title = next((b.text for b in blocks[node.first : node.end] if b.text), "")
    return not node.readers and _WORDS.findall(title.lower()) == _WORDS.findall(node.anchor.lower())


def path_scores(blocks: list[Block]) -> dict[int, float]:
    """Smoothed text and punctuation per block of every tag path, multiplied."""
    order = list(dict.fromkeys(b.path for b in blocks))
    place = {p: i for i, p in enumerate(order)}
    at = np.array([place[b.path] for b in blocks])
    plain = np.array([max(len(b.text) - b.linked, 0) for b in blocks], float)
    marks = np.array([_marks(b) for b in blocks], float)
    number = np.bincount(at, minlength=len(order))
    ratios = []
    for values in (plain, marks):
        ratio = np.bincount(at, values, len(order)) / number
        spread = np.pad(ratio, 1, mode="edge")
        ratios.append(0.1 * spread[:-2] + 0.8 * spread[1:-1] + 0.1 * spread[2:])
    fused = ratios[0] * (1 + ratios[1])
    return {p: float(fused[i]) for p, i in place.items()}


def _has_links_only(blocks: list[Block]) -> bool:
    """Whether half the characters or more of a tag path are links."""
    linked, chars = Counter(), Counter()
    for b in blocks:
        linked[b.path] += b.linked
        chars[b.path] += _chars(b)
    return any(linked[p] and linked[p] >= 0.5 * chars[p] for p in chars)


def _region(seed: int, nodes: list[Node], blocks: list[Block]) -> int:
    """The nearest article or main around the seed, or the highest element that adds no zone and no link-heavy path."""
    around = [seed]
    while nodes[around[-1]].parent >= 0:
        around.append(nodes[around[-1]].parent)
    for e in around:
        if nodes[e].article:
            return e
    region = seed
    for e in around[1:]:
        added = blocks[nodes[e].first : nodes[region].first] + blocks[nodes[region].end : nodes[e].end]
        if nodes[e].zoned or _has_links_only(added):
            break
        region = e
    return region


def main_text(html: str | None) -> str:
    """The article's blocks, joined by line feeds; empty if there is none."""
    nodes, blocks = read_page(html)
    if not blocks:
        return ""
    scores = path_scores(blocks)
    values = np.array(list(scores.values()))
    least = min(values.std(), values.max()) if len(values) > 1 else 0.0
    weight = _sums([max(len(b.text) - b.linked, 0) if scores[b.path] >= least else 0 for b in blocks])
    held = np.array([weight[n.end] - weight[n.first] for n in nodes])
    content = blocks
    if weight[-1]:
        # Elements that hold so much lie in each other.
        chosen = max(np.flatnonzero(held >= HELD * weight[-1]).tolist(), key=lambda e: nodes[e].depth)
        node = nodes[chosen]
        content = blocks[node.first : node.end]
        if node.depth and len(blocks) > 1 and node.tag in ("p", "h1", "h2", "h3", "li", "pre", "blockquote") and all(b.node == chosen for b in content):
            chosen = node.parent  # a lone paragraph stands for its parent
        region = nodes[_region(chosen, nodes, blocks)]
        content = blocks[region.first : region.end]
        if region.article:
            return "\n".join(b.text for b in content)
    kept = [b.text for b in content if not (b.linked and b.linked >= 0.8 * _chars(b) and nodes[b.node].tag in ("li", "ul", "ol"))]
    return "\n".join(kept)


def extract(html: Column) -> Column:
    """Main text of whole pages, each by itself: equal pages have equal texts, whatever other columns there are.

    Empty for a null or empty page and one without text; a page of any length and depth is read whole.
    """

    def extracted(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in pages:
            yield pd.Series([main_text(p) for p in batch], dtype=object)

    extracted.__annotations__ = {"pages": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(extracted, "string")(html)
