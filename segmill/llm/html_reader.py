"""Pages of HTML as blocks of text within block-level elements, in time linear in the page.

A page may be unfinished or malformed anywhere: every character is looked at a bounded number of times.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from html import unescape

# What HTML says of its elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rb rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre search section table ul".split()
)
SIBLINGS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "option": "option optgroup", "tr": "tr td th", "td": "td th", "th": "td th"}
SCOPES = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "option": "select", "tr": "table", "td": "tr table", "th": "tr table"}

# What is never article text.
ZONES = set(
    "head script style noscript template nav footer aside form button select textarea input iframe object svg canvas audio video "
    "dialog menu search".split()
)
ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
MARKS = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar nav navbar "
    "navigation menu breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social related recommended recommendations comment comments disqus respond "
    "replies widget toolbar pagination pager search skip hidden".split()
)
#: Whole classes, outside of articles and inside.
WHOLE_MARKS = set("header site-header page-header top-header site-footer page-footer".split())
SITE_MARKS = set("site-header top-header site-footer page-footer".split())
P_SCOPE = set("article section div td th li blockquote body button table figure".split())

#: Words that say nothing of the content beside a mark: ``comment-list`` is a list of comments.
LAYOUT = set(
    "area areas box boxes list lists slot slots wrapper wrap container item items block blocks unit units panel panels bar bars row rows col "
    "column columns inner outer top bottom left right side site page section title heading head header body content post posts entry entries article articles main "
    "form button buttons link links icon icons text label image holder frame group field module region sticky fixed mobile desktop "
    "primary secondary wide full inline thread reply tabs".split()
)
#: Classes that show that a part of a page is written by readers.
READERS = set("author commenter date time timestamp avatar reply byline vcard comment comments".split())
#: Elements whose content is text up to their end tag, without and with character references.
RAW = set("script style xmp iframe noembed noframes".split())
REFERENCES_ONLY = set("textarea title".split())

HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Zones that say nothing about the layout of a page.
UNSEEN = set("head script style noscript template iframe object svg canvas audio video".split())

_SPLIT = re.compile(r"[\s_\-:]+|(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_GAP = re.compile(r"[\s/]*")
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*)(\s*=\s*)?")
_UNQUOTED = re.compile(r"[^\s>]*")


class _Scanner:
    """Calls ``start(tag, attributes)``, ``end(tag)`` and ``data(text)`` for the markup of a page.

    A tag without its ``>`` and a comment, script or style without its end take the rest of the page, as in browsers.
    A quoted value without its second quote ends with its tag.
    """

    def __init__(self, html: str) -> None:
        self.html, self.missing = html, set()

    def find(self, what: str, at: int) -> int:
        """The next place of ``what``. Once it is not found it is not looked for again, since places only grow."""
        place = -1 if what in self.missing else self.html.find(what, at)
        if place < 0:
            self.missing.add(what)
        return place

    def attributes(self, at: int) -> tuple[dict[str, str], int]:
        """The attributes of the tag whose name ends at ``at``, and where it ends. There is a ``>`` behind."""
        html, found = self.html, {}
        while True:
            at = _GAP.match(html, at).end()
            if at >= len(html):
                return found, at
            if html[at] == ">":
                return found, at + 1
            name = _ATTRIBUTE.match(html, at)
            at, value = name.end(), ""
            if name[2]:
                quote = html[at : at + 1]
                if quote in ('"', "'") and quote:
                    close = self.find(quote, at + 1)
                    if close < 0:
                        close = html.find(">", at)
                        close = len(html) if close < 0 else close
                        value, at = html[at + 1 : close], close
                    else:
                        value, at = html[at + 1 : close], close + 1
                else:
                    plain = _UNQUOTED.match(html, at)
                    value, at = plain[0], plain.end()
            found.setdefault(name[1].lower(), unescape(value))

    def run(self, start: Callable, end: Callable, data: Callable) -> None:
        html, at, shown = self.html, 0, 0
        last = html.rfind(">")
        while True:
            at = html.find("<", at)
            after = html[at + 1 : at + 2]
            if at >= 0 and not (after.isascii() and after.isalpha()) and after not in ("/", "!", "?"):
                at += 1
                continue
            if at < 0 or not after:
                if html[shown:]:
                    data(unescape(html[shown:]))
                return
            if html[shown:at]:
                data(unescape(html[shown:at]))
            if html.startswith("<!--", at):
                close = at + 5 if html.startswith("<!-->", at) else self.find("-->", at + 4) + 3
                if close < 3:
                    return
                at = close
            elif at > last:
                return
            elif after in ("!", "?") or (after == "/" and not _NAME.match(html, at + 2)):
                at = html.find(">", at) + 1
            elif after == "/":
                name = _NAME.match(html, at + 2)
                at = html.find(">", name.end()) + 1
                end(name[0].lower())
                if not at:
                    return
            else:
                name = _NAME.match(html, at + 1)
                tag = name[0].lower()
                attributes, at = self.attributes(name.end())
                if html[at - 1 : at] != ">":
                    return
                start(tag, attributes)
                if tag in RAW or tag in REFERENCES_ONLY:
                    at = self.content(tag, at, end, data)
                    if at < 0:
                        return
            shown = at

    def content(self, tag: str, at: int, end: Callable, data: Callable) -> int:
        """Behind the content of a raw element and its end tag; -1 if it has none. An unfinished title or text area is read as markup."""
        close = None if f"</{tag}" in self.missing else re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(self.html, at)
        if close is None:
            self.missing.add(f"</{tag}")
            return at if tag in REFERENCES_ONLY else -1
        text = self.html[at : close.start()]
        if text:
            data(unescape(text) if tag in REFERENCES_ONLY else text)
        end(tag)
        behind = self.html.find(">", close.end())
        return -1 if behind < 0 else behind + 1


@dataclass
class Block:
    """Text between two block boundaries, in the element ``node``, with the characters inside links."""

    node: int
    path: int
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


@dataclass
class Node:
    """A block-level element: its blocks are those from ``first`` to before ``end``."""

    tag: str
    parent: int
    depth: int
    path: int
    article: bool = False
    zoned: bool = False
    doubtful: bool = False
    anchor: str = ""
    readers: bool = False
    first: int = 0
    end: int = 0


@dataclass
class _Open:
    """An element on the stack; ``node`` is the block-level element that text in it belongs to."""

    tag: str
    node: int
    blocks: int
    dropped: bool
    in_article: bool
    in_link: bool


def _parts(name: str) -> list[str]:
    return [p.lower() for p in _SPLIT.split(name) if p]


def _is_mark(name: str) -> bool:
    """Whether a class or id says what an element is for: a mark, with nothing but marks and words of layout beside it."""
    parts = _parts(name)
    return any(p in MARKS for p in parts) and all(p in MARKS or p in LAYOUT or p.isdigit() for p in parts)


def _is_zone(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    if tag in ZONES or (tag == "header" and not in_article) or "hidden" in attributes:
        return True
    value = lambda name: attributes.get(name) or ""
    if value("aria-hidden") == "true" or value("role").lower() in ROLES or _HIDDEN.search(value("style")):
        return True
    if tag in ("html", "body"):
        return False
    classes = value("class").split()
    marks = {m for name in (*classes, value("id")) for m in _parts(name)}
    if in_article and tag not in ("article", "main"):
        return tag not in INLINE and any(_is_mark(c) or c.lower() in SITE_MARKS for c in classes)
    if tag in HEADINGS:
        return bool({m for c in classes for m in _parts(c)} & MARKS)
    if tag in ("article", "main"):
        return bool(marks & {"comment", "comments", "ad", "advert", "sponsored", "related", "promo"})
    return bool(marks & MARKS or WHOLE_MARKS & {c.lower() for c in (*classes, *value("id").split())})


def _is_doubtful(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether a part of a class or id within an article is a mark: then its text decides."""
    if not in_article or tag in INLINE or tag in ("html", "body", "article", "main"):
        return False
    names = [*(attributes.get("class") or "").split(), *([] if tag in HEADINGS or tag == "section" else (attributes.get("id") or "").split())]
    return bool({m for name in names for m in _parts(name)} & MARKS or WHOLE_MARKS & {n.lower() for n in names})


class Reader:
    """The elements and blocks of a page outside its zones."""

    def __init__(self, html: str) -> None:
        self.nodes = [Node("", -1, 0, 0)]
        self.blocks: list[Block] = []
        self.paths: dict[tuple[int, str], int] = {(-1, ""): 0}
        self.stack: list[_Open] = [_Open("", 0, 0, False, False, False)]
        self.places: dict[str, list[int]] = {}  # of the open elements of each tag on the stack
        self.open: Block | None = None
        _Scanner(html).run(self.start, self.end, self.data)
        self._drop_from(0)

    def _last(self, tags: str) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def _close_to(self, tags: set[str], stop: set[str] = frozenset()) -> None:
        place = self._last(tags)
        if place >= 0 and place >= self._last(stop):
            self._drop_from(place)
            self.open = None

    def _drop_from(self, place: int) -> None:
        while len(self.stack) > place:
            element = self.stack.pop()
            if element.tag:
                self.places[element.tag].pop()
            below = self.stack[-1].node if self.stack else -1
            if element.node != below:
                node = self.nodes[element.node]
                node.end = len(self.blocks)
                if below >= 0:
                    self.nodes[below].zoned |= node.zoned
                    self.nodes[below].readers |= node.readers

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        if tag in CLOSES_P:
            self._close_to({"p"}, P_SCOPE)
        if tag in SIBLINGS:
            self._close_to(set(SIBLINGS[tag].split()), set(SCOPES[tag].split()))
        if tag in VOID:
            if tag == "br":
                self.data("\n")
            elif tag not in INLINE:
                self.open = None
            return
        above = self.stack[-1]
        number, inline = above.node, tag in INLINE
        dropped = above.dropped or _is_zone(tag, attributes, above.in_article)
        article = tag in ("article", "main") or (attributes.get("role") or "").lower() == "main"
        holder = self.nodes[above.node]
        if dropped and not above.dropped and tag not in UNSEEN:
            holder.zoned = True
        if tag == "time" or READERS.intersection(_parts(attributes.get("class") or "")):
            holder.readers = True
        if not inline:
            self.open = None
            path = self.paths.setdefault((holder.path, tag), len(self.paths))
            number = len(self.nodes)
            node = Node(tag, above.node, holder.depth + 1, path, article, first=len(self.blocks))
            if not dropped and above.in_article and tag not in HEADINGS and _is_mark(attributes.get("id") or ""):
                node.anchor = attributes["id"]
            node.doubtful = not dropped and _is_doubtful(tag, attributes, above.in_article)
            self.nodes.append(node)
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append(_Open(tag, number, above.blocks + (not inline), dropped, above.in_article or article, above.in_link or tag == "a"))

    def end(self, tag: str) -> None:
        if not self.places.get(tag):
            return
        place = self.places[tag][-1]
        if self.stack[-1].blocks > self.stack[place - 1].blocks:
            if tag in INLINE:
                return  # an inline end tag does not close the blocks opened since
            self.open = None
        self._drop_from(place)

    def data(self, text: str) -> None:
        above = self.stack[-1]
        if above.dropped:
            return
        if self.open is None:
            if not text.strip():
                return
            self.open = Block(above.node, self.nodes[above.node].path)
            self.blocks.append(self.open)
        self.open.parts.append(text)
        if above.in_link:
            self.open.linked += len("".join(text.split()))
