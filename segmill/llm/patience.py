"""License scan by patience alignment of texts with license templates.

Around the words that a template does not share with everyday text, a stretch of the text is
aligned with it: words unique to both are anchors, their longest increasing subsequence is
kept, and the gaps between are aligned the same way, with words now unique within the gap. The share of
the template's words that find a partner is the coverage.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmill.llm.common import ROW, bounded_batches, pack, unpack

#: Least coverage of a template.
COVERAGE = 0.8
# License texts and notices, as their authors publish them.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission
notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT
WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES
OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD3 = _BSD2 + """ Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable
law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
limitations under the License."""
_GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU{} General Public
License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."""
_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin
of this software must not be misrepresented; you must not claim that you wrote the original software."""
_BOOST = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying
documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software"""
_WTFPL = """Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed
as long as the name is changed."""
_EPL = """This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"""
_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
commercial or non-commercial, and by any means."""
TEMPLATES = {
    "MIT": [_MIT, "Released under the MIT License", "Licensed under the MIT License"],
    "BSD-2-Clause": [_BSD2, "Licensed under the BSD 2-Clause License"],
    "BSD-3-Clause": [_BSD3, "Licensed under the BSD 3-Clause License"],
    "ISC": [_ISC, "Licensed under the ISC License"],
    "Apache-2.0": [_APACHE, "Licensed under the Apache License, Version 2.0", "Released under the Apache License 2.0"],
    "GPL-2.0": [_GPL.format("", 2), "This work is licensed under the GNU General Public License, version 2"],
    "GPL-3.0": [_GPL.format("", 3), "This work is licensed under the GNU General Public License, version 3"],
    "LGPL-3.0": [_GPL.format(" Lesser", 3), "This work is licensed under the GNU Lesser General Public License, version 3"],
    "AGPL-3.0": [_GPL.format(" Affero", 3), "This work is licensed under the GNU Affero General Public License, version 3"],
    "MPL-2.0": [_MPL, "Licensed under the Mozilla Public License, Version 2.0"],
    "Unlicense": [_UNLICENSE],
    "Zlib": [_ZLIB],
    "BSL-1.0": [_BOOST, "Distributed under the Boost Software License, Version 1.0"],
    "WTFPL": [_WTFPL, "Do What The Fuck You Want To Public License"],
    "EPL-2.0": [_EPL],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0 license"],
    **{
        f"CC-{kind}-4.0": [
            f"Licensed under CC {kind} 4.0",
            f"This work is licensed under a Creative Commons {name} 4.0 International License",
        ]
        for kind, name in {
            "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
            "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
            "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
        }.items()
    },
}
#: Everyday words, which do not mark the place of a template.
COMMON = set("a an and any are as at be but by can for from if in is it its no not of on or that the this to under was with you".split())

_WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Template:
    """``signals`` are words of the template by which it is looked for, more than a copy may lack."""

    license: str
    words: tuple[str, ...]
    signals: frozenset[str]

    def spare(self, least: float) -> int:
        """Words that a copy of coverage ``least`` may lack."""
        return int(len(self.words) - least * len(self.words) + 1e-9)

    def need(self, least: float) -> int:
        """Signals that it holds at least: each word that it lacks is one of them at most."""
        return max(1, len(self.signals) - self.spare(least))


def _template(license: str, text: str) -> Template:
    words = tuple(_WORD.findall(text.lower()))
    counts = Counter(words)
    once = {w for w, n in counts.items() if n == 1}
    # Short or repetitive templates have few rare words: then all that occur once are signals, or all there are.
    signals = next((c for c in (once - COMMON, once) if len(c) > 0.3 * len(words)), set(counts))
    return Template(license, words, frozenset(signals))


def templates(texts: dict[str, list[str]] = TEMPLATES) -> list[Template]:
    """Every text and the SPDX tag of every license."""
    tags = {name: [f"SPDX-License-Identifier: {name}"] for name in texts}
    return [_template(name, t) for group in (texts, tags) for name, listed in group.items() for t in listed]


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, sorted by the first number, whose second numbers rise."""
    tops: list[int] = []
    at: list[int] = []
    before = [-1] * len(pairs)
    for i, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        before[i] = at[pile - 1] if pile else -1
        tops[pile : pile + 1], at[pile : pile + 1] = [b], [i]
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def align(text: list[str], template: tuple[str, ...] | list[str]) -> list[tuple[int, int]]:
    """Matched positions (text, template), both rising."""
    out: list[tuple[int, int]] = []
    ranges = [(0, len(text), 0, len(template))]
    while ranges:
        a, b, c, d = ranges.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        ours, theirs = Counter(text[a:b]), Counter(template[c:d])
        unique = {w for w, n in theirs.items() if n == 1 and ours.get(w) == 1}
        if not unique:
            # Nothing to anchor on: all pairs of equal words, of which the longest rising run is the best alignment.
            spots: dict[str, list[int]] = {}
            for j in range(d - 1, c - 1, -1):
                spots.setdefault(template[j], []).append(j)
            out += _increasing([(i, j) for i in range(a, b) for j in spots.get(text[i], ())])
            continue
        place = {w: j for j, w in enumerate(template[c:d], c) if w in unique}
        anchors = _increasing([(i, place[w]) for i, w in enumerate(text[a:b], a) if w in unique])
        out += anchors
        edges = [(a - 1, c - 1), *anchors, (b, d)]
        ranges += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


def _stretches(words: list[str], template: Template, where: dict[str, list[int]]) -> Iterator[tuple[int, int]]:
    """Stretches of text around signals that lie close together; a signal that comes again begins a new one."""
    spots = sorted((i, w) for w in template.signals for i in where.get(w, ()))
    reach, floor = len(template.words), 0
    group: list[tuple[int, str]] = []
    for spot in [*spots, None]:
        again = spot is not None and any(w == spot[1] for _, w in group)
        if group and (spot is None or again or spot[0] - group[-1][0] > reach):
            last = group[-1][0]
            yield max(floor, group[0][0] - reach), min(len(words), spot[0] if again else last + reach + 1)
            floor, group = last + 1 if again else floor, []
        if spot is not None:
            group.append(spot)


def _around(words: list[str], template: Template, where: dict[str, list[int]], least: float) -> Iterator[tuple[int, int]]:
    """Stretches, which may overlap, where the template would lie by its rarest signals: without slack, with a quarter and with its length.

    A copy lacks at most ``spare`` of the template's words, so it holds one of any ``spare + 1`` signals.
    """
    n, need = len(template.words), template.need(least)
    rarest = sorted(template.signals, key=lambda w: (len(where.get(w, ())), w))[: template.spare(least) + 1]
    spots = sorted((i, w) for w in template.signals for i in where.get(w, ()))
    places = [i for i, _ in spots]
    starts = sorted({i - template.words.index(w) for w in rarest for i in where.get(w, ())})
    at = 0
    while at < len(starts):
        first = last = starts[at]
        while at < len(starts) and starts[at] - first <= n // 4:
            last, at = starts[at], at + 1
        for slack in (0, n // 4, n):
            begin, end = max(0, first - slack), min(len(words), last + n + slack)
            held = {w for _, w in spots[bisect_left(places, begin) : bisect_left(places, end)]}
            if len(held) >= need:
                yield begin, end


def find_licenses(text: str | None, known: list[Template], least: float = COVERAGE) -> list[tuple[str, float, int, int, int, int]]:
    """(license, coverage, matched words, template words, start, end) of a whole text, in order of place.

    Of finds that overlap, the one with more matched words stays, then the one of higher
    coverage, then the shorter. Start and end are code points. A null or empty text holds nothing.
    """
    if not text:
        return []
    low = text.lower()
    signals = set().union(*(t.signals for t in known))
    if signals.isdisjoint(_WORD.findall(low)):
        return []
    tokens = list(_WORD.finditer(low if len(low) == len(text) else text))
    words = [m[0].lower() for m in tokens]
    where: dict[str, list[int]] = {}
    for i, w in enumerate(words):
        if w in signals:
            where.setdefault(w, []).append(i)
    found = set()
    for t in known:
        if len(t.signals & where.keys()) < t.need(least):
            continue
        for begin, end in {*_stretches(words, t, where), *_around(words, t, where, least)}:
            pairs = align(words[begin:end], t.words)
            if pairs and len(pairs) >= least * len(t.words):
                first, last = tokens[begin + pairs[0][0]], tokens[begin + pairs[-1][0]]
                found.add((t.license, len(pairs) / len(t.words), len(pairs), len(t.words), first.start(), last.end()))
    kept: list[tuple[int, tuple[str, float, int, int, int, int]]] = []  # by place; they do not overlap
    for f in sorted(found, key=lambda f: (-f[2], -f[1], f[5] - f[4], f[4], f[0])):
        at = bisect_left(kept, (f[4],))
        if (at == 0 or kept[at - 1][1][5] <= f[4]) and (at == len(kept) or f[5] <= kept[at][0]):
            kept.insert(at, (f[4], f))
    return [f for _, f in kept]


def scan_licenses(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, texts: dict[str, list[str]] | None = None, least: float = COVERAGE
) -> DataFrame:
    """One row per license text or notice in a document, with the document's columns ``keep`` (all by default).

    Adds ``license, coverage, n_matched, n_template, start, end``, which replace kept columns
    of the same name. Null and empty texts give no row, repeated rows are each reported, and an empty table gives an
    empty one. One pass, no shuffle.
    """
    bounded_batches(docs.sparkSession)
    known = templates(TEMPLATES if texts is None else texts)
    keep = docs.columns if keep is None else keep

    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([[tuple(f) for f in find_licenses(t, known, least)] for t in batch], dtype=object)

    scanned.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    kind = "array<struct<license:string,coverage:double,n_matched:long,n_template:long,start:long,end:long>>"
    source = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text])])
    packed = pack(source, found=F.pandas_udf(scanned, kind)(source[f"`{text}`"]))
    kept = F.struct(*[F.col(ROW).getField(c).alias(c) for c in keep]).alias(ROW)
    rows = packed.select(kept, F.explode("found").alias("f")).select(ROW, "f.*")
    return unpack(rows, "license", "coverage", "n_matched", "n_template", "start", "end")
