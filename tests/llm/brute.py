"""Brute-force versions that tests compare with."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import regex


def brute_classes(texts, least=0.8):
    sets = [Counter(zip(*(w[i:] for i in range(5)), strict=False)) if len(w := toxic_words(t)) >= 5 else Counter([tuple(w)] if w else []) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = sum((sets[i] & sets[j]).values())
            if texts[i] and texts[i] == texts[j] or sets[i] and sets[j] and both >= least * sum((sets[i] | sets[j]).values()):
                parent[root(i)] = root(j)
    groups = defaultdict(set)
    for i in range(len(texts)):
        groups[root(i)].add(i)
    return {frozenset(g) for g in groups.values()}


def toxic_words(text):
    return re.findall(r"\w+", (text or "").lower())


def brute_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int), [0]])) == 1).sum())
        left = bytes(np.frombuffer(d, np.uint8)[~gone]) if d else b""
        out.append((len(d), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    return out


def filled(sizes, weights, most=3.0):
    """Targets by resharing what is above the cap until none is."""
    total, targets, open_ = float(sum(sizes)), [0.0] * len(sizes), set(range(len(sizes)))
    rest = total
    while open_:
        share = sum(weights[i] for i in open_)
        over = {i for i in open_ if rest * weights[i] / share > most * sizes[i]}
        if not over:
            for i in open_:
                targets[i] = rest * weights[i] / share
            break
        for i in over:
            targets[i] = most * sizes[i]
        rest -= sum(targets[i] for i in over)
        open_ -= over
    return targets


def brute_nearest(rows, most=5):
    """Ids of the nearest rows of every query id; rows of one id are candidates for each other."""
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for at, (q, a) in enumerate(good):
        if q % 50 == 0:
            scored = sorted(
                (-float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))), i)
                for other, (i, b) in enumerate(good)
                if other != at and len(a) == len(b)
            )
            out[q] = [i for _, i in scored[:most]]
    return out


def leak_tokens(text, units):
    """(raw, kind, may be a name) of every token; the kind of a word is the word."""
    flat = regex.sub(r"[\s\p{Z}]+", " ", text or "")
    name = r"(?<=[\p{Ll}\p{M},;:] )\p{Lu}[\p{L}\p{M}]*(?: \p{Lu}[\p{L}\p{M}]*)*"
    out, end = [], 0
    for m in regex.finditer(rf"(?<name>{name})|(?<value>\p{{N}}+(?:[.,:/]\p{{N}}+)*)|\p{{L}}[\p{{L}}\p{{M}}]*", flat):
        word = m[0].lower()
        if m["name"]:
            out.append((m[0], "ⓟ", False))
        elif m["value"]:
            out.append((m[0], "ⓝ", False))
        elif out and out[-1][1] == "ⓝ" and not flat[end : m.start()].strip(" ") and word in units:
            out.append((m[0], "ⓤ", False))
        else:
            out.append((m[0], word, bool(regex.match(r"\p{Lu}", m[0])) and not regex.search(r"[\p{L}\p{M}]$", flat[: m.start()][-1:])))
        end = m.end()
    return out


def brute_leaks(texts, items, units, width=8, coverage=0.5):
    """{(document, item): (n_windows, item_windows, n_slots, n_changed)} by trying every alignment."""
    holders = {"ⓝ", "ⓤ", "ⓟ"}

    def windows(tokens, w):
        out = defaultdict(list)
        for at in range(len(tokens) - w + 1):
            for reading in {tuple(k for _, k, _ in tokens[at : at + w]), tuple("ⓟ" if maybe else k for _, k, maybe in tokens[at : at + w])}:
                out[reading].append(at)
        return out

    documents = [leak_tokens(t, units) for t in texts]
    found, cached = {}, {}
    for item_no, item in enumerate(leak_tokens(t, units) for t in items):
        w = min(width, len(item))
        if w < 3:
            continue
        usable = {r: at for r, at in windows(item, w).items() if sum(t not in holders for t in r) >= 3}
        total, reach = len({i for places in usable.values() for i in places}), max(len(item), 16)
        for doc_no, doc in enumerate(documents):
            if (doc_no, w) not in cached:
                cached[doc_no, w] = windows(doc, w)
            lines = defaultdict(set)
            for reading, places in usable.items():
                for at in cached[doc_no, w].get(reading, ()):
                    for i in places:
                        lines[at - i].add(i)
            parts = defaultdict(list)
            for shift in lines:
                parts[1, shift // reach].append(shift)
                parts[2, (2 * shift + reach) // (2 * reach)].append(shift)
            parts = {p: shifts for p, shifts in parts.items() if len(shifts) > 1} | {(0, s): [s] for s in lines}
            results = []
            for part, shifts in parts.items():
                met = {}
                for s in sorted(shifts, key=lambda s: (-len(lines[s]), s)):
                    for i in lines[s]:
                        met.setdefault(i, s)
                if len(met) >= coverage * total:
                    results.append((*leak_slots(item, doc, met, w), len(met), part))
            if results:
                n, n_slots, n_changed, _, _ = min(results, key=lambda r: (-r[0], -r[3], r[4]))
                if n >= coverage * total:
                    found[doc_no, item_no] = (n, total, n_slots, n_changed)
    return found


def leak_slots(item, doc, met, w):
    """Windows with consistent or with equal slots, slots, and slots that differ, along the alignment ``met`` (item position to shift)."""
    slots = {}
    for i, shift in met.items():
        for at in range(i, i + w):
            raw, kind, maybe = item[at]
            here, there = raw.lower(), doc[at + shift][0].lower()
            if kind in {"ⓝ", "ⓤ", "ⓟ"} or here != there:
                slots[at, shift] = ("ⓟ" if maybe else kind, here, there)
    votes = Counter(slots.values())
    rank = lambda p: (votes[p], p[1] == p[2], p)
    one = [p for p in votes if not any(q[:2] == p[:2] and rank(q) > rank(p) for q in votes)]
    left = {p for p in one if p[0] != "ⓟ" or not any((q[0], q[2]) == (p[0], p[2]) and rank(q) > rank(p) for q in one)}
    clean = lambda bad: sum(not any((at, s) in bad for at in range(i, i + w)) for i, s in met.items())
    differ = {c for c, p in slots.items() if p[1] != p[2]}
    n = max(clean(differ), clean({c for c, p in slots.items() if p not in left}))
    return n, len({at for at, _ in slots}), len(differ)
