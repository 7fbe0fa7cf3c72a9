"""Plain-Python answers for the operators."""

from __future__ import annotations

import re
from collections import Counter


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def word_shingles(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def char_shingles(text, k=8):
    return frozenset(text[i : i + k] for i in range(max(1, len(text) - k + 1)))


def components(sets, percent):
    """{id: smallest id linked to it} of {id: set}."""
    parent = {x: x for x in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for x in sorted(sets):
        common = Counter(y for item in sets[x] for y in holders.get(item, ()))
        for y, n in common.items():
            if 100 * n >= percent * (len(sets[x]) + len(sets[y]) - n):
                a, b = find(x), find(y)
                parent[max(a, b)] = min(a, b)
        for item in sets[x]:
            holders.setdefault(item, []).append(x)
    return {x: find(x) for x in sets}


def line_classes(rows, k=8, percent=80):
    """{(doc, line): kept (doc, line)}"""
    places = {}
    for doc, text in rows:
        for at, line in enumerate((text or "").split("\n")):
            line = line.strip(" \t\r\x0b\x0c")
            if line and doc is not None:
                places.setdefault(line, []).append((doc, at))
    bodies = sorted(places, key=lambda line: min(places[line]))
    found = components({i: char_shingles(body, k) for i, body in enumerate(bodies)}, percent)
    return {place: min(places[bodies[found[i]]]) for i, body in enumerate(bodies) for place in places[body]}


def secrets(text):
    """(start, kind number, end) of the base kinds."""
    text = text or ""
    assign = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text, re.ASCII) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)
