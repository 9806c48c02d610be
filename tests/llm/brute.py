"""Plain forms of line and substring dedup, with their bounds written out."""

from __future__ import annotations

import re


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    p = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[p + 1 :] == b[p + 1 :] or a[p + 1 :] == b[p:] or a[p:] == b[p + 1 :]


def late_lines(rows):
    """For each (doc_id, text) in order, whether its lines go: equal to an earlier one or, with 20
    characters, within one edit of an earlier one of 20."""
    first = {}
    for doc_id, text in rows:
        for k, line in enumerate(text.split("\n")):
            if re.search(r"\S", line):
                first.setdefault(line, (doc_id, k))
    long = sorted((place, line) for line, place in first.items() if len(line.strip(" ")) >= 20)
    out = []
    for doc_id, text in rows:
        own = []
        for k, line in enumerate(text.split("\n")):
            late = line in first and first[line] < (doc_id, k)
            if not late and len(line.strip(" ")) >= 20:
                late = any(place < (doc_id, k) and within_one(line, other) for place, other in long)
            own.append(late)
        out.append(own)
    return out


def tiles_of(text):
    return re.findall(r"[^.!?\n]*[.!?\n]+[ \t]*|[^.!?\n]+", text)


def plain(unit):
    return " ".join(unit.lower().split())


def late_units(rows):
    """For each (doc_id, text) in order, whether its units go."""

    def content(text):
        own = [plain(t) for t in tiles_of(text)]
        sizes = [len(p.split()) for p in own]
        long = [n >= 6 or len(p) >= 40 for n, p in zip(sizes, own)]
        for k in range(len(own)):
            if long[k]:
                yield k, (own[k],)
            elif k + 3 <= len(own) and not any(long[k : k + 3]) and sum(sizes[k : k + 3]) >= 6:
                yield k, tuple(own[k : k + 3])

    first, wholes = {}, {}
    for doc_id, text in rows:
        wholes.setdefault(plain(text), doc_id)
        for k, key in content(text):
            first.setdefault(key, (doc_id, k))
    out = []
    for doc_id, text in rows:
        tiles = tiles_of(text)
        assert "".join(tiles) == text
        if plain(text) and wholes[plain(text)] < doc_id:
            out.append([True] * len(tiles))
            continue
        marks = ["?"] * len(tiles)
        for k, key in content(text):
            if len(key) == 1:
                marks[k] = "-"
        for k, key in content(text):
            where, at = first[key]
            if where < doc_id or k >= at + len(key):
                marks[k : k + len(key)] = "x" * len(key)
        joined = re.sub(r"(?<=x)\?+(?=x)", lambda m: "x" * len(m[0]), "".join(marks))
        gone = [False] * len(tiles)
        for run in re.finditer("x+", joined):
            if sum(len(t.split()) for t in tiles[run.start() : run.end()]) >= 20:
                gone[run.start() : run.end()] = [True] * len(run[0])
        out.append(gone)
    return out
