"""Line dedup, substring dedup, suffix dedup and near-duplicates against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from yearpanel.llm import line_dedup, minhash, substring_dedup, suffix_dedup
from yearpanel.llm.components import components

from .brute import late_lines, late_units, tiles_of
from .conftest import prose

SCHEMA = "doc_id long, text string"


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def with_id(docs):
    return sorted((r.doc_id, r.text or "") for r in docs.collect() if r.doc_id is not None)


def same(found, expected):
    assert Counter(map(tuple, found.collect())) == Counter(expected)


# Lines


def without_lines(docs):
    rows, out = with_id(docs), []
    for (doc_id, text), gone in zip(rows, late_lines(rows)):
        kept = "\n".join(line for line, g in zip(text.split("\n"), gone) if not g)
        out.append((doc_id, len(gone), sum(gone), sha(kept)))
    return out


@pytest.fixture(scope="module")
def near_lines(spark):
    """Lines an edit or two apart, at their ends and inside, of lengths around those of a block."""
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdé数🙂 ") for _ in range(n)) + "#" for n in (20, 21, 31, 32, 33, 64, 200)]
    lines = list(base)
    for line in base:
        for at in (0, 1, len(line) // 2, len(line) - 1):
            lines += [line[:at] + "Z" + line[at:], line[:at] + line[at + 1 :], line[:at] + "Q" + line[at + 1 :]]
            two = line[:at] + "Y" + line[at + 1 :]
            lines.append(two[: len(two) // 3] + "Y" + two[len(two) // 3 + 1 :])
        lines.append(line + "Z")
    lines += ["aaaaaaaaaaaaaaaaaaaaaa", "aaaaaaaaaaaaaaaaaaaaaaa", "ab" * 15, "ba" * 15]
    rng.shuffle(lines)
    docs = [(k, "\n".join(lines[k * 5 : k * 5 + 5])) for k in range(-(-len(lines) // 5))]
    return spark.createDataFrame(docs, SCHEMA)


@pytest.mark.parametrize("name", ["documents", "odd_documents", "near_lines", "no_documents"])
def test_lines(request, name):
    docs = request.getfixturevalue(name)
    same(line_dedup.digests(line_dedup.deduplicated(docs)), without_lines(docs))


def test_lines_run_without_python(documents):
    plan = line_dedup.deduplicated(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


# Substrings


def without_units(docs):
    rows, out = with_id(docs), []
    for (doc_id, text), gone in zip(rows, late_units(rows)):
        tiles = tiles_of(text)
        kept = "".join(t for t, g in zip(tiles, gone) if not g)
        marks = "".join("x" * len(t) if g else "-" * len(t) for t, g in zip(tiles, gone))
        spans = [(m.start(), m.end() - m.start()) for m in re.finditer("x+", marks)]
        written = ",".join(f"{a}:{n}" for a, n in spans)
        out.append(
            (doc_id, len(tiles), sum(gone), sum(n for _, n in spans), len(spans), written, sha(kept))
        )
    return out


@pytest.fixture(scope="module")
def short_units(spark):
    """Passages of short sentences, in scripts with and without blanks, and short copies."""
    short = "Ka lon. Mi ru! Te sa vor? Pel dam. Ox ka. Lo mi ru. Te ka. Sa sa vor. Pel. Dam ox lo. Mi.\n"
    hot = "One sentence that very many documents have."
    signs = "".join(chr(0x4E00 + k) for k in range(60))
    texts = [short, prose(1) + " " + short + prose(2), short, "Yes. No.", "yes.  NO.", hot, prose(3) + " " + hot]
    texts += [prose(4) + "\n" + hot, signs + ".\n" + prose(5), prose(6) + "\n" + signs + ".", "a. " * 40, "a. " * 50]
    texts += [short[:40] + prose(7), prose(8) + short[20:], "", " \n", short.replace(".", "!")]
    return spark.createDataFrame(list(enumerate(texts)), SCHEMA)


@pytest.mark.parametrize("name", ["documents", "odd_documents", "short_units", "no_documents"])
def test_units(request, name):
    docs = request.getfixturevalue(name)
    same(substring_dedup.digests(substring_dedup.deduplicated(docs)), without_units(docs))


def test_spans_are_of_the_original_text(documents):
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    for r in substring_dedup.deduplicated(documents).collect():
        text, at, kept = texts[r.doc_id], 0, ""
        for span in r.spans:
            kept += text[at : span.start]
            at = span.start + span.length
        assert kept + text[at:] == r.kept_text


# Byte strings


def without_bytes(docs, width=50):
    rows, seen, out = with_id(docs), {}, []
    for doc_id, text in rows:
        data = text.encode()
        covered = np.zeros(len(data), dtype=bool)
        for k in range(len(data) - width + 1):
            if seen.setdefault(data[k : k + width], doc_id) < doc_id:
                covered[k : k + width] = True
        kept = np.frombuffer(data, dtype=np.uint8)[~covered].tobytes()
        runs = int(np.diff(np.r_[0, covered.astype(int)]).clip(0).sum())
        out.append((doc_id, len(data), int(covered.sum()), runs, sha(kept)))
    return out


@pytest.mark.parametrize("name", ["documents", "odd_documents", "no_documents"])
def test_bytes(request, name):
    docs = request.getfixturevalue(name)
    same(suffix_dedup.digests(suffix_dedup.deduplicated(docs)), without_bytes(docs))


def test_a_range_is_merged_in_the_order_of_its_suffixes():
    import pandas as pd

    rng = random.Random(2)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 40))) for _ in range(30)]
    every = sorted({t[k:] for t in texts for k in range(len(t))})
    rank = {s: k + 1 for k, s in enumerate(every)} | {b"": 0}
    rows = []
    for t in texts:
        for k in range(len(t)):
            r = [rank[t[k + j :]] if (k + j) % 3 else 0 for j in range(3)]
            rows.append((k % 3, t[k] + 1, t[k + 1] + 1 if k + 1 < len(t) else 0, *r, t[k:]))
    frame = pd.DataFrame(rows, columns=["kind", "s", "t", "r0", "r1", "r2", "suffix"])
    places = suffix_dedup.merged(frame)
    assert sorted(places) == list(range(len(frame)))
    ordered = frame["suffix"].to_numpy()[np.argsort(places)].tolist()
    assert ordered == sorted(ordered)


# Near-duplicates


def linked(docs, words=4, percent=80):
    rows = with_id(docs)
    sets = []
    for _, text in rows:
        own = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)) if w]
        sets.append({tuple(own[k : k + words]) for k in range(max(1, len(own) - words + 1))} if own else set())
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), doc_id), doc_id)
    return [
        (doc_id, len(s), least[root(k)], least[root(k)] == doc_id)
        for k, ((doc_id, _), s) in enumerate(zip(rows, sets))
    ]


@pytest.fixture(scope="module")
def chains(spark):
    """Groups in which each document is near the next, but not near the one after it."""
    rng = random.Random(9)
    rows, number = [], 0
    for _ in range(4):
        words = [f"w{rng.randrange(5000)}" for _ in range(120)]
        for _ in range(25):
            rows.append((number, " ".join(words)))
            number += 1
            for _ in range(3):
                words[rng.randrange(120)] = f"w{rng.randrange(5000)}"
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("name", ["documents", "odd_documents", "chains", "no_documents"])
def test_near_duplicates(request, monkeypatch, name):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    docs = request.getfixturevalue(name)
    same(minhash.near_duplicates(docs), linked(docs))


@pytest.mark.parametrize("labels", [[5] * 90 + [6], [5] * 40 + [6] * 30 + [7] * 20, list(range(70)), [5, 5, 6]])
def test_cells_hold_every_pair_of_labels_once(spark, monkeypatch, labels):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rows = [(1, k, label) for k, label in enumerate(labels)] + [(2, k, 9) for k in range(20)]
    rows = spark.createDataFrame(rows, "key long, id long, label long")
    dealt = minhash._dealt(rows, minhash._bucket_sizes(rows)).collect()
    assert {r.key for r in dealt} == {1}  # nothing to compare among members of one label
    cells = {}
    for r in dealt:
        cells.setdefault(r.cell, []).append(r.id)
    met = Counter(frozenset(pair) for ids in cells.values() for pair in itertools.combinations(ids, 2))
    n = len(labels)
    for a, b in itertools.combinations(range(n), 2):
        if labels[a] != labels[b]:
            assert met[frozenset((a, b))] >= 1
    if len(set(labels)) == 2 and n > 8:  # one other label costs a copy of each row, not one for each part
        assert len(dealt) <= 2 * n


def test_components(spark):
    rng = random.Random(1)
    path = [(k, k + 1) for k in range(100, 160)]
    star = [(7, k) for k in range(200, 260)]
    links = path + star + [(1, 2), (3, 2), (9, 9), (159, 5)] + [(rng.randrange(20, 30), rng.randrange(20, 30)) for _ in range(6)]
    parent = {x: x for link in links for x in link}
    for _ in parent:
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
    found = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert found == {x: p for x, p in parent.items() if x in found}
    assert set(parent) - set(found) <= {x for x in parent if all(a == b for a, b in links if x in (a, b))}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
