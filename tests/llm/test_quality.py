from __future__ import annotations

import itertools
import re
from collections import Counter

import numpy as np
import pytest

from yearpanel.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    inside = {
        j
        for k in range(len(words) - 7)
        if windows[tuple(words[k : k + 8])] > 1
        for j in range(k, k + 8)
    }
    lines = [line for line in text.split("\n") if WORD.search(line)]
    doubles = sum(line in lines[:k] for k, line in enumerate(lines))
    return len(words), len(re.findall(r"[#*$%&|<>]", text)), doubles, len(inside), sum(map(len, words))


@pytest.mark.parametrize("name", ["documents", "odd_documents"])
def test_base_counts(request, name):
    docs = request.getfixturevalue(name)
    texts = Counter((r.doc_id, r.text or "") for r in docs.collect())
    field = quality.LineField.content_only()
    found = quality.judged(docs, field)
    assert set(docs.columns) <= set(found.columns) and len(set(found.columns)) == len(found.columns)
    rows = found.collect()
    assert Counter((r.doc_id, r.text or "") for r in rows) == texts
    for r in rows:
        own = counts(r.text or "")
        assert (r.n_words, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.word_chars) == own
        assert r.base_failed == (own[0] < 20 or 100 * own[3] > 30 * own[0])
        assert r.kept == (not r.base_failed)


def test_repeated_windows_overlap():
    words = b"a b c d e f g h".split()
    assert quality.repeated_words(words * 2) == 16
    assert quality.repeated_words([*words, b"x", *words, b"y"]) == 16
    assert quality.repeated_words([b"a"] * 9) == 9
    assert quality.repeated_words([b"a"] * 8) == 0


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(0)
    field = quality.LineField(
        rng.normal(size=(quality.N_FEATURES, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    )
    for n in (1, 2, 5, 8):
        x = rng.normal(size=(n, quality.N_FEATURES))
        scores = x @ field.emission

        def total(path):
            steps = sum(field.transition[a, b] for a, b in zip(path, path[1:]))
            return field.start[path[0]] + steps + sum(scores[k, s] for k, s in enumerate(path))

        best = max(itertools.product((0, 1), repeat=n), key=total)
        assert tuple(quality.viterbi(field, x)) == best
    assert len(quality.viterbi(field, np.zeros((0, quality.N_FEATURES)))) == 0


def test_marginals_are_those_of_all_paths():
    rng = np.random.default_rng(1)
    scores, step, start = rng.normal(size=(1, 4, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    there = np.array([[True, True, True, False]])
    node, edge = quality._marginals(scores, step, start, there)
    weights, nodes, edges = 0.0, np.zeros((3, 2)), np.zeros((2, 2))
    for path in itertools.product((0, 1), repeat=3):
        w = start[path[0]] + sum(scores[0, k, s] for k, s in enumerate(path))
        w = np.exp(w + sum(step[a, b] for a, b in zip(path, path[1:])))
        weights += w
        for k, s in enumerate(path):
            nodes[k, s] += w
        for a, b in zip(path, path[1:]):
            edges[a, b] += w
    assert node[0, :3] == pytest.approx(nodes / weights)
    assert edge == pytest.approx(edges / weights)


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    field = quality.fitted(docs, labels.filter("doc_id % 2 = 0"))
    judged = quality.judged(docs, field).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    good = [r.content_share >= quality.MIN_CONTENT for r in judged if r.quality == 1]
    bad = [r.kept for r in judged if r.quality == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.15


def test_without_labels_every_line_is_content(spark, documents, no_documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    field = quality.fitted(documents, labels)
    assert (field.emission == quality.LineField.content_only().emission).all()
    odd = spark.createDataFrame([(None, 1, 0), (1, None, 0), (2, 1, 0)], labels.schema)
    assert quality.content_share(quality.fitted(documents, odd), b"any line") == 1.0
    assert quality.judged(no_documents, field).count() == 0
