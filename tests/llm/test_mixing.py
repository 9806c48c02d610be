"""Mixing sources against a plain computation of targets, and how near the words come."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from yearpanel.llm import mixing

DOCUMENTS = "doc_id long, text string, source string, size int, place int, target int, rate int"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def goals(sizes):
    """Exact targets by source."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    out, left = {}, Fraction(sum(sizes.values()))
    while order:
        total = sum(weight[s] for s in order)
        above = [s for s in order if left * weight[s] / total > 3 * sizes[s]]
        if not above:
            return out | {s: left * weight[s] / total for s in order}
        for s in above:
            out[s] = 3 * sizes[s]
        left -= sum(3 * sizes[s] for s in above)
        order = [s for s in order if s not in above]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, 0, 0, 0) for r in rows], DOCUMENTS).repartition(5)


def checked(rows, found):
    assert Counter((r.doc_id, r.size) for r in found) == Counter((d, words(t)) for d, t, _ in rows)
    sizes, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, text, source in rows:
        sizes[source] += words(text)
        largest[source] = max(largest[source], words(text))
    want = goals(sizes)
    for r in found:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(float(want[r.source]), rel=1e-12)
        assert r.taken == r.size * r.copies and r.taken <= 3 * r.size
        rate = r.target / r.source_size if r.source_size else 0
        assert int(rate) <= r.copies <= int(rate) + 1
        taken[r.source] += r.taken
    for source in sizes:
        assert abs(taken[source] - want[source]) <= largest[source] + 1e-6, source


def made(seed, shares):
    rng = random.Random(seed)
    rows = []
    for source, n in shares.items():
        for _ in range(n):
            size = rng.choice([0, 1, 5, 20, 100, int(rng.paretovariate(0.8)) % 3000])
            rows.append((len(rows), " ".join(["w"] * size), source))
    return rows


SHARES = {"a": 300, "b": 2, "": 40, None: 70, "ü": 5, "zz": 90, "Z": 1, "empty": 0}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sources_come_near_their_targets(spark, seed):
    rows = made(seed, SHARES) + [(9000, None, "nothing"), (9001, " \t", "nothing")]
    checked(rows, mixing.mixed(frame(spark, rows)).collect())


def test_reruns_agree(spark):
    rows = made(4, SHARES) + [(None, "no id " * 9, "a")] * 3
    first = mixing.mixed(frame(spark, rows)).collect()
    again = mixing.mixed(frame(spark, rows[::-1]).repartition(2)).collect()
    assert Counter(map(tuple, first)) == Counter(map(tuple, again))
    checked(rows, first)


def test_draws_have_the_probability_of_the_fraction(spark):
    """Over many seeds a document is copied as often as the fraction says."""
    rows = made(6, {"a": 60, "b": 60, "c": 60})
    sizes = mixing.materialise(mixing.sized(frame(spark, rows)), "sizes")
    goal = {r.source: r.target / r.source_size for r in mixing.targets(sizes).collect()}
    copies = defaultdict(int)
    old, seeds = mixing.SEED, 8
    try:
        for k in range(seeds):
            mixing.SEED = f"seed{k}"
            for r in mixing.mixed(frame(spark, rows)).collect():
                copies[r.source] += r.copies
    finally:
        mixing.SEED = old
    for source, rate in goal.items():
        assert copies[source] / (60 * seeds) == pytest.approx(rate, abs=0.02)


def test_emitted_rows(spark):
    rows = made(7, {"a": 30, "b": 4, None: 9})
    docs = frame(spark, rows)
    often = Counter({r.doc_id: r.copies for r in mixing.mixed(docs).collect() if r.copies})
    out = mixing.emitted(docs)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == often


def test_empty_tables_and_texts(spark, odd_documents, no_documents):
    assert mixing.mixed(no_documents).count() == 0
    nothing = [(1, None, "a"), (2, "", None)]
    assert {(r.target, r.taken) for r in mixing.mixed(frame(spark, nothing)).collect()} == {(0.0, 0)}
    odd = odd_documents.withColumns({"size": F.lit(1), "digest": F.lit(2), "own": F.lit(3)})
    found = mixing.mixed(odd).collect()
    checked([tuple(r) for r in odd.select("doc_id", "text", "source").collect()], found)


def test_one_source_with_most_rows(spark):
    docs = spark.range(4000).selectExpr(
        "id as doc_id",
        "array_join(array_repeat('w', cast(1 + id % 7 as int)), ' ') as text",
        "if(id % 3 > 0, 'hot', concat('s', id % 30)) as source",
    )
    rows = [tuple(r) for r in docs.collect()]
    checked(rows, mixing.mixed(docs).collect())
