"""Suffix dedup of texts that share passages, cut into pieces, against brute force."""

from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from yearpanel.llm import suffix_dedup
from yearpanel.sources.scratch import materialise

from .conftest import DOCUMENTS, prose
from .test_near import same, without_bytes


def shared_texts(seed, n=60):
    """Documents of which a third hold one passage at any offset, others parts of it or copies."""
    rng = random.Random(seed)
    passage = prose(seed + 1000, 12, 14)
    texts = []
    for k in range(n):
        own = prose(seed * 100 + k, rng.randrange(1, 6), rng.randrange(3, 20))
        at = rng.randrange(len(own))
        if k % 3 == 0:
            own = own[:at] + passage + own[at:]
        elif k % 7 == 1:
            start = rng.randrange(len(passage))
            own = own[:at] + passage[start : start + rng.randrange(30, 400)] + own[at:]
        elif k % 7 == 2 and texts:
            other = rng.choice(texts)
            cut = rng.randrange(len(other))
            own = other[:cut] + rng.choice(["", "X", "éé"]) + other[cut:]
        elif k % 11 == 3:
            own = own + own + "ab" * rng.randrange(200) + "-" * rng.randrange(500)
        texts.append(own)
    return texts


def frame(spark, texts, ids=None):
    rows = [(k, t, "en", "s", len(t)) for k, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(5)


@pytest.mark.parametrize("seed", [1, 2])
def test_a_passage_in_a_third_of_all_documents(spark, seed, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RANGE_ROWS", 700)
    docs = frame(spark, shared_texts(seed))
    same(suffix_dedup.digests(suffix_dedup.deduplicated(docs)), without_bytes(docs))


def test_texts_that_share_a_doc_id(spark):
    texts = shared_texts(3, 24)
    docs = frame(spark, texts, [k // 2 for k in range(24)])
    same(suffix_dedup.digests(suffix_dedup.deduplicated(docs)), without_bytes(docs))


def test_equal_content_is_cut_alike():
    text = np.frombuffer(prose(9, 200).encode(), dtype=np.uint8)
    whole = suffix_dedup.cuts(text)
    part = suffix_dedup.cuts(text[1000:9000]) + 1000
    inner = [x for x in whole if 1000 + 300 < x < 9000 - 300]
    assert inner == [x for x in part if 1300 < x < 8700] and len(inner) > 10
    assert np.diff(whole).min() > 64
    assert len(suffix_dedup.cuts(np.zeros(5000, dtype=np.uint8))) <= 2
    assert suffix_dedup.cuts(text[:5]).tolist() == [0]


def test_tables_of_finished_levels_are_deleted(spark):
    base = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    docs = frame(spark, shared_texts(4, 30))
    before = {p.name for p in base.iterdir()}
    suffix_dedup.deduplicated(docs).agg(F.count("*")).collect()
    left = sorted(p.name.rsplit("-", 1)[0] for p in base.iterdir() if p.name not in before)
    assert not {"level", "keys", "ordered", "anchors", "shared-anchors"} & set(left)


def test_every_window_has_its_smallest_gram():
    rng = random.Random(1)
    texts = [bytes(rng.choice(b"abc") for _ in range(rng.randrange(0, 200))) for _ in range(30)]
    row, at, code = suffix_dedup.anchors(texts, 50, 16)
    marks = {}
    for r, a, c in zip(row.tolist(), at.tolist(), code.tolist()):
        assert 0 <= a <= len(texts[r]) - 16
        marks.setdefault(r, set()).add(a)
        marks.setdefault((texts[r][a : a + 16]), set()).add(c)
    for r, text in enumerate(texts):
        for start in range(len(text) - 49):
            assert any(start <= a <= start + 34 for a in marks[r])
        assert len(text) >= 50 or r not in marks
    assert all(len(v) == 1 for k, v in marks.items() if isinstance(k, bytes))
    assert suffix_dedup.anchors([b""], 50, 16)[0].size == 0


@pytest.mark.parametrize("width", [50, 64, 90])
def test_strings_of_any_width(spark, width, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RANGE_ROWS", 700)
    docs = frame(spark, shared_texts(5, 24))
    found = suffix_dedup.digests(suffix_dedup.deduplicated(docs, width))
    same(found, without_bytes(docs, width))


def test_strings_that_differ_in_their_last_bytes_only(spark):
    rng = random.Random(6)
    stem = "".join(rng.choice("abcdefgh") for _ in range(48))
    texts = ["." * k + stem + end + "!" * 60 for k, end in enumerate(["xy", "xz", "xy", "wy", "xy", "wy"])]
    docs = frame(spark, texts)
    same(suffix_dedup.digests(suffix_dedup.deduplicated(docs)), without_bytes(docs))


def test_few_rows_are_sorted(spark, monkeypatch):
    """Fewer rows are sorted than the texts have bytes, and none for names of names."""
    written = []

    def counted(df, label):
        held = materialise(df, label)
        written.append((label, held.count()))
        return held

    monkeypatch.setattr(suffix_dedup, "materialise", counted)
    texts = shared_texts(7, 200)
    suffix_dedup.deduplicated(frame(spark, texts)).agg(F.count("*")).collect()
    assert sum(rows for label, rows in written if label == "ordered") < sum(map(len, texts))
    assert not {"level", "keys"} & {label for label, _ in written}


def test_places_travel_packed(spark, monkeypatch):
    """Tables of places have a row for a block of texts and a bucket or range, and no anchors are
    broadcast."""
    written = {}

    def counted(df, label):
        held = materialise(df, label)
        written[label] = written.get(label, 0) + held.count()
        return held

    def narrow(df, rows=suffix_dedup.small.__defaults__[0]):
        assert "anchor" not in df.columns
        return df

    monkeypatch.setattr(suffix_dedup, "materialise", counted)
    monkeypatch.setattr(suffix_dedup, "small", narrow)
    texts = shared_texts(8, 200)
    docs = frame(spark, texts)
    same(suffix_dedup.digests(suffix_dedup.deduplicated(docs)), without_bytes(docs))
    places = ("anchors", "repeated-anchors", "ordered", "covered")
    assert sum(written.get(label, 0) for label in places) < len(texts)


def test_ranges_are_cut_between_sampled_keys(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RANGE_ROWS", 500)
    texts = [t.encode() for t in shared_texts(9, 40)]
    rows = [(k, t, k) for k, t in enumerate(texts)]
    parts = spark.createDataFrame(rows, "sid long, text binary, doc_id long")
    total = sum(max(0, len(t) - 49) for t in texts)
    borders = suffix_dedup._borders(parts, 50, total)
    keys = np.array([t[k : k + 48] for t in texts for k in range(len(t) - 49)], dtype="S48")
    sizes = np.bincount(np.searchsorted(borders, keys, "right"))
    assert len(sizes) > total / 500 / 2 and sizes.max() < 4 * 500


def test_shuffle_files_go_and_the_setting_is_restored(spark):
    before = spark.conf.get(suffix_dedup.SHUFFLE_CLEANUP, None)
    held = suffix_dedup._written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert held.count() == 7 and spark.conf.get(suffix_dedup.SHUFFLE_CLEANUP, None) == before
