"""Near-duplicates among rows that share a doc_id with different texts."""

from __future__ import annotations

import corpus_pipeline
from yearpanel.llm import minhash

from .conftest import DOCUMENTS, prose
from .test_near import linked, same


def rows():
    base, other, third = prose(71, 8), prose(72, 8), prose(73, 8)
    texts = [
        (1, base),
        (5, base + " End."),  # near 1
        (5, other),  # its own text
        (5, third),
        (7, third + " Last."),  # near the third text of 5
        (8, prose(74, 8)),
    ]
    return [(k, text, "en", "s", len(text)) for k, text in texts]


def test_each_row_goes_by_its_own_text(spark):
    docs = spark.createDataFrame(rows(), DOCUMENTS)
    expected = linked(docs)
    assert sorted(r[3] for r in expected) == [False, False, True, True, True, True]
    same(minhash.near_duplicates(docs), expected)


def test_the_pipeline_keeps_the_other_texts_of_a_doc_id(spark):
    own = rows()
    docs = spark.createDataFrame(own, DOCUMENTS)
    found = corpus_pipeline.near_dedup(spark, docs, "").collect()
    assert sorted((r.doc_id, r.text) for r in found) == sorted((own[k][0], own[k][1]) for k in (0, 2, 3, 5))
