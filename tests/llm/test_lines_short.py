"""Exact repeats of short lines, with expected rows written out."""

from __future__ import annotations

import corpus_pipeline
from yearpanel.llm import line_dedup

SCHEMA = "doc_id long, text string"
TEXTS = [
    (1, "Share\nfirst own line\n\nNo"),
    (2, "Share\nShore\n\nNa\n \t"),
    (3, "No\nShare\n \t\nthird own line"),
    (4, "\u6570\u5b57\nx\nx\n\u6570\u5b57"),
]
KEPT = {
    1: ("Share\nfirst own line\n\nNo", 0),
    2: ("Shore\n\nNa\n \t", 1),
    3: (" \t\nthird own line", 2),
    4: ("\u6570\u5b57\nx", 2),
}


def test_short_lines_go_as_exact_repeats_only(spark):
    docs = spark.createDataFrame(TEXTS, SCHEMA)
    found = line_dedup.deduplicated(docs).collect()
    assert {r.doc_id: (r.kept_text, r.n_removed) for r in found} == KEPT


def test_the_pipeline_takes_short_repeats_out(spark):
    docs = spark.createDataFrame(TEXTS, SCHEMA)
    found = corpus_pipeline.line_dedup_stage(spark, docs, "").collect()
    assert {r.doc_id: r.text for r in found} == {k: text for k, (text, _) in KEPT.items()}
