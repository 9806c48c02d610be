"""The lines that the field is fitted on come from anywhere in a document."""

from __future__ import annotations

import numpy as np

from yearpanel.llm import quality

SYMBOL_SHARE = 1  # the column of the features


def test_every_line_of_a_long_document_has_the_same_chance():
    features = np.arange(50).reshape(-1, 1)
    runs = [quality.line_run(features, 10, k)[:, 0] for k in range(20_000)]
    assert all(1 <= len(run) <= 10 and (np.diff(run) == 1).all() for run in runs)
    drawn = np.bincount(np.concatenate(runs), minlength=50) / len(runs)
    assert np.abs(drawn - 10 / 59).max() < 0.02
    assert len(quality.line_run(features, 50, 1)) == 50


def test_footers_of_long_documents_are_sampled(spark):
    body = [f"plain words of line {k}" for k in range(150)]
    footer = [f"### *** {k} ### ***" for k in range(150)]
    rows = [(k, "\n".join(body + footer)) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    found, good = quality.sampled_features(docs, labels)
    assert len(found) == len(good) == 40 and all(1 <= len(own) <= 100 for own in found)
    assert any((own[:, SYMBOL_SHARE] > 0).any() for own in found)
    assert any((own[:, SYMBOL_SHARE] == 0).all() for own in found)
