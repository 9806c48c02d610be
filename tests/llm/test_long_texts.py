"""Texts of millions of characters without a word break, or of nothing else."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from yearpanel.llm import bpe, conversations, filter_audit, minhash, mixing, packing, quality

N = 2_000_000
TEXTS = {1: " " * N, 2: "\n" * N, 3: "a" * N, 4: "a line of words.\n" * 50, 5: " \n" * (N // 2) + "end"}


@pytest.fixture(scope="module")
def long_documents(spark):
    rows = [(k, text, "en", "s", len(text)) for k, text in TEXTS.items()]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_packing(long_documents):
    own = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    pieces = packing.packed(long_documents).collect()
    for doc_id, text in TEXTS.items():
        want = own.encode(text, add_special_tokens=False).ids + [packing.END]
        parts = sorted((r for r in pieces if r.doc_id == doc_id), key=lambda r: r.start)
        assert b"".join(r.ids for r in parts) == np.array(want, dtype="<u4").tobytes()
    found = packing.piece_digests(packing.packed(long_documents)).collect()
    assert {r.ids_crc32 for r in found} == {zlib.crc32(r.ids) for r in pieces}


def test_digests_counts_and_classes(spark, long_documents):
    assert all(r.n_tokens > 0 for r in bpe.token_digests(long_documents).collect())
    kept = {r.doc_id: (r.n_shingles, r.kept) for r in minhash.near_duplicates(long_documents).collect()}
    assert kept[1] == kept[2] == (0, True) and kept[3] == (1, True)
    labels = spark.createDataFrame([(3, 0, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    field = quality.fitted(long_documents, labels)
    counts = {r.doc_id: r for r in quality.judged(long_documents, field).collect()}
    assert counts[1].n_words == 0 and counts[3].word_chars == N
    sizes = {r.doc_id: r.size for r in mixing.mixed(long_documents).collect()}
    assert sizes == {1: 0, 2: 0, 3: 1, 4: 200, 5: 1}
    masks = {r.doc_id: r["mask"] for r in filter_audit.judged(long_documents).collect()}
    assert masks == {1: 1, 2: 1, 3: 1, 4: 2, 5: 1}


def test_conversation_of_long_texts(spark):
    rows = [(1, k, "user" if k % 2 else "assistant", text) for k, text in TEXTS.items()]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    (found,) = conversations.repaired(frame).collect()
    assert found.conv_id == 1 and found.blank >= 1


def test_every_stage(spark, long_documents, small_tables):
    for name, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, long_documents, small_tables)
        assert out.count() >= 1, name
