from __future__ import annotations

import itertools
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from yearpanel.llm import packing


@given(st.dictionaries(st.integers(1, 12), st.integers(1, 3), max_size=5), st.integers(0, 30))
@settings(max_examples=150, deadline=None)
def test_best_fill_is_the_largest_sum_within_the_capacity(counts, capacity):
    total, taken = packing.best_fill(counts, capacity)
    every = itertools.product(*[[n * k for k in range(c + 1)] for n, c in counts.items()])
    assert total == max(s for s in map(sum, every) if s <= capacity)
    assert sum(n * k for n, k in taken) == total
    assert all(0 < k <= counts[n] for n, k in taken)


def checked(pieces, expected, capacity):
    """Pieces tile the documents and fill windows; returns the fills."""
    windows, documents = defaultdict(list), defaultdict(list)
    for row in pieces:
        windows[row.sequence_id].append((row.offset, row.length))
        documents[row.doc_id].append(row)
    for own in windows.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    for doc_id, copies in expected.items():
        rows = sorted(documents.pop(doc_id), key=lambda r: r.start)
        for start, group in itertools.groupby(rows, key=lambda r: r.start):
            assert len(list(group)) == len(copies) or len(copies) > 1
        if len(copies) == 1:
            ids = np.concatenate([np.frombuffer(r.ids, dtype="<u4") for r in rows]).tolist()
            assert ids == copies[0]
            assert [r.start for r in rows] == list(itertools.accumulate([0] + [r.length for r in rows[:-1]]))
        assert {r.doc_tokens for r in rows} == {len(copies[0])}
        assert sum(r.length for r in rows) == sum(map(len, copies))
    assert not documents
    return [sum(n for _, n in own) for own in windows.values()]


@pytest.mark.parametrize("frame", ["documents", "odd_documents"])
def test_pieces_of_a_table(request, frame):
    docs = request.getfixturevalue(frame)
    own = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    expected = defaultdict(list)
    for row in docs.collect():
        expected[row.doc_id].append(own.encode(row.text or "", add_special_tokens=False).ids + [0])
    fills = checked(packing.packed(docs).collect(), expected, 1024)
    assert all(fill & (fill - 1) == 0 for fill in fills)
    digests = packing.piece_digests(packing.packed(docs.coalesce(1))).collect()
    ids = {r.doc_id: i[0] for r in docs.collect() if len(i := expected[r.doc_id]) == 1}
    for row in digests:
        if row.doc_id in ids:
            part = np.array(ids[row.doc_id][row.start : row.start + row.length], dtype="<u4")
            assert row.ids_crc32 == zlib.crc32(part.tobytes())


def test_an_empty_table_has_no_piece(no_documents):
    assert packing.packed(no_documents).count() == 0


def test_ids_are_those_of_the_vocabulary_file():
    own = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    ids = packing.tokenizer(public_tokenizers.path(packing.VOCABULARY))
    for text in ["", "a<|endoftext|>b", " <|endoftext|>  x", "Ünï 数字 🙂 it's\n\n  ok\x1c", "z" * 999]:
        assert ids(text).tolist() == own.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("length", [1, 300, 513, 700, 1023, 1024, 1025])
def test_documents_of_one_length_leave_no_padding(length):
    packer = packing.Packer(1024, 64, 0)
    rows = [row for k in range(200) for row in packer.add(k, np.zeros(length, dtype="<u4"))]
    rows += packer.finish()
    fill = defaultdict(int)
    for row in rows:
        fill[row[5]] += row[2]
    assert sum(fill.values()) == 200 * length
    assert sum(n != 1024 for n in fill.values()) <= 10
    assert all(n & (n - 1) == 0 for n in fill.values())
