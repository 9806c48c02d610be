from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
import tiktoken

from yearpanel.llm import bpe

TEXTS = [
    "",
    " ",
    "Hello world, it's 10 o'clock.  Twice   spaced\n\n\tand tabbed \x1c\x1d\x1e\x1f\x85\xa0 end ",
    "Ünïcödé 数字 一二三 ٣٤ Ⅷ 🙂👩‍👩‍👧 é",
    "we'll they've I'm 'S x'd",
    "a" * 3000 + "aaaa aaaa",
    "<|endoftext|> stays text",
    "\r\n\x0b\x0c\x00\x01",
]


@pytest.fixture(scope="module")
def reference():
    ranks = {t: k for k, t in enumerate(bpe.read_ranks(public_tokenizers.path(bpe.RANKS)))}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN)


def test_ids_are_those_of_the_ranks_and_decode_to_the_text(codec, reference):
    for text in TEXTS:
        ids = codec.encode(text)
        assert ids == reference.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_every_character_is_split_as_by_the_ranks(codec, reference):
    points = [*range(0, 0x3000), *range(0xFE00, 0x10400, 7), *range(0x1F300, 0x1F400)]
    for k in (p for p in points if not 0xD800 <= p < 0xE000):
        text = f"a{chr(k)}1{chr(k) * 2} b{chr(k)} {chr(k)}"
        assert codec.encode(text) == reference.encode_ordinary(text), hex(k)


def test_every_token_is_itself(codec):
    for k, token in enumerate(codec.tokens):
        mapped = codec._map(token)
        assert codec.whole.get(mapped, (k,)) == (k,)
    assert codec.model.get_piece_size() == len(codec.tokens) + 1


def test_memory_of_pre_tokens_is_bounded(codec, reference, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    for text in TEXTS * 2:
        assert codec.encode(text) == reference.encode_ordinary(text)
    assert all(len(t) <= bpe.REMEMBERED_LENGTH for t in codec.by_length)


def test_digests_of_a_table(spark, documents, odd_documents, no_documents, reference):
    for frame in (documents, odd_documents):
        expected = []
        for row in frame.collect():
            ids = reference.encode_ordinary(row.text or "")
            written = " ".join(map(str, ids)).encode()
            expected.append(
                (
                    row.doc_id,
                    len(ids),
                    hashlib.sha256(written).hexdigest(),
                    hashlib.sha256((row.text or "").encode()).hexdigest(),
                )
            )
        found = [tuple(r) for r in bpe.token_digests(frame).collect()]
        assert sorted(found, key=str) == sorted(expected, key=str)
    assert bpe.token_digests(no_documents).count() == 0


def test_ids_and_bytes_as_columns(documents):
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    back = bpe.decoded(bpe.encoded(documents)).collect()
    assert len(back) == documents.count()
    assert all(bytes(r.text_bytes) == texts[r.doc_id].encode() for r in back)
