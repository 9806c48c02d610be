"""Byte-level BPE through a sentencepiece model that is serialised from the vocabulary.

The model file is written field by field: one piece for every rank, its bytes mapped to printable
characters, its score the negative rank, so that sentencepiece merges in the order of the ranks.
The normaliser is the identity. A text is cut into pre-tokens by the vocabulary's pattern, each is
encoded by itself, and ids are decoded by the inverse of the byte map.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
import struct
from collections.abc import Iterator
from itertools import chain

import pandas as pd
import public_tokenizers
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANKS = "byte_bpe_50k.tiktoken"

# Numbers of the fields and types of a sentencepiece model file.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, TYPE = 1, 2, 3
NORMAL, UNKNOWN = 1, 2
MODEL_TYPE, VOCAB_SIZE, UNK_ID, BOS_ID, EOS_ID, PAD_ID = 3, 4, 40, 41, 42, 43
BPE = 2
NAME, ADD_DUMMY_PREFIX, REMOVE_EXTRA_WHITESPACES, ESCAPE_WHITESPACES = 1, 3, 4, 5

# The pattern for texts of ASCII characters only, in which it finds the same pieces several times
# faster: letters, numbers and white space are the ASCII ones.
ASCII_PATTERN = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+"
    r"|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
)

#: Pre-tokens whose ids a task remembers; beyond that it starts afresh.
REMEMBERED = 400_000
#: Longer pre-tokens are not remembered.
REMEMBERED_LENGTH = 64


def byte_characters() -> list[str]:
    """A printable character for each byte: itself if it is printable Latin-1 and no blank or soft
    hyphen, the next unused one from 256 on otherwise."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file, by rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    ranks = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{path}: the ranks have gaps")
    return [ranks[k] for k in range(len(ranks))]


def _varint(value: int) -> bytes:
    value &= (1 << 64) - 1
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _piece(text: str, score: float, kind: int) -> bytes:
    score_field = _varint(SCORE << 3 | 5) + struct.pack("<f", score)
    return _block(PIECES, _block(PIECE, text.encode()) + score_field + _number(TYPE, kind))


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose ids are the ranks of ``tokens``.

    One more piece, the unknown one that the format asks for, stands behind them. It never
    appears, since every byte is a piece.
    """
    mapped = byte_characters()
    pieces = [_piece("".join(mapped[b] for b in t), -float(k), NORMAL) for k, t in enumerate(tokens)]
    pieces.append(_piece("<unk>", 0.0, UNKNOWN))
    trainer = (
        _number(MODEL_TYPE, BPE)
        + _number(VOCAB_SIZE, len(pieces))
        + _number(UNK_ID, len(tokens))
        + b"".join(_number(field, -1) for field in (BOS_ID, EOS_ID, PAD_ID))
    )
    switches = (ADD_DUMMY_PREFIX, REMOVE_EXTRA_WHITESPACES, ESCAPE_WHITESPACES)
    normalizer = _block(NAME, b"identity") + b"".join(_number(field, 0) for field in switches)
    return b"".join(pieces) + _block(TRAINER, trainer) + _block(NORMALIZER, normalizer)


class Codec:
    """Encodes texts to ids and decodes ids to bytes."""

    def __init__(self, path: str, pattern: str):
        self.tokens = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor()
        self.model.LoadFromSerializedProto(serialise_model(self.tokens))
        self.pattern = regex.compile(pattern)
        self.ascii = ASCII_PATTERN if pattern == public_tokenizers.PATTERN else None
        self.mapped = dict(enumerate(byte_characters()))
        self.by_length: dict[str, tuple[int, ...]] = {}
        self.whole = self._not_reached()

    def _not_reached(self) -> dict[str, tuple[int, ...]]:
        """Tokens that merging alone doesn't build. As pre-tokens they still are one id."""
        texts = [self._map(t) for t in self.tokens]
        found = self.model.encode(texts, num_threads=1)
        return {t: (k,) for k, (t, ids) in enumerate(zip(texts, found, strict=True)) if ids != [k]}

    def _map(self, token: bytes) -> str:
        return token.decode("latin-1").translate(self.mapped)

    def pre_tokens(self, text: str) -> list[str]:
        return (self.ascii if self.ascii and text.isascii() else self.pattern).findall(text)

    def encode(self, text: str) -> list[int]:
        pieces = self.pre_tokens(text)
        known = self.by_length
        if len(known) > REMEMBERED:
            known.clear()
        found = list(map(known.get, pieces))
        missing = []
        if None in found:
            missing = list({p for p, ids in zip(pieces, found) if ids is None})
            mapped = [self._map(p.encode()) for p in missing]
            made = self.model.encode(mapped, num_threads=1)
            known.update(zip(missing, map(tuple, made), strict=True))
            if self.whole:
                known.update((p, self.whole[m]) for p, m in zip(missing, mapped) if m in self.whole)
            found = map(known.__getitem__, pieces)
        ids = list(chain.from_iterable(found))
        for piece in missing:
            if len(piece) > REMEMBERED_LENGTH:
                del known[piece]
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec for each Python worker."""
    return Codec(path, pattern)


def encoded(
    docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN
) -> DataFrame:
    """doc_id and ids, the array of token ids of the whole text. A null text is an empty one.

    One row per row of ``docs``, repeated rows included; nothing shuffles.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(path or public_tokenizers.path(RANKS), pattern)
        for batch in batches:
            ids = [own.encode(text or "") for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "ids": ids})

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInPandas(
        run, "doc_id long, ids array<int>"
    )


def decoded(frame: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text_bytes, what the array ``ids`` stands for. Null ids give no bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(path or public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
        for batch in batches:
            texts = [b"" if ids is None else own.decode(ids) for ids in batch["ids"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text_bytes": texts})

    return frame.select("doc_id", "ids").mapInPandas(run, "doc_id long, text_bytes binary")


def token_digests(
    docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: an encoded and decoded text in digests.

    The digests are taken where the ids are made, as the ids are several times the size of the
    text. Ids are written in decimal with one blank between them. A null text is an empty one;
    repeated rows, extra columns and null ids of documents pass through.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(path or public_tokenizers.path(RANKS), pattern)
        decimal = [str(k) for k in range(len(own.tokens))]
        for batch in batches:
            out = []
            for text in batch["text"]:
                ids = own.encode(text or "")
                written = " ".join(map(decimal.__getitem__, ids)).encode()
                whole = own.decode(ids)
                out.append(
                    (
                        len(ids),
                        hashlib.sha256(written).hexdigest(),
                        hashlib.sha256(whole).hexdigest(),
                    )
                )
            digests = pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            digests.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield digests

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInPandas(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
