"""Packing of token sequences into windows of fixed size by minimum bin slack.

A document's ids are cut into whole windows and a rest. Rests wait in a pool. For each window the
longest rest is taken, and a subset-sum over the multiset of the other lengths, kept as one bitset
of reachable fills, picks the lengths that come closest to the capacity. Going back through the
bitsets gives how often each length is taken. What slack remains is filled by cutting one more
rest. What is left of a pool in the end is cut at powers of two, which need no padding.

Each task packs the documents that it reads, so that nothing shuffles and a lost task is simply
run again: its windows hold its own documents only.
"""

from __future__ import annotations

import functools
import json
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearpanel.llm.bpe import byte_characters

VOCABULARY = "byte_bpe_50k.json"
CAPACITY = 1024
END = 0
#: Rests that wait in a pool at most. The pool is packed down to half of them.
POOL = 8192

SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
    "offset long"
)
ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> Callable[[str], np.ndarray]:
    """Text to ids by a byte-level BPE vocabulary file, special tokens in the text included.

    The file's own library needs four times the CPU for the same ids (tested to be equal).
    """
    with open(path, encoding="utf-8") as file:
        config = json.load(file)
    special = {t["content"]: t["id"] for t in config.get("added_tokens", [])}
    back = {c: b for b, c in enumerate(byte_characters())}
    ranks = {
        bytes(back[c] for c in token): rank
        for token, rank in config["model"]["vocab"].items()
        if token not in special
    }
    own = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
    )

    def ids(text: str) -> np.ndarray:
        try:
            found = own.encode(text, allowed_special="all")
        except ValueError:  # its pattern gives up on runs of a million blanks
            found = file_tokenizer(path).encode(text, add_special_tokens=False).ids
        return np.array(found, dtype="<u4")

    return ids


@functools.lru_cache(maxsize=2)
def file_tokenizer(path: str) -> tokenizers.Tokenizer:
    """The library that the file is written for."""
    return tokenizers.Tokenizer.from_file(path)


def best_fill(counts: dict[int, int], capacity: int) -> tuple[int, list[tuple[int, int]]]:
    """The largest sum up to ``capacity`` of lengths from a multiset, and how often each is taken.

    Bit s of the bitset says that the sum s can be reached. A length with count c is added in
    groups of 1, 2, 4, ... copies, which reach every number of copies up to c. It ends as soon as
    the capacity is reached exactly.
    """
    full = (1 << capacity + 1) - 1
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        if length > capacity:
            continue
        left, copies = min(counts[length], capacity // length), 1
        while left:
            take = min(copies, left)
            steps.append((length, take, reach))
            reach = (reach | reach << length * take) & full
            left -= take
            copies *= 2
        if reach >> capacity & 1:
            break
    total = rest = reach.bit_length() - 1
    taken: dict[int, int] = defaultdict(int)
    for length, take, before in reversed(steps):
        if not before >> rest & 1:
            taken[length] += take
            rest -= length * take
    return total, list(taken.items())


class Packer:
    """Turns documents into pieces of windows, which are numbered from ``first_id``."""

    def __init__(self, capacity: int, pool: int, first_id: int):
        self.capacity, self.pool, self.next_id = capacity, pool, first_id
        self.rests: dict[int, list[tuple]] = defaultdict(list)  # by length
        self.waiting = 0

    def add(self, doc_id, ids: np.ndarray) -> Iterator[tuple]:
        whole = len(ids) - len(ids) % self.capacity
        for start in range(0, whole, self.capacity):
            yield from self._window([(doc_id, start, ids[start : start + self.capacity], len(ids))])
        if whole < len(ids):
            self._wait((doc_id, whole, ids[whole:], len(ids)))
        if self.waiting >= self.pool:
            yield from self._pack(self.pool // 2)

    def finish(self) -> Iterator[tuple]:
        yield from self._pack(0)

    def _wait(self, piece: tuple) -> None:
        self.rests[len(piece[2])].append(piece)
        self.waiting += 1

    def _take(self, length: int) -> tuple:
        pieces = self.rests[length]
        piece = pieces.pop()
        if not pieces:
            del self.rests[length]
        self.waiting -= 1
        return piece

    def _window(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset, sequence = 0, self.next_id
        self.next_id += 1
        for doc_id, start, ids, total in pieces:
            yield doc_id, start, len(ids), ids.tobytes(), total, sequence, offset
            offset += len(ids)

    def _cut(self, piece: tuple, at: int) -> tuple:
        """The first ``at`` ids; the others wait."""
        doc_id, start, ids, total = piece
        if at < len(ids):
            self._wait((doc_id, start + at, ids[at:], total))
        return doc_id, start, ids[:at], total

    def _pack(self, keep: int) -> Iterator[tuple]:
        tokens = sum(length * len(pieces) for length, pieces in self.rests.items())
        while self.waiting > keep and tokens >= self.capacity:
            window = [self._take(max(self.rests))]
            slack = self.capacity - len(window[0][2])
            counts = {length: len(pieces) for length, pieces in self.rests.items()}
            total, taken = best_fill(counts, slack)
            for length, copies in taken:
                window += [self._take(length) for _ in range(copies)]
            if slack > total:
                longer = min(n for n in self.rests if n > slack - total)
                window.append(self._cut(self._take(longer), slack - total))
            yield from self._window(window)
            tokens -= self.capacity
        if keep or not tokens:
            return
        pieces = [self._take(max(self.rests)) for _ in range(self.waiting)]
        size = 1 << tokens.bit_length() - 1
        while tokens:  # the binary digits of what is left
            window, room = [], size
            while room:
                piece = pieces.pop()
                doc_id, start, ids, total = piece
                if len(ids) > room:
                    pieces.append((doc_id, start + room, ids[room:], total))
                window.append((doc_id, start, ids[:room], total))
                room -= min(room, len(ids))
            yield from self._window(window)
            tokens -= size
            size = 1 << tokens.bit_length() - 1 if tokens else 0


def _batches(rows: Iterable[tuple], size: int = 2000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*held), ARROW)], schema=ARROW
            )
            held = []
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*held), ARROW)], schema=ARROW
        )


def packed(
    docs: DataFrame,
    path: str | None = None,
    capacity: int = CAPACITY,
    end: int = END,
    pool: int = POOL,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` are little-endian unsigned 32-bit numbers. A document is its token ids followed by
    ``end``; a null or empty text is ``end`` alone. Repeated rows are packed one by one, with
    their own pieces; a null doc_id stays null. Other columns are dropped. Every window but those
    at the end of a task is full, and the latter are powers of two. An empty table gives no row.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        ids_of = tokenizer(path or public_tokenizers.path(VOCABULARY))
        last = np.array([end], dtype="<u4")
        context = TaskContext.get()
        packer = Packer(capacity, pool, (context.partitionId() if context else 0) << 40)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                ids = np.concatenate([ids_of(text.as_py() or ""), last])
                yield from packer.add(doc_id.as_py(), ids)
        yield from packer.finish()

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(lambda batches: _batches(rows(batches)), SCHEMA)


def piece_digests(pieces: DataFrame) -> DataFrame:
    """Packed pieces with a checksum in place of the ids."""
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
