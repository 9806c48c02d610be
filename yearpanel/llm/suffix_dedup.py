"""Removal of repeated byte strings through a distributed difference-cover suffix order.

Documents are strings of bytes. As in the algorithm of difference cover 3, the suffixes at
positions 1 and 2 modulo 3 are named by sorting their first three symbols, the names form strings
of two thirds of the length whose suffixes are ordered by the same method, and the suffixes at
positions 0 modulo 3 are then merged in: two suffixes always have a small shift after which both
are in the cover. Strings are told apart by their first ``width`` bytes only, so that the recursion
ends as soon as two names cover that many. Up to a width of ``DIRECT`` there is none: the cover is
named by sorting its own strings of two bytes less, and these names with the two last bytes order,
and tell apart, all strings exactly. Only suffixes that start a whole string are rows, and only
the cover that these look at is named. In the final order suffixes with equal prefixes are
neighbours; comparing neighbours gives the runs, and every suffix of a run that starts in a larger
document than the smallest of the run starts a string to remove.

The rows of a block of texts that go to one task, a range of the order or a bucket of hashes, travel
as one row of packed numbers, and so do the answers: Spark shuffles them, and numpy sorts a range or
bucket at once. Ranges are cut between keys of a sample, a few for each. Wider strings are ordered by
Spark's range partitioning: every task sorts one range, and the sizes of the ranges, one number for
each task, turn places within a range into global ones.

Three reductions that lose nothing come first. Equal texts are one string. Of every window of
``width`` bytes the gram with the smallest hash is an anchor, which equal windows share: only the
stretches around anchors that two documents have take part, first by anchors of 16 bytes, and of
what these leave by anchors of 32. And stretches are cut into pieces where their content says so,
each with the bytes that strings starting in it need. Equal pieces are one piece of the smallest
document that has it: in every larger one all of it goes. So a passage that a third of all
documents hold is sorted once. Of different pieces the stretches around anchors of 44 bytes stay;
they are cut once more, into smaller pieces, so that copies which differ here and there are sorted
again near the differences only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from yearpanel.llm.common import small
from yearpanel.sources.scratch import discard, materialise

WIDTH = 50
#: Bytes of an anchor, at first, in what is left by these, and in different pieces of that.
GRAMS = (16, 32, 44)
#: Bytes of texts that a task works on at once, and of texts whose rows and answers travel together.
BLOCK, CHUNK = 1 << 18, 1 << 20
#: Anchors that one task compares, on average.
BUCKET_ROWS = 1_000_000
#: A string is cut at the smallest gram among this many before and behind it, and different pieces
#: are cut again with the second number.
CUT_REACH, FINE_REACH = 64, 12
#: Bytes up to which strings of the cover are sorted as they are.
DIRECT = 64
#: Suffixes of a range that one task sorts, on average.
RANGE_ROWS = 250_000
#: Lets Spark delete a job's shuffle files when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bits of a place in a string.
PLACE_BITS = 40
#: Keys sampled for each range that is cut.
SAMPLED = 30
FACTORS = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], dtype=np.uint64)


def _rolling(data: np.ndarray, length: int, factor: np.uint64) -> np.ndarray:
    """A hash of every stretch of ``length`` bytes, put together from powers of two."""
    parts, size, level = [], 1, data.astype(np.uint64) + np.uint64(1)
    power = int(factor)
    n = len(data) - length + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint64)
    out, at = np.zeros(n, dtype=np.uint64), 0
    while size <= length:
        if length & size:
            parts.append((size, level, np.uint64(power)))
        if 2 * size <= length:
            level = level[:-size] * np.uint64(power) + level[size:]
            power = power * power & (1 << 64) - 1
        size *= 2
    for size, level, power in reversed(parts):
        out = out * power + level[at : at + n]
        at += size
    return out


def _mixed(code: np.ndarray) -> np.ndarray:
    code = (code ^ code >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    return code ^ code >> np.uint64(29)


def _frames(pieces: Iterator[dict], rows: int = 200_000) -> Iterator[pd.DataFrame]:
    """Frames of many short pieces, each a dictionary of arrays and single values."""
    held, n = [], 0

    def joined() -> pd.DataFrame:
        sizes = [max(np.size(v) if np.ndim(v) else 0 for v in piece.values()) for piece in held]
        return pd.DataFrame(
            {
                name: np.concatenate(
                    [p[name] if np.ndim(p[name]) else np.full(k, p[name]) for p, k in zip(held, sizes)]
                )
                for name in held[0]
            }
        )

    for piece in pieces:
        held.append(piece)
        n += max(np.size(v) if np.ndim(v) else 0 for v in piece.values())
        if n >= rows:
            yield joined()
            held, n = [], 0
    if held:
        yield joined()


def _extremes(code: np.ndarray, length: int, pick: np.ufunc) -> np.ndarray:
    """The smallest or largest value of every stretch of ``length``."""
    size = 1
    while 2 * size <= length:
        code = pick(code[size:], code[:-size])
        size *= 2
    return pick(code[length - size :], code[: size - length]) if size < length else code


def _anchors(data: np.ndarray, size: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``anchors`` of texts of the given sizes, one behind the other."""
    n = len(data) - width + 1
    if n < 1:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none.view(np.uint64)
    end = np.cumsum(size)
    row = np.repeat(np.arange(len(size), dtype=np.int32), size)
    code = _mixed(_rolling(data, gram, FACTORS[0]))
    grade = (code >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    least = _extremes(grade, width - gram + 1, np.minimum)
    least[np.arange(width, width + n) > end[row[:n]]] = 0  # windows that no text has
    none = np.zeros(width - gram, dtype=np.uint32)
    # A gram is the smallest of a window if it equals the largest of all windows' smallest ones.
    at = np.flatnonzero(_extremes(np.concatenate([none, least, none]), width - gram + 1, np.maximum) == grade)
    return row[at].astype(np.int64), at - (end - size)[row[at]], code[at]


def anchors(texts: list[bytes], width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the text, place in it and hash of the smallest gram of every window of ``width``
    bytes; of all that are smallest, if several are."""
    size = np.array([len(t) for t in texts])
    return _anchors(np.frombuffer(b"".join(texts), dtype=np.uint8), size, width, gram)


def _written(df: DataFrame, label: str) -> DataFrame:
    """``materialise``, without the shuffle files of the job. Else Spark deletes them when the
    driver's garbage collector meets what refers to them, which may be long after."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        held = materialise(df, label)
    finally:
        if before is None:
            conf.unset(SHUFFLE_CLEANUP)
        else:
            conf.set(SHUFFLE_CLEANUP, before)
    df.sparkSession.sparkContext._jvm.System.gc()
    return held


def strings(docs: DataFrame) -> DataFrame:
    """source, sid, doc_id, start (0), text (bytes), digest: texts of the smallest doc_id that has
    them. Rows that repeat whole are several strings."""
    text = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    own = docs.filter("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.sha2(text, 256).alias("digest")
    )
    copies = (
        own.groupBy("digest")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .filter("first < last")
        .select("digest", "first")
    )
    found = own.join(small(_written(copies, "copied-texts")), "digest", "left").filter(
        F.col("first").isNull() | (F.col("first") == F.col("doc_id"))
    )
    sid = F.monotonically_increasing_id()
    found = found.select("doc_id", "text", "digest", sid.alias("sid"))
    written = _written(found, "strings")
    placed = written.withColumns({"source": F.col("sid"), "start": F.lit(0).cast("long")})
    placed.scratch = written.scratch
    return placed


def _joined_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows whose texts have about BLOCK bytes together, the bytes, and the sizes of the texts."""
    for batch in batches:
        size = np.asarray(pa.compute.binary_length(batch["text"]), dtype=np.int64)
        ends = np.flatnonzero(np.diff(np.cumsum(size) // BLOCK, append=-1)) + 1
        for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
            part = batch.slice(a, b - a)
            data = np.frombuffer(b"".join(part["text"].to_pylist()), dtype=np.uint8)
            yield part, data, size[a:b]


def _spread(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the row and place in it of as many places as each row has."""
    row = np.repeat(np.arange(len(count)), count)
    return row, np.arange(len(row)) - (np.cumsum(count) - count)[row]


def _packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values of neighbouring rows of ``values``, which end at ``ends``."""
    step = values.dtype.itemsize * int(np.prod(values.shape[1:]))
    offsets = pa.py_buffer((np.r_[0, ends] * step).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, offsets, pa.py_buffer(np.ascontiguousarray(values))])


def _unpacked(column: pa.ChunkedArray, kind: str = "i8") -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind)


def _sent(bucket: np.ndarray, sid: np.ndarray, at: np.ndarray, bits: int, values: dict) -> pa.RecordBatch:
    """bucket, chunk, place, and values: a row for all places of a chunk that go to one bucket.

    A chunk is 2 ** bits neighbouring numbers of strings, and a place is that in the chunk and the
    one in the string.
    """
    chunk = sid >> bits
    order = np.lexsort([bucket, chunk])
    chunk, bucket = chunk[order], bucket[order].astype(np.int64)
    ends = np.flatnonzero((np.diff(chunk) != 0) | (np.diff(bucket) != 0)) + 1
    ends = np.r_[ends, len(order)] if len(order) else ends
    place = (sid & (1 << bits) - 1) << PLACE_BITS | at
    packed = {name: _packed(value[order], ends) for name, value in ({"place": place} | values).items()}
    return pa.RecordBatch.from_pydict({"bucket": bucket[ends - 1], "chunk": chunk[ends - 1]} | packed)


def _answered(table: pa.Table, wanted: np.ndarray | None, values: dict) -> pa.Table:
    """chunk and values, as far as wanted, of the rows of a bucket, given in their order."""
    size = np.asarray(pa.compute.binary_length(table["place"]), dtype=np.int64) // 8
    if wanted is not None:
        size = np.bincount(np.repeat(np.arange(len(size)), size)[wanted], minlength=len(size))
        values = {name: value[wanted] for name, value in values.items()}
    packed = {name: _packed(value, np.cumsum(size)) for name, value in values.items()}
    answers = pa.table({"chunk": table["chunk"].combine_chunks()} | packed)
    return answers.filter(pa.array(size > 0))


def _places(column: pa.ChunkedArray, bits: int, table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of places, and the number of the row in ``table``, which is in the order of sid, and
    the place in it of each."""
    place = _unpacked(column)
    order = np.argsort(place, kind="stable")
    place = place[order]
    number = table["sid"].to_numpy() & (1 << bits) - 1
    return order, np.searchsorted(number, place >> PLACE_BITS), place & (1 << PLACE_BITS) - 1


def _measured(found: DataFrame) -> tuple[int, int, int]:
    """Bytes and rows of texts, and the bits of numbers in a chunk."""
    total, rows = found.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    total = total or 0
    return total, rows, max(0, min(CHUNK, CHUNK * rows // max(total, 1)).bit_length() - 1)


def _chunk(bits: int) -> Column:
    return F.shiftright("sid", bits).alias("chunk")


def _groups_in_one(doc: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether each group, which starts at ``starts``, has one document only."""
    return np.minimum.reduceat(doc, starts) == np.maximum.reduceat(doc, starts)


STRETCH = "source long, doc_id long, start long, text binary"


def stretches(found: DataFrame, width: int, gram: int) -> DataFrame:
    """sid, source, doc_id, start, text: the parts of strings (of the same columns) around anchors
    that another document has too, each a new string.

    Anchors meet in buckets of their hashes, many in a row of packed numbers; where they are shared
    goes back to the chunk that they come from. Of an anchor that several documents of a block have,
    two places go to its bucket and the others straight back.
    """
    total, _, bits = _measured(found)
    buckets = 1 + 2 * total // (width - gram + 2) // BUCKET_ROWS

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, size in _joined_texts(batches):
            row, at, code = _anchors(data, size, width, gram)
            if not len(at):
                continue
            sid, doc = part["sid"].to_numpy()[row], part["doc_id"].to_numpy()[row]
            order = np.lexsort([doc, code])
            sid, doc, at, code = sid[order], doc[order], at[order], code[order]
            starts = np.r_[0, np.flatnonzero(code[1:] != code[:-1]) + 1]
            count = np.diff(np.r_[starts, len(code)])
            several = np.repeat(~_groups_in_one(doc, starts), count)
            ends = np.zeros(len(code), dtype=bool)
            ends[starts] = ends[starts + count - 1] = True
            sure = several & ~ends
            yield _sent(code[~sure] % np.uint64(buckets), sid[~sure], at[~sure], bits, {"anchor": code[~sure], "doc": doc[~sure]})
            if sure.any():
                back = _sent((sid[sure] >> bits) % buckets, sid[sure], at[sure], bits, {})
                none = pa.nulls(len(back), pa.binary())
                yield pa.RecordBatch.from_arrays([*back.columns, none, none], [*back.schema.names, "anchor", "doc"])

    def compare(table: pa.Table) -> pa.Table:
        sure, table = table.filter(pa.compute.is_null(table["anchor"])), table.filter(pa.compute.is_valid(table["anchor"]))
        known = sure.select(["chunk", "place"])
        if not len(table):
            return known
        code, doc, place = _unpacked(table["anchor"], "u8"), _unpacked(table["doc"]), _unpacked(table["place"])
        order = np.argsort(code, kind="stable")
        starts = np.r_[0, np.flatnonzero(np.diff(code[order])) + 1]
        several = ~_groups_in_one(doc[order], starts)
        shared = np.empty(len(code), dtype=bool)
        shared[order] = np.repeat(several, np.diff(np.r_[starts, len(code)]))
        return pa.concat_tables([_answered(table, shared, {"place": place}), known])

    def cut(strings: pa.Table, answers: pa.Table) -> pa.Table:
        strings = strings.sort_by("sid")
        _, row, at = _places(answers["place"], bits, strings)
        source, doc, start = (strings[c].to_numpy() for c in ("source", "doc_id", "start"))
        texts = strings["text"].to_pylist() if len(at) else []
        size = np.array([len(t) for t in texts], dtype=np.int64)
        low = np.maximum(at - (width - gram), 0)
        high = np.minimum(at + width, size[row]) if len(at) else at
        new = np.r_[True, (row[1:] != row[:-1]) | (low[1:] > high[:-1])][: len(at)]
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(at)][: len(first)] - 1
        row, low, high = row[first], low[first], high[last]
        parts = [texts[r][a:b] for r, a, b in zip(row.tolist(), low.tolist(), high.tolist())]
        return pa.table(
            {"source": source[row], "doc_id": doc[row], "start": start[row] + low, "text": pa.array(parts, pa.binary())}
        )

    sent = found.select("sid", "text", "doc_id").mapInArrow(
        mark, "bucket long, chunk long, place binary, anchor binary, doc binary"
    )
    answers = _written(sent.groupBy("bucket").applyInArrow(compare, "chunk long, place binary"), "repeated-anchors")
    own = found.select("sid", "source", "doc_id", "start", "text", _chunk(bits))
    parts = own.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(cut, STRETCH)
    # An order of 2 ** 33 tasks and rows leaves room for the doubling of ids in the recursion.
    written = _written(parts.withColumn("sid", F.monotonically_increasing_id()), "stretches")
    discard(answers)
    return written


def _cuts(data: np.ndarray, size: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of the text and place in it of ``cuts`` of texts of the given sizes, one behind the
    other."""
    gap = reach + GRAMS[0]  # so that no text sees another
    begin = np.cumsum(size + gap) - size
    row, at = _spread(size)
    spot = begin[row] + at
    padded = np.zeros(len(data) + gap * (len(size) + 1), dtype=np.uint8)
    padded[spot] = data
    code = np.full(len(padded), np.iinfo(np.uint64).max, dtype=np.uint64)
    whole = at <= size[row] - GRAMS[0]
    row, at, spot = row[whole], at[whole], spot[whole]
    code[spot] = _mixed(_rolling(padded, GRAMS[0], FACTORS[0]))[spot]
    least = _extremes(code, reach, np.minimum)
    own = code[spot]
    new = (own < least[spot - reach]) & (own <= least[spot + 1]) & (at > reach) & (size[row] > 2 * reach)
    row, at = np.r_[np.arange(len(size)), row[new]], np.r_[np.zeros(len(size), dtype=np.int64), at[new]]
    order = np.lexsort([at, row])
    return row[order], at[order]


def cuts(data: np.ndarray, reach: int = CUT_REACH) -> np.ndarray:
    """Where the pieces of a string start: at 0, and from ``reach`` on where a gram is smaller than
    all of ``reach`` before it and as small as all behind it. In a text that repeats with a period
    few are."""
    return _cuts(data, np.array([len(data)]), reach)[1]


def places(found: DataFrame, width: int, reach: int = CUT_REACH) -> DataFrame:
    """sid, source, doc_id, start, at, core, high, low: where the pieces of stretches are (``start``
    in the source, ``at`` in the stretch), and their digests.

    ``core`` strings of ``width`` bytes start in a piece; with the rest of the last one it is
    ``core + width - 1`` bytes long.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, size in _joined_texts(batches):
            row, at = _cuts(data, size, reach)
            last = size - width + 1  # starts of whole strings
            row, at = row[at < last[row]], at[at < last[row]]
            ends = np.r_[row[1:] != row[:-1], True][: len(at)]
            core = np.where(ends, last[row], np.r_[at[1:], 0][: len(at)]) - at
            begin = (np.cumsum(size) - size)[row] + at
            text = memoryview(data)
            codes = [
                xxhash.xxh3_128_digest(text[a:b]) for a, b in zip(begin.tolist(), (begin + core + width - 1).tolist())
            ]
            halves = np.frombuffer(b"".join(codes), dtype=">i8").reshape(-1, 2).astype(np.int64)
            sid, source, doc_id, start = (part[c].to_numpy()[row] for c in ("sid", "source", "doc_id", "start"))
            yield pa.RecordBatch.from_arrays(
                [
                    *map(pa.array, (sid, source, doc_id, start + at, at.astype(np.int32), core.astype(np.int32))),
                    *map(pa.array, (halves[:, 0], halves[:, 1])),
                ],
                [column.split()[0] for column in PLACE.split(", ")],
            )

    own = found.select("sid", "source", "doc_id", "start", "text")
    return _written(own.mapInArrow(run, PLACE), "piece-places")


PLACE = "sid long, source long, doc_id long, start long, at int, core int, high long, low long"


def pieces(where: DataFrame) -> DataFrame:
    """piece, high, low, n, first (doc_id, sid, at, ...): every different piece and its first
    place."""
    place = F.struct("doc_id", "sid", "at", "source", "start", "core")
    grouped = where.groupBy("high", "low").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    return _written(grouped.withColumn("piece", F.monotonically_increasing_id()), "pieces")


def piece_texts(found: DataFrame, own: DataFrame, width: int) -> DataFrame:
    """sid, source (the piece), doc_id, start (0), text. Numbers follow the order of the files, so that
    texts read together are of few chunks."""
    first = own.select("piece", "first.*")
    held = found.select("sid", "text").join(first, "sid")
    text = F.substring(F.col("text"), F.col("at") + 1, F.col("core") + (width - 1))
    return _written(
        held.select(
            F.col("piece").alias("source"),
            "doc_id",
            F.lit(0).cast("long").alias("start"),
            text.alias("text"),
        ).withColumn("sid", F.monotonically_increasing_id()),
        "piece-texts",
    )


def _placed(sorted_rows: DataFrame, columns: str) -> tuple[DataFrame, DataFrame]:
    """Rows with ``part`` and ``k``, their range and the place in it, given a place beyond all
    ranges before, from 1; and the table that they are read from. One number for each range is
    gathered."""
    rows = _written(sorted_rows, "ordered")
    sizes = rows.groupBy("part").agg((F.max("k") + 1).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    placed = rows.join(F.broadcast(offsets), "part")  # a row for each range
    return placed.select(*columns.split(), (F.col("offset") + F.col("k") + 1).alias("rank")), rows


def _part() -> int:
    return TaskContext.get().partitionId()


def _regrouped(ranks: DataFrame) -> DataFrame:
    """sid and symbols: the ranks of a string by position."""
    pairs = F.array_sort(F.collect_list(F.struct("at", "rank")))
    # Almost no sid comes twice in a range, so that plain rows are shuffled.
    grouped = ranks.repartition("sid").groupBy("sid")
    return grouped.agg(F.transform(pairs, lambda p: p["rank"]).alias("symbols"))


def _shifted(symbols: np.ndarray, by: int) -> np.ndarray:
    """Every position's symbol ``by`` later, 0 beyond the end."""
    return np.concatenate([symbols[by:], np.zeros(min(by, len(symbols)), dtype=np.int64)])


def _named(level: DataFrame, sampled: bool) -> tuple[DataFrame, list[DataFrame]]:
    """sid, at, rank: names in sorted order, and the tables that they are read from. Of triples at sampled positions, whose strings of
    positions 1 and 2 modulo 3 get the ids 2 sid and 2 sid + 1; or of pairs at all positions."""

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[dict]:
        for batch in batches:
            for sid, symbols in zip(batch["sid"], batch["symbols"]):
                s = np.asarray(symbols, dtype=np.int64)
                one, two = _shifted(s, 1), _shifted(s, 2)
                if sampled:
                    for k in (1, 2):
                        own = np.arange(k, len(s), 3)
                        named = {"a": s[own], "b": one[own], "c": two[own]}
                        yield named | {"sid": 2 * sid + k - 1, "at": (own // 3).astype(np.int32)}
                else:
                    yield {"a": s, "b": one, "c": 0, "sid": sid, "at": np.arange(len(s), dtype=np.int32)}

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = 0
        for batch in batches:
            yield batch.assign(part=_part(), k=np.arange(at, at + len(batch)))
            at += len(batch)

    rows = _written(level.mapInPandas(lambda b: _frames(keys(b)), "a long, b long, c long, sid long, at int"), "keys")
    key = ["a", "b", "c"]
    ordered = rows.select(*key).distinct().repartitionByRange(*key).sortWithinPartitions(*key)
    names, table = _placed(ordered.mapInPandas(number, "a long, b long, c long, part int, k long"), "a b c")
    return rows.join(names, key).select("sid", "at", "rank"), [rows, table]


def _packed_triples(level: DataFrame) -> DataFrame:
    """sid, symbols of the reduced strings of byte strings. Three bytes fit into one number, which
    sorts as they do, so that names need no sort."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for sid, text in zip(batch["sid"], batch["text"]):
                s = np.frombuffer(text, dtype=np.uint8).astype(np.int64) + 1
                name = (s << 18) + (_shifted(s, 1) << 9) + _shifted(s, 2)
                rows += [(2 * sid, name[1::3]), (2 * sid + 1, name[2::3])]
            yield pd.DataFrame(rows, columns=["sid", "symbols"])

    return level.select("sid", "text").mapInPandas(run, "sid long, symbols array<long>")


#: Bits of a symbol of byte strings and of packed triples. Names are up to 63 bits long.
BYTE, TRIPLE, NAME = 9, 27, 63

MERGE = "p long, q long, u long, v long, sid long, at int"


def _prefixes(s: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers of as many first symbols as fit; they sort as the strings do."""
    n = NAME // bits
    out = []
    for first in (0, n):
        value = np.zeros(len(s), dtype=np.int64)
        for k in range(first, first + n):
            value = value << bits | _shifted(s, k) if n > 1 else _shifted(s, k)
        out.append(value)
    return out[0], out[1]


def _merge_rows(
    level: DataFrame, cover: DataFrame, bits: int, extra: str = "", width: int = WIDTH
) -> DataFrame:
    """A row for every suffix, with what merging compares: a prefix (p, q), which ranges are cut by
    and which the first symbols are read from, and the ranks of the two next sampled suffixes."""
    side = cover.select(
        F.floor(F.col("sid") / 2).cast("long").alias("sid"), (F.col("sid") % 2).alias("side"), "symbols"
    )
    left = side.filter("side = 0").select("sid", F.col("symbols").alias("first"))
    right = side.filter("side = 1").select("sid", F.col("symbols").alias("second"))
    top = bool(extra)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[dict]:
        for batch in batches:
            for sid, own, first, second, doc_id in batch.itertuples(index=False):
                if top:
                    data = np.frombuffer(own, dtype=np.uint8)
                    s = data.astype(np.int64) + 1
                else:
                    s = np.asarray(own, dtype=np.int64)
                n = len(s)
                rank = np.zeros(n + 2, dtype=np.int64)
                for k, ranks in ((1, first), (2, second)):
                    if ranks is not None and len(ranks):
                        rank[k:n:3] = np.asarray(ranks, dtype=np.int64)
                p, q = _prefixes(s, bits)
                kind = np.arange(n) % 3
                now, one, two = rank[:n], rank[1 : n + 1], rank[2 : n + 2]
                out = {
                    "p": p,
                    "q": q,
                    "u": np.where(kind == 0, one, now),
                    "v": np.where(kind == 1, one, two),
                    "sid": sid,
                    "at": np.arange(n, dtype=np.int32),
                }
                if top:
                    window = [_rolling(data, width, f).view(np.int64) for f in FACTORS]
                    for name, codes in zip(("h", "i"), window):
                        out[name] = np.r_[codes, np.zeros(n - len(codes), dtype=np.int64)]
                    out["whole"] = np.arange(n) < len(window[0])
                    out["doc_id"] = doc_id
                yield out

    joined = level.join(left, "sid", "left").join(right, "sid", "left")
    own, doc = ("text", F.col("doc_id")) if top else ("symbols", F.lit(0).cast("long"))
    rows = joined.select("sid", own, "first", "second", doc.alias("doc_id")).mapInPandas(
        lambda batches: _frames(run(batches)), MERGE + extra
    )
    length = F.octet_length("text") if top else F.size("symbols")
    total = level.agg(F.sum(length)).first()[0] or 0
    return rows.repartitionByRange(1 + total // RANGE_ROWS, "p", "q")


def _earlier(mine: list[np.ndarray], theirs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """How many of the others come before each of mine, and of mine before each of theirs."""
    n, m = len(mine[0]), len(theirs[0])
    order = np.lexsort([np.r_[a, b] for a, b in zip(reversed(mine), reversed(theirs))])
    own = order < n
    before = np.empty(n + m, dtype=np.int64)
    before[order] = np.where(own, np.cumsum(~own), np.cumsum(own))
    return before[:n], before[n:]


def unpacked(rows: pd.DataFrame, bits: int) -> pd.DataFrame:
    """kind, the two first symbols and the ranks that each kind of suffix has, of packed rows."""
    kind = rows["at"].to_numpy() % 3
    p, q, u, v = (rows[c].to_numpy() for c in ("p", "q", "u", "v"))
    n = NAME // bits
    s, t = (p, q) if n == 1 else (p >> bits * (n - 1), p >> bits * (n - 2) & (1 << bits) - 1)
    ranks = {
        "r0": np.where(kind == 0, 0, u),
        "r1": np.select([kind == 0, kind == 1], [u, v], 0),
        "r2": np.where(kind == 1, 0, v),
    }
    return pd.DataFrame({"kind": kind, "s": s, "t": t} | ranks)


def merged(rows: pd.DataFrame) -> np.ndarray:
    """The place of every suffix of a range, from three sorted kinds. Where ranks end before the
    strings do, ``e1`` and ``e2`` are the last byte and the two last ones."""
    if "e1" not in rows:
        rows = rows.assign(e1=0, e2=0)
    kinds = [rows[rows["kind"] == k] for k in range(3)]
    col = [{c: part[c].to_numpy() for c in ("s", "t", "r0", "r1", "r2", "e1", "e2")} for part in kinds]
    orders = [np.lexsort([own[c] for c in names]) for own, names in zip(col, (("e1", "r1", "s"), *[("e2", "r0")] * 2))]
    places = []
    for order in orders:
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        places.append(place)
    for a, b, names in ((0, 1, ("s", "r1", "e1")), (0, 2, ("s", "t", "r2")), (1, 2, ("r0", "e2"))):
        x, y = _earlier([col[a][c] for c in names], [col[b][c] for c in names])
        places[a] += x
        places[b] += y
    out = np.empty(len(rows), dtype=np.int64)
    for k, place in enumerate(places):
        out[(rows["kind"] == k).to_numpy()] = place
    return out


def _all_rows(batches: Iterator[pd.DataFrame]) -> pd.DataFrame | None:
    held = [batch for batch in batches if len(batch)]
    return pd.concat(held, ignore_index=True) if held else None


def _ordered(level: DataFrame, cover: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """sid, at, rank of all suffixes of a level from those of its cover, and their table."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = _all_rows(batches)
        if rows is not None:
            yield pd.DataFrame(
                {"sid": rows["sid"], "at": rows["at"], "part": _part(), "k": merged(unpacked(rows, bits))}
            )

    found = _merge_rows(level, cover, bits).mapInPandas(run, "sid long, at int, part int, k long")
    return _placed(found, "sid at")


def suffix_ranks(
    level: DataFrame, width: int, bits: int = NAME, read: Sequence[DataFrame] = ()
) -> tuple[DataFrame, list[DataFrame]]:
    """sid and symbols: the rank of every suffix by its first ``width`` symbols at least; and the
    tables that they are read from.

    ``read`` are the tables that ``level`` is read from; they go as soon as it is written.
    """
    level = _written(level, "level")
    discard(*read)
    if width <= 2:
        named, tables = _named(level, sampled=False)
        return _regrouped(named), [*tables, level]
    named, tables = _named(level, sampled=True)
    cover, tables = suffix_ranks(_regrouped(named), -(-width // 3), read=tables)
    ordered, table = _ordered(level, cover, bits)
    discard(*tables, level)
    return _regrouped(ordered), [table]


def _words(held: np.ndarray) -> list[np.ndarray]:
    """Numbers of eight bytes each of every string, which sort as the strings do, the last first."""
    n, wide = held.shape
    full = np.zeros((n, -(-wide // 8) * 8), dtype=np.uint8)
    full[:, :wide] = held
    return list(full.view(">u8").astype(np.uint64).T[::-1])


def _borders(parts: DataFrame, width: int, total: int) -> np.ndarray:
    """Strings of ``width`` - 2 bytes between which ranges of about RANGE_ROWS strings are cut, from
    a sample of SAMPLED for each range."""
    wide, ranges = width - 2, 1 + total // RANGE_ROWS
    step = max(1, total // (ranges * SAMPLED))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for _, data, size in _joined_texts(batches):
            row, at = _spread(np.maximum(size - wide + 1, 0))
            drawn = slice(-n % step, None, step)
            n += len(at)
            spot = (np.cumsum(size) - size)[row[drawn]] + at[drawn]
            if len(spot):
                held = np.lib.stride_tricks.sliding_window_view(data, wide)[spot]
                yield pa.RecordBatch.from_arrays([_packed(held, np.arange(1, len(held) + 1))], ["key"])

    found = parts.select("text").mapInArrow(sample, "key binary").toArrow()["key"].to_pylist()
    keys = np.sort(np.array(found, dtype=f"S{wide}"))
    return np.unique(keys[np.arange(1, ranges) * len(keys) // ranges]) if len(keys) else keys


def _cover(parts: DataFrame, width: int, bits: int, borders: np.ndarray) -> DataFrame:
    """chunk, place, name: the names of the strings of ``width`` - 2 bytes that start at places 1
    and 2 modulo 3, as far as whole strings look at them. Equal ones have equal names."""
    wide = width - 2

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, size in _joined_texts(batches):
            row, at = _spread(np.maximum(size - wide + 1, 0))
            row, at = row[at % 3 > 0], at[at % 3 > 0]
            if len(at):
                held = np.lib.stride_tricks.sliding_window_view(data, wide)[(np.cumsum(size) - size)[row] + at]
                bucket = np.searchsorted(borders, held.view(f"S{wide}")[:, 0], "right")
                yield _sent(bucket, part["sid"].to_numpy()[row], at, bits, {"key": held})

    def named(key: tuple, table: pa.Table) -> pa.Table:
        words = _words(_unpacked(table["key"], "u1").reshape(-1, wide))
        order = np.lexsort(words)
        new = np.zeros(len(order), dtype=bool)
        for word in words:
            word = word[order]
            new[1:] |= word[1:] != word[:-1]
        name = np.empty(len(order), dtype=np.int64)
        name[order] = np.cumsum(new) + (key[0].as_py() + 1 << PLACE_BITS)
        return _answered(table, None, {"place": _unpacked(table["place"]), "name": name})

    sent = parts.select("sid", "text").mapInArrow(keys, "bucket long, chunk long, place binary, key binary")
    return _written(sent.groupBy("bucket").applyInArrow(named, "chunk long, place binary, name binary"), "covered")


def _first_bytes(held: np.ndarray, kind: str) -> np.ndarray:
    """Big-endian numbers of the first bytes of every string; they sort as the strings do."""
    low = np.iinfo(kind).min
    return np.ascontiguousarray(held[:, : np.dtype(kind).itemsize]).view(f">{kind}")[:, 0].astype(kind) ^ low


def _late_spans(parts: DataFrame, width: int) -> DataFrame:
    """sid, at, length: neighbouring late starts among strings of up to DIRECT bytes."""
    total, rows, bits = _measured(parts)
    total -= rows * (width - 1)
    borders = _borders(parts, width, total)
    names = _cover(parts, width, bits, borders)
    values = {"first": "i8", "u": "i8", "v": "i8", "e": "i4", "doc": "i8"}

    def strings_of(texts: pa.Table, covered: pa.Table) -> pa.Table:
        texts = texts.sort_by("sid")
        order, _, _ = _places(covered["place"], bits, texts)
        name = _unpacked(covered["name"])[order]
        sid, doc = texts["sid"].to_numpy(), texts["doc_id"].to_numpy()
        held = texts["text"].to_pylist()
        data = np.frombuffer(b"".join(held), dtype=np.uint8)
        size = np.array([len(t) for t in held], dtype=np.int64)
        count = size - width + 3  # places that have a name or stand between such
        row, at = _spread(count)
        rank = np.zeros(len(at), dtype=np.int64)
        rank[at % 3 > 0] = name
        spot = np.flatnonzero(at < count[row] - 2)
        begin, sent = np.cumsum(size) - size, []
        for i in (spot[k : k + 200_000] for k in range(0, len(spot), 200_000)):
            own = np.lib.stride_tricks.sliding_window_view(data, width)[begin[row[i]] + at[i]]
            kind = at[i] % 3
            key = np.ascontiguousarray(own[:, : width - 2]).view(f"S{width - 2}")[:, 0]
            ends = {
                "first": _first_bytes(own, "i8") ^ np.iinfo("i8").min,
                "u": np.where(kind == 0, rank[i + 1], rank[i]),
                "v": np.where(kind == 1, rank[i + 1], rank[i + 2]),
                "e": own[:, -2].astype(np.int32) << 8 | own[:, -1],
                "doc": doc[row[i]],
            }
            sent.append(_sent(np.searchsorted(borders, key, "right"), sid[row[i]], at[i], bits, ends))
        names = ["bucket", "chunk", "place", *values]
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * (1 + len(values))]
        return pa.Table.from_batches(sent, schema=pa.schema(list(zip(names, kinds))))

    def run(table: pa.Table) -> pa.Table:
        place = _unpacked(table["place"])
        first, u, v, e, doc = (_unpacked(table[name], kind) for name, kind in values.items())
        kind = (place & (1 << PLACE_BITS) - 1) % 3
        ranks = {
            "r0": np.where(kind == 0, 0, u),
            "r1": np.select([kind == 0, kind == 1], [u, v], 0),
            "r2": np.where(kind == 1, 0, v),
        }
        ends = {"s": first >> 56 & 255, "t": first >> 48 & 255, "e1": e & 255, "e2": e}
        order = np.argsort(merged(pd.DataFrame({"kind": kind} | ranks | ends)))
        kind, p, e, doc = (x[order] for x in (kind, first, e, doc))
        r0, r1, r2 = (ranks[c][order] for c in ("r0", "r1", "r2"))
        # Names after the shift that puts both into the cover; first and last bytes do the rest.
        a, b = kind[1:], kind[:-1]
        zero = (a == 0) | (b == 0)
        shift = np.where(~zero, 0, np.where((a == 2) | (b == 2), 2, 1))
        equal = (p[1:] == p[:-1]) & (e[1:] == e[:-1])
        equal &= np.choose(shift, [r[1:] == r[:-1] for r in (r0, r1, r2)])
        starts = np.r_[0, np.flatnonzero(~equal) + 1]
        least = np.minimum.reduceat(doc, starts)
        late = np.empty(len(order), dtype=bool)
        late[order] = doc > np.repeat(least, np.diff(np.r_[starts, len(doc)]))
        return _answered(table, late, {"place": place})

    def joined(key: tuple, table: pa.Table) -> pa.Table:
        place = np.sort(_unpacked(table["place"]))
        new = np.flatnonzero(np.r_[True, np.diff(place) > 1])
        size = np.diff(np.r_[new, len(place)])
        sid = (key[0].as_py() << bits) + (place[new] >> PLACE_BITS)
        at = place[new] & (1 << PLACE_BITS) - 1
        return pa.table({"sid": sid, "at": at, "length": size.astype(np.int32)})

    own = parts.select("sid", "doc_id", "text", _chunk(bits))
    columns = ", ".join(["bucket long, chunk long, place binary", *[f"{name} binary" for name in values]])
    sent = own.groupBy("chunk").cogroup(names.groupBy("chunk")).applyInArrow(strings_of, columns)
    late = sent.groupBy("bucket").applyInArrow(run, "chunk long, place binary")
    written = _written(late.groupBy("chunk").applyInArrow(joined, "sid long, at long, length int"), "late-rows")
    discard(names)
    return written


def _late_rows_by_names(parts: DataFrame, width: int) -> DataFrame:
    """sid, at: the late starts among wider strings, by names of names."""
    cover, tables = suffix_ranks(_packed_triples(parts), -(-width // 3), TRIPLE)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = _all_rows(batches)
        if rows is None:
            return
        order = np.argsort(merged(unpacked(rows, BYTE)))
        rows = rows.iloc[order]
        rows = rows[rows["whole"]]  # shorter suffixes equal no other one to the full width
        if len(rows) < 2:
            return
        h, i, doc = (rows[c].to_numpy() for c in ("h", "i", "doc_id"))
        starts = np.r_[0, np.flatnonzero((h[1:] != h[:-1]) | (i[1:] != i[:-1])) + 1]
        least = np.minimum.reduceat(doc, starts)
        late = doc > np.repeat(least, np.diff(np.r_[starts, len(doc)]))
        yield rows.loc[late, ["sid", "at"]]

    extra = ", h long, i long, whole boolean, doc_id long"
    found = _merge_rows(parts, cover, BYTE, extra, width).mapInPandas(run, "sid long, at int")
    late = _written(found, "late-rows")
    discard(*tables)
    return late


def _spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """sid, at, length: neighbouring places joined."""
    for batch in batches:
        for sid, found in zip(batch["sid"], batch["places"]):
            at = np.unique(np.asarray(found, dtype=np.int64))
            new = np.flatnonzero(np.r_[True, np.diff(at) > 1])
            yield pd.DataFrame({"sid": sid, "at": at[new], "length": np.diff(np.r_[new, len(at)])})


def repeats(parts: DataFrame, width: int = WIDTH) -> DataFrame:
    """piece, late (start, length): where strings of ``width`` bytes start that a piece of a smaller
    document also has."""
    if width <= DIRECT:
        found = _late_spans(parts, width)
        spans, tables = found, [found]
    else:
        found = _late_rows_by_names(parts, width)
        rows = found.groupBy("sid").agg(F.collect_list("at").alias("places"))
        spans, tables = rows.mapInPandas(_spans, "sid long, at long, length int"), [found]
    own = parts.select("sid", F.col("source").alias("piece"), "start")
    span = F.struct((F.col("at") + F.col("start")).alias("start"), "length")
    grouped = spans.join(own, "sid").groupBy("piece").agg(F.collect_list(span).alias("late"))
    written = _written(grouped, "late-starts")
    discard(*tables)
    return written


SPANS = "array<struct<start:int,length:int>>"
STARTS = "array<struct<start:long,length:int>>"


def late_spans(
    found: DataFrame,
    width: int,
    grams: Sequence[int] = GRAMS[:-1],
    reaches: Sequence[int] = (CUT_REACH, FINE_REACH),
) -> DataFrame:
    """source, starts (start, length): where strings start in a text that a smaller document also
    has.

    In every text but that of its smallest document all strings of a piece do. The table of
    ``found`` is deleted once its stretches are written.
    """
    for gram in grams:
        held, found = found, stretches(found, width, gram)
        discard(held)
    where = places(found, width, reaches[0])
    own = pieces(where)
    texts = piece_texts(found, own, width)
    discard(found)
    if reaches[1:]:
        late = late_spans(texts, width, GRAMS[-1:], reaches[1:]).selectExpr("source as piece", "starts as late")
    else:
        parts = stretches(texts, width, GRAMS[-1])
        discard(texts)
        late = repeats(parts, width)
        discard(parts)
    first = own.select("piece", "high", "low", "n", F.col("first.doc_id").alias("smallest"))
    wanted = first.join(late, "piece", "left").filter("n > 1 or late is not null")
    whole = F.array(F.struct(F.col("start"), F.col("core").alias("length")))
    inside = F.transform(
        F.coalesce("late", F.array().cast(STARTS)),
        lambda x: F.struct((x["start"] + F.col("start")).alias("start"), x["length"].alias("length")),
    )
    late = (
        where.join(wanted, ["high", "low"])
        .select("source", F.when(F.col("doc_id") > F.col("smallest"), whole).otherwise(inside).alias("some"))
        .filter(F.size("some") > 0)
        .groupBy("source")
        .agg(F.flatten(F.collect_list("some")).alias("starts"))
    )
    written = _written(late, "late-spans")
    discard(where, own)
    return written


def deduplicated(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, kept (bytes), n_bytes, spans (start and length), one row per row with a doc_id.

    A byte goes if a string of ``width`` bytes covers it that also starts in a document with a
    smaller doc_id. A null text has no bytes. Rows that share a doc_id are no smaller than each
    other, and texts that repeat whole below one doc_id stay. Rows without a doc_id are left out.
    Other columns are dropped. An empty table gives no row.
    """
    found = strings(docs)
    # Rows that repeat whole are equal strings of one document; one of them stands for all.
    firsts = found.groupBy("digest").agg(F.min("source").alias("source"), F.min("doc_id").alias("first"))
    firsts = _written(firsts, "sources")
    late = late_spans(found, width)
    text: Column = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    own = docs.filter("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.sha2(text, 256).alias("digest")
    )
    marks = firsts.join(late, "source", "left").select("digest", "first", "starts")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, doc_id, first, starts in zip(
                batch["text"], batch["doc_id"], batch["first"], batch["starts"]
            ):
                n = len(text)
                if doc_id > first and n >= width:  # a copy
                    out.append((b"", n, [{"start": 0, "length": n}]))
                    continue
                if starts is None or not len(starts):
                    out.append((text, n, []))
                    continue
                edges = np.zeros(n + 1, dtype=np.int64)
                at = np.array([x["start"] for x in starts], dtype=np.int64)
                end = at + np.array([x["length"] for x in starts], dtype=np.int64) + width - 1
                np.add.at(edges, at, 1)
                np.subtract.at(edges, end, 1)
                gone = np.cumsum(edges)[:n] > 0
                change = np.flatnonzero(np.diff(np.r_[0, gone.astype(np.int8), 0]))
                spans = [
                    {"start": int(a), "length": int(b - a)} for a, b in zip(change[::2], change[1::2])
                ]
                kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
                out.append((kept, n, spans))
            result = pd.DataFrame(out, columns=["kept", "n_bytes", "spans"])
            result.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield result

    return own.join(marks, "digest").mapInPandas(run, f"doc_id long, kept binary, n_bytes long, spans {SPANS}")


def digests(result: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    lengths = F.transform("spans", lambda s: s["length"].cast("long"))
    return result.select(
        "doc_id",
        "n_bytes",
        F.aggregate(lengths, F.lit(0).cast("long"), lambda a, b: a + b).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
