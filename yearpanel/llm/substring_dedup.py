"""Substring dedup by hashing units: sentences, lines, runs of short ones, and whole texts.

A text is tiled into units that end at a line break or after a sentence mark. Units are normalised
and hashed, digests are grouped over the whole table, the earliest place keeps a unit and every
later one loses it. Short units repeat by chance, so three in a row are hashed as one, and so is
the whole text. A passage goes if the units in a row that go have enough words together: a sentence
that many documents share is no repeated passage. Spans are given in the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearpanel.llm.common import keyed_texts, small
from yearpanel.sources.scratch import discard, materialise

UNIT = r"[^.!?\n]*[.!?\n]+[ \t]*|[^.!?\n]+"
#: Units with fewer words and characters are short ones.
MIN_WORDS, MIN_CHARS = 6, 40
#: Short units that are hashed as one.
ROW = 3
#: Words that units in a row need to go. A text that repeats whole goes with any.
MIN_RUN = 20
#: The number that stands for a whole text.
WHOLE = -1

SPANS = "array<struct<start:int,length:int>>"


def units(text: str) -> list[str]:
    """The tiles of a text; joined they are the text."""
    return re.findall(UNIT, text)


def normalised(unit: str) -> str:
    """Lower case, one blank for any white space."""
    return " ".join(unit.lower().split())


def words(plain: str) -> int:
    return plain.count(" ") + 1 if plain else 0


def is_long(plain: str) -> bool:
    return words(plain) >= MIN_WORDS or len(plain) >= MIN_CHARS


def keys(text: str) -> Iterator[tuple[int, int, int, int]]:
    """Number, how many units, and two halves of the digest of what is hashed in a text: long
    units, ROW short ones that have the words of a long one, and the text as a whole."""
    plain = [normalised(unit) for unit in units(text)]
    long = [is_long(p) for p in plain]

    def hashed(kind: str, content: str) -> tuple[int, int]:
        value = xxhash.xxh3_128_intdigest(f"{kind}\x00{content}")
        return (value >> 64) - (1 << 63), (value & (1 << 64) - 1) - (1 << 63)

    for k, own in enumerate(plain):
        if long[k]:
            yield k, 1, *hashed("unit", own)
        elif k + ROW <= len(plain) and not any(long[k : k + ROW]):
            if sum(map(words, plain[k : k + ROW])) >= MIN_WORDS:
                yield k, ROW, *hashed("row", "\x00".join(plain[k : k + ROW]))
    whole = normalised(text)
    if whole:
        yield WHOLE, 1, *hashed("whole", whole)


def split(text: str, gone: set[tuple[int, int]]) -> tuple[str, list[dict], int]:
    """The kept text, the removed spans and the number of removed units.

    ``gone`` are the numbers and sizes of repeated ``keys``. Short units that no row of these holds
    go where the next others on both sides go.
    """
    tiles = units(text)
    plain = [normalised(unit) for unit in tiles]
    if any(k == WHOLE for k, _ in gone):
        return "", [{"start": 0, "length": len(text)}], len(tiles)
    held = {k + j for k, n in gone for j in range(n)}
    known = [True if k in held else False if is_long(p) else None for k, p in enumerate(plain)]
    behind: list[bool] = []
    for state in reversed(known):
        behind.append(bool(behind and behind[-1]) if state is None else state)
    before, at, kept, spans, n = False, 0, [], [], 0
    run: list[int] = []

    def ended() -> None:
        nonlocal n
        if sum(words(plain[k]) for k in run) >= MIN_RUN:
            n += len(run)
            spans.append({"start": at - sum(len(tiles[k]) for k in run), "length": sum(len(tiles[k]) for k in run)})
        else:
            kept.extend(tiles[k] for k in run)
        run.clear()

    for k, unit in enumerate(tiles):
        before = before if known[k] is None else known[k]
        if before and behind[len(tiles) - 1 - k]:
            run.append(k)
        else:
            ended()
            kept.append(unit)
        at += len(unit)
    ended()
    return "".join(kept), spans, n


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, gone (unit, size), written: the ``keys`` of a text that an earlier place
    has.

    Places are ordered by doc_id, then text_key, then unit. Rows that repeat whole share their
    places and keep what they have. A row of units that overlaps its own first place stays.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (doc_id, key, *unit)
                for doc_id, key, text in batch.itertuples(index=False)
                for unit in keys(text)
            ]
            yield pd.DataFrame(rows, columns=["doc_id", "text_key", "unit", "size", "high", "low"])

    found = keyed_texts(docs).mapInPandas(
        run, "doc_id long, text_key long, unit int, size byte, high long, low long"
    )
    place = F.struct("doc_id", "text_key", "unit")
    places = materialise(found, "units")
    firsts = materialise(
        places.groupBy("high", "low")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter("first < last")
        .select("high", "low", "first"),
        "repeated-units",
    )
    text = F.struct("doc_id", "text_key")
    first = F.struct("first.doc_id", "first.text_key")
    apart = (text != first) | (F.col("unit") >= F.col("first.unit") + F.col("size"))
    found = (
        places.join(small(firsts), ["high", "low"])
        .filter(apart)
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set(F.struct("unit", "size")).alias("gone"))
    )
    gone = materialise(found, "removed-units")
    discard(places, firsts)
    return gone


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, kept_text, spans, n_units, n_removed, one row per row with a doc_id.

    ``spans`` are (start, length) in characters of the original text, maximal and in order. An
    empty or null text has no unit. Rows without a doc_id have no rank and are left out. Other
    columns are dropped. An empty table gives no row.
    """
    gone = repeats(docs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, own in zip(batch["text"], batch["gone"]):
                none = own is None or len(own) == 0
                kept, spans, n = (text, [], 0) if none else split(text, {(x["unit"], x["size"]) for x in own})
                out.append((kept, spans, len(units(text)), n))
            result = pd.DataFrame(out, columns=["kept_text", "spans", "n_units", "n_removed"])
            result.insert(0, "text_key", batch["text_key"].to_numpy())
            result.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield result

    return (
        keyed_texts(docs)
        .join(gone, ["doc_id", "text_key"], "left")
        .mapInPandas(
            run,
            f"doc_id long, text_key long, kept_text string, spans {SPANS}, n_units long, "
            "n_removed long",
        )
    )


def digests(result: DataFrame) -> DataFrame:
    """doc_id, n_units, n_removed, removed_chars, n_spans, spans, kept_sha256."""
    lengths = F.transform("spans", lambda s: s["length"])
    written = F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["length"]))
    return result.select(
        "doc_id",
        "n_units",
        "n_removed",
        F.aggregate(lengths, F.lit(0).cast("long"), lambda a, b: a + b).alias("removed_chars"),
        F.size("spans").cast("long").alias("n_spans"),
        F.concat_ws(",", written).alias("spans"),
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )
