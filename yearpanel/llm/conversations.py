"""Repair of conversation structure by a run-length dynamic program.

A repaired conversation's roles read ``(s?(ua)+)?``. Every row is a symbol, its role's initial and
its fault, and equal consecutive symbols are one run. What it costs to go on from each state of the
grammar is a vector of four numbers; a row turns the vector behind it into the one before it by a
min-plus product, and a run of n equal rows by the powers 1, 2, 4, ... of that transition which n
is the sum of. The powers are kept. Where the cheapest edits are is then read off forwards.

A conversation may hold any share of all rows. Rows are numbered by a range sort, which splits it
over many tasks, and cut into blocks of bounded size. Blocks are multiplied into one transition
each, in parallel. Only these small transitions, last block first, and then the rows themselves,
once and in order, as their hash asks for, pass through one task per conversation. That task holds
one block at a time.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearpanel.llm.common import small
from yearpanel.sources.scratch import materialise

WHITE = " \t\n\x0b\x0c\r"
NAMED = ("user", "assistant")
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Initials of neighbours.
LEGAL = ("su", "ua", "au")
#: Rows of a block at most, as a power of two.
BLOCK_BITS = 16

# Faults of a row. Symbols are a role's initial (s, u, a, or o for others) and a fault.
NONE, BLANK, DUPLICATE, CUT = "n", "b", "d", "t"

# States: nothing yet, after s, after u, after a. The role that each lets follow.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
SAYS = tuple(NAMED[state - USER] for state in NEXT)
ACCEPTS = (START, ASSISTANT)
FAR = 1 << 60

Vector = tuple[int, ...]


# --- the transitions ---------------------------------------------------------------------------


def _inserted(costs: Vector) -> Vector:
    """Costs to go when rows may be inserted first. Three insertions reach every state."""
    out = []
    for state in range(4):
        best = costs[state]
        at, paid = state, 0
        for _ in range(3):
            at, paid = NEXT[at], paid + INSERT
            best = min(best, costs[at] + paid)
        out.append(min(best, FAR))
    return tuple(out)


#: Costs to go behind the last row.
END = _inserted(tuple(0 if state in ACCEPTS else FAR for state in range(4)))


def choices(symbol: str, state: int) -> list[tuple[str, int, int, str | None]]:
    """Edit, cost, next state and new role of what can be done with a row, by initials."""
    initial, fault = symbol
    found: list[tuple[str, int, int, str | None]] = [("D", DELETE, state, None)]
    if fault in (BLANK, DUPLICATE):
        return found
    more = TRUNCATED if fault == CUT else 0
    if initial == "s" and state == START:
        found.append(("K", KEEP + more, SYSTEM, None))
    elif initial == "ua"[NEXT[state] - USER]:
        found.append(("K", KEEP + more, NEXT[state], None))
    found.append(("R", REROLE + more, NEXT[state], SAYS[state]))
    return found


@functools.lru_cache(maxsize=100_000)
def _step(symbol: str, after: Vector) -> Vector:
    """Costs to go before a row from those behind it."""
    return _inserted(
        tuple(min(cost + after[to] for _, cost, to, _ in choices(symbol, q)) for q in range(4))
    )


Matrix = tuple[Vector, ...]
UNIT: Matrix = tuple(tuple(0 if a == b else FAR for b in range(4)) for a in range(4))


def product(left: Matrix, right: Matrix) -> Matrix:
    """Min-plus: first ``left``, then ``right``."""
    return tuple(
        tuple(min(FAR, *(row[k] + right[k][b] for k in range(4))) for b in range(4)) for row in left
    )


def applied(matrix: Matrix, after: Vector) -> Vector:
    return tuple(min(FAR, *(row[k] + after[k] for k in range(4))) for row in matrix)


@functools.lru_cache(maxsize=None)
def power(symbol: str, k: int) -> Matrix:
    """The transition of 2 ** k equal rows."""
    if k:
        half = power(symbol, k - 1)
        return product(half, half)
    columns = [_step(symbol, UNIT[to]) for to in range(4)]
    return tuple(tuple(columns[to][q] for to in range(4)) for q in range(4))


def powers(symbol: str, length: int) -> Iterator[Matrix]:
    """The cached powers that make up a run; their order does not matter."""
    for k in range(length.bit_length()):
        if length >> k & 1:
            yield power(symbol, k)


def runs(symbols: str, copies: list[int]) -> list[tuple[str, int]]:
    """Symbols with their numbers, equal neighbours collapsed. ``copies`` of a row are equal whole:
    all but the first are duplicates. ``symbols`` has two characters for each row."""
    found: list[list] = []
    for k, n in enumerate(copies):
        symbol = symbols[2 * k : 2 * k + 2]
        repeat = symbol if symbol[1] in (BLANK, DUPLICATE) else symbol[0] + DUPLICATE
        for part, number in ((symbol, 1), (repeat, n - 1)):
            if number and found and found[-1][0] == part:
                found[-1][1] += number
            elif number:
                found.append([part, number])
    return [(symbol, n) for symbol, n in found]


def transition(parts: list[tuple[str, int]]) -> Matrix:
    """The transition of a whole block."""
    out = UNIT
    for symbol, n in parts:
        for matrix in powers(symbol, n):
            out = product(out, matrix)
    return out


# --- reading off the edits ---------------------------------------------------------------------

#: For each row that may be kept: roles inserted before it, and its role ("" as it was, None gone).
Kept = tuple[tuple[str, ...], str | None]


def _cheapest(symbol: str, before: Vector, after: Vector, state: int) -> tuple[str, int, Kept]:
    """Edits up to and including a row that are cheapest and ASCII-least; D < I < K < R."""
    audit, roles = "", []
    while True:
        own = {edit: (cost, to, role) for edit, cost, to, role in choices(symbol, state)}
        for edit in "DIKR":
            if edit == "I":
                if INSERT + before[NEXT[state]] == before[state]:
                    audit += "I"
                    roles.append(SAYS[state])
                    state = NEXT[state]
                    break
            elif edit in own and own[edit][0] + after[own[edit][1]] == before[state]:
                role = None if edit == "D" else own[edit][2] or ""
                return audit + edit, own[edit][1], (tuple(roles), role)


@functools.lru_cache(maxsize=100_000)
def _unrolled(symbol: str, n: int, state: int, end: Vector) -> tuple[str, int, list[Kept]]:
    """Audit, next state and rows of a run whose costs behind it are ``end``."""
    costs = [end]
    for _ in range(n):
        costs.append(_step(symbol, costs[-1]))
    audit, rows = [], []
    for k in range(n, 0, -1):
        edits, state, row = _cheapest(symbol, costs[k], costs[k - 1], state)
        audit.append(edits)
        rows.append(row)
    return "".join(audit), state, rows


def unrolled(
    parts: list[tuple[str, int]], state: int, end: Vector
) -> tuple[str, int, int, list[Kept]]:
    """Audit, cost, next state and the rows that are not blank or duplicate of a block."""
    behind = [end]
    for symbol, n in reversed(parts):
        costs = behind[-1]
        for matrix in powers(symbol, n):
            costs = applied(matrix, costs)
        behind.append(costs)
    audit, rows, total = [], [], behind[-1][state]
    for (symbol, n), costs in zip(parts, reversed(behind[:-1])):
        if symbol[1] in (BLANK, DUPLICATE):
            audit.append("D" * n)
            continue
        least = min(costs)
        edits, state, own = _unrolled(symbol, n, state, tuple(c - least for c in costs))
        audit.append(edits)
        rows += own
    return "".join(audit), total - end[state], state, rows


def ended(state: int) -> list[str]:
    """Roles inserted behind the last row."""
    roles = []
    while state not in ACCEPTS:
        roles.append(SAYS[state])
        state = NEXT[state]
    return roles


# --- rows --------------------------------------------------------------------------------------


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv, turn, role, text, copies: rows with damage that depends on conv_id and turn.

    ``conv`` is the conv_id as text. Nulls are one space, but for the turn, which stays null.
    """
    turn = F.col("turn").cast("long")
    conv = F.coalesce(F.col("conv_id").cast("long").cast("string"), F.lit(" "))
    key = F.concat_ws(":", conv, F.coalesce(turn.cast("string"), F.lit(" ")))
    text = _text("text")
    harm = F.crc32(key.cast("binary")) % 20
    return conversations.select(
        conv.alias("conv"),
        turn.alias("turn"),
        F.when(harm == 4, "user").otherwise(_text("role")).alias("role"),
        F.when(harm == 1, "").when(harm == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(harm == 0, 0).when(harm == 3, 2).otherwise(1).cast("long").alias("copies"),
    ).filter("copies > 0")


#: What orders the rows of a conversation. Whole rows that repeat are one row with copies.
ORDER = ["conv", "turn", "role_head", "text_head", "high", "low"]


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "role_head": F.left("role", F.lit(64)),
            "text_head": F.left("text", F.lit(64)),
            "high": F.xxhash64("role", "text"),
            "low": F.xxhash64(F.lit("low"), "text", "role"),
        }
    )


def _ordered(rows: DataFrame) -> DataFrame:
    """ORDER, place, symbol, copies: different rows in order, without their texts.

    ``place`` grows within a conversation, without being gapless.
    """
    body = F.btrim("text", F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    own = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    fault = (
        F.when(body == "", BLANK)
        .when(F.right(body, F.lit(1)).isin(".", "!", "?"), NONE)
        .otherwise(CUT)
    )
    narrow = rows.select(*ORDER, own.alias("initial"), fault.alias("fault"), "copies")
    different = narrow.groupBy(*ORDER, "initial", "fault").agg(F.sum("copies").alias("copies"))
    ranged = different.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    placed = materialise(
        ranged.withColumn("place", F.monotonically_increasing_id()), "conversation-rows"
    )
    text = ["conv", "high", "low"]
    seen = (
        placed.groupBy(*text)
        .agg(F.min("place").alias("first"), F.max("place").alias("last"))
        .filter("first < last")
        .select(*text, "first")
    )
    found = placed.join(small(materialise(seen, "conversation-repeats")), text, "left")
    late = (F.col("place") > F.col("first")) & (F.col("fault") != BLANK)
    kind = F.when(late, DUPLICATE).otherwise(F.col("fault"))
    return found.select(*ORDER, "place", "copies", F.concat("initial", kind).alias("symbol"))


BACK = "conv string, block long, costs array<long>"


def _blocks(ordered: DataFrame, block_bits: int) -> DataFrame:
    """ORDER of the first row, block, symbols, copies, costs: what rows of a block are, in order,
    and the costs to go behind it. A block has a bounded number of rows."""
    row = F.struct("place", "symbol", "copies", F.struct(*ORDER[1:]).alias("key"))
    grouped = ordered.groupBy("conv", F.shiftright("place", block_bits).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("place", "symbol", "copies"))).alias("rows"),
        F.min(row).alias("first"),
    )
    blocks = materialise(
        grouped.select(
            "conv",
            "first.key.*",
            "block",
            F.array_join(F.transform("rows", lambda r: r["symbol"]), "").alias("symbols"),
            F.transform("rows", lambda r: r["copies"]).alias("copies"),
        ),
        "conversation-blocks",
    )
    several = blocks.groupBy("conv").agg(F.count("*").alias("n")).filter("n > 1").select("conv")
    several = materialise(several, "conversations-in-blocks")

    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                [x for row in transition(runs(symbols, [int(n) for n in copies])) for x in row]
                for symbols, copies in zip(batch["symbols"], batch["copies"])
            ]
            yield batch[["conv", "block"]].assign(matrix=found)

    def backwards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, costs = None, END
        for batch in batches:
            out = []
            for conv, block, flat in zip(batch["conv"], batch["block"], batch["matrix"]):
                if conv != at:
                    at, costs = conv, END
                out.append((conv, block, list(costs)))
                numbers = [int(x) for x in flat]
                costs = applied(tuple(tuple(numbers[k : k + 4]) for k in range(0, 16, 4)), costs)
            yield pd.DataFrame(out, columns=["conv", "block", "costs"])

    behind = (
        blocks.join(small(several), "conv", "left_semi")
        .select("conv", "block", "symbols", "copies")
        .mapInPandas(matrices, "conv string, block long, matrix array<long>")
        .repartition("conv")
        .sortWithinPartitions("conv", F.desc("block"))
        .mapInPandas(backwards, BACK)
    )
    behind = small(materialise(behind, "conversation-costs"))
    return blocks.join(behind, ["conv", "block"], "left")


@dataclass
class Repair:
    """A conversation whose rows arrive in order."""

    conv: str
    turns: list[int] = field(default_factory=list)  # first, last, how many differ
    counts: dict[str, int] = field(default_factory=lambda: dict.fromkeys((BLANK, DUPLICATE, CUT), 0))
    illegal: int = 0
    cost: int = 0
    audit: list[str] = field(default_factory=list)
    state: int = START
    last: str = ""
    rows: Iterator[Kept] = field(default_factory=lambda: iter(()))
    key: tuple | None = None
    lines: int = 0
    hashed: object = field(default_factory=hashlib.sha256)

    def block(self, symbols: str, copies: list[int], costs: list[int] | None) -> None:
        parts = runs(symbols, copies)
        end = END if costs is None else tuple(costs)
        audit, cost, self.state, kept = unrolled(parts, self.state, end)
        self.audit.append(audit)
        self.cost += cost
        for symbol, n in parts:
            if symbol[1] in self.counts:
                self.counts[symbol[1]] += n
            self.illegal += n - 1 + (bool(self.last) and self.last + symbol[0] not in LEGAL)
            self.last = symbol[0]
        kinds = (symbols[k + 1] for k in range(0, len(symbols), 2))
        found = iter(kept)
        self.rows = iter([((), None) if kind in (BLANK, DUPLICATE) else next(found) for kind in kinds])

    def row(self, key: tuple, turn: int | None, role: str, text: str) -> None:
        if key == self.key:
            return  # repeats whole
        self.key = key
        if turn is not None:
            if not self.turns:
                self.turns = [turn, turn, 1]
            elif turn != self.turns[1]:
                self.turns[1:] = [turn, self.turns[2] + 1]
        inserted, own = next(self.rows)
        for name in inserted:
            self._line(name, "")
        if own is not None:
            self._line(own or role, text)

    def _line(self, role: str, text: str) -> None:
        self.hashed.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.lines += 1

    def finished(self) -> tuple:
        roles = ended(self.state)
        for name in roles:
            self._line(name, "")
        gaps = self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns else 0
        found = (self.counts[BLANK], self.counts[DUPLICATE], self.counts[CUT])
        cost = self.cost + INSERT * len(roles)
        audit = "".join(self.audit) + "I" * len(roles)
        return self.conv, min(gaps, (1 << 63) - 1), *found, self.illegal, cost, audit, self.hashed.hexdigest()


RESULT = pa.schema(
    [("conv", pa.string())]
    + [(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string()), ("repaired_sha256", pa.string())]
)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at: Repair | None = None
    for batch in batches:
        done = []
        for conv, kind, turn, high, low, role, text, symbols, copies, costs in zip(
            *(column.to_pylist() for column in batch.columns)
        ):
            if at is None or conv != at.conv:
                if at is not None:
                    done.append(at.finished())
                at = Repair(conv)
            if kind == 0:
                at.block(symbols, copies, costs)
            else:
                at.row((turn, high, low), turn, role, text)
        if done:
            yield _batch(done)
    if at is not None:
        yield _batch([at.finished()])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), RESULT)], schema=RESULT
    )


def repaired(conversations: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    One row for every conv_id, null included; a conversation without a row after damage has zeros
    and empty texts. Rows are ordered by turn, nulls first, then role and text (the first 64
    characters of each, then hashes); rows that repeat whole are neighbours, and all but the first
    are duplicates. Gaps beyond the largest long are given as that. A role that is empty has no initial and is kept nowhere. Other columns are
    dropped. An empty table gives no row.
    """
    rows = _keyed(damaged(conversations))
    blocks = _blocks(_ordered(rows), block_bits)
    none = {n: F.lit(None).cast("string") for n in ("role", "text", "symbols")}
    heads = blocks.withColumns(
        {"kind": F.lit(0), "role": none["role"], "text": none["text"]}
    )
    texts = rows.withColumns(
        {
            "kind": F.lit(1),
            "symbols": none["symbols"],
            "copies": F.lit(None).cast("array<long>"),
            "costs": F.lit(None).cast("array<long>"),
        }
    )
    columns = [*ORDER, "kind", "role", "text", "symbols", "copies", "costs"]
    stream = heads.select(*columns).unionByName(texts.select(*columns))
    order = [*ORDER, "kind"]
    needed = ["conv", "kind", "turn", "high", "low", "role", "text", "symbols", "copies", "costs"]
    found = (
        stream.repartition("conv")
        .sortWithinPartitions(*order)
        .select(*needed)
        .mapInArrow(_repaired, ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in RESULT))
    )
    conv = F.coalesce(F.col("conv_id").cast("long").cast("string"), F.lit(" "))
    ids = conversations.select(conv.alias("conv")).distinct()
    zero = [F.coalesce(f.name, F.lit(0).cast("long")).alias(f.name) for f in RESULT if f.type == pa.int64()]
    empty = hashlib.sha256().hexdigest()
    return ids.join(found, "conv", "left").select(
        F.when(F.col("conv") != " ", F.col("conv")).cast("long").alias("conv_id"),
        *zero,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )
