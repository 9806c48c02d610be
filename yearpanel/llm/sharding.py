"""Resharding by minimum-cost flow.

Rows of an old shard are put into blocks by the size of their text. Blocks are the sources of a
flow network and new shards its sinks. Staying costs nothing, moving a row costs its block's mean
size, so that the cheapest flow fills every new shard to its capacity and moves the fewest bytes.
The network has a node for each old shard and power of two, whatever the number of rows. Transfers
are intervals of a block's rows; Spark numbers the rows of small cells, finds each row's interval
and place, and rewrites the shards that change. ``rebalanced`` does so in place: the files of other
shards are neither read nor written.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from yearpanel.llm.common import small
from yearpanel.sources.scratch import delete_folder, discard, materialise, scratch_path

#: Bytes that a row takes besides its text.
ROW_BYTES = 16
#: Rows and bytes of a cell, the unit that one task numbers. A single row may have more bytes.
CELL_ROWS = 5_000
CELL_BYTES = 8 << 20
#: Rows and bytes of neighbouring cells that are dealt together.
BATCH_ROWS = 5_000
BATCH_BYTES = 32 << 20

BLOCK = ["_old", "_class"]
CELL = [*BLOCK, "_cell"]


@dataclass(frozen=True)
class Block:
    old: int
    size_class: int
    rows: int
    bytes: int


def min_cost_flow(n: int, arcs: Sequence[tuple[int, int, int, int]], s: int, t: int) -> list[int]:
    """The flow on each arc (from, to, capacity, cost >= 0) of a cheapest largest flow from s to t.

    Successive shortest paths with potentials.
    """
    to, room, cost, out = [], [], [], [[] for _ in range(n)]
    for a, b, most, price in arcs:
        for x, y, r, c in ((a, b, most, price), (b, a, 0, -price)):
            out[x].append(len(to))
            to.append(y)
            room.append(r)
            cost.append(c)
    height = [0] * n
    while True:
        far = [None] * n
        far[s], by, heap = 0, [None] * n, [(0, s)]
        while heap:
            d, x = heapq.heappop(heap)
            if d > far[x]:
                continue
            for e in out[x]:
                y = to[e]
                step = d + cost[e] + height[x] - height[y]
                if room[e] and (far[y] is None or step < far[y]):
                    far[y], by[y] = step, e
                    heapq.heappush(heap, (step, y))
        if far[t] is None:
            return [room[2 * k + 1] for k in range(len(arcs))]
        height = [h + (f if f is not None else 0) for h, f in zip(height, far)]
        path, x = [], t
        while x != s:
            path.append(by[x])
            x = to[by[x] ^ 1]
        amount = min(room[e] for e in path)
        for e in path:
            room[e] -= amount
            room[e ^ 1] += amount


def even_capacities(blocks: Sequence[Block], shards: int) -> list[int]:
    """Row counts at most one apart. The shards that hold most rows already get one more."""
    held = [0] * shards
    for b in blocks:
        if 0 <= b.old < shards:
            held[b.old] += b.rows
    least, more = divmod(sum(b.rows for b in blocks), shards)
    largest = sorted(range(shards), key=lambda k: (-held[k], k))[:more]
    return [least + (k in largest) for k in range(shards)]


def transfers(blocks: Sequence[Block], capacities: Sequence[int]) -> list[tuple]:
    """(old, size_class, shard, low, high): the interval of a block's rows that a shard gets."""
    if sum(capacities) != sum(b.rows for b in blocks):
        raise ValueError("the capacities must add up to the rows")
    shards = len(capacities)
    start, end, pool = len(blocks) + shards, len(blocks) + shards + 1, len(blocks) + shards + 2
    arcs, stays, moves = [], {}, {}
    for k, b in enumerate(blocks):
        arcs.append((start, k, b.rows, 0))
        if 0 <= b.old < shards:
            stays[k] = len(arcs)
            arcs.append((k, len(blocks) + b.old, b.rows, 0))
        moves[k] = len(arcs)
        arcs.append((k, pool, b.rows, max(1, b.bytes // b.rows)))
    gains = {}
    for j, most in enumerate(capacities):
        gains[j] = len(arcs)
        arcs.append((pool, len(blocks) + j, most, 0))
        arcs.append((len(blocks) + j, end, most, 0))
    flow = min_cost_flow(pool + 1, arcs, start, end)
    open_shards = [[j, flow[gains[j]]] for j in range(shards) if flow[gains[j]]]
    out = []
    for k, b in enumerate(blocks):
        at = flow[stays[k]] if k in stays else 0
        if at:
            out.append((b.old, b.size_class, b.old, 0, at))
        left = flow[moves[k]]
        while left:
            part = min(left, open_shards[-1][1])
            out.append((b.old, b.size_class, open_shards[-1][0], at, at + part))
            at += part
            left -= part
            open_shards[-1][1] -= part
            if not open_shards[-1][1]:
                open_shards.pop()
    return out


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _blocked(docs: DataFrame, old_shard: Column) -> DataFrame:
    size = F.octet_length(_text()) + ROW_BYTES
    return docs.withColumns(
        {
            "_old": F.coalesce(old_shard.cast("int"), F.lit(-1)),
            "_class": F.floor(F.log2(size)).cast("int"),
            "_size": size.cast("long"),
        }
    )


def _blocks(blocked: DataFrame) -> list[Block]:
    """A block for each old shard and power of two."""
    counted = blocked.groupBy(*BLOCK).agg(F.count("*").alias("n"), F.sum("_size").alias("b"))
    return sorted((Block(*row) for row in counted.collect()), key=lambda b: (b.old, b.size_class))


def _cells(block: Block) -> int:
    """Cells of a block: few enough rows and bytes in each, on average."""
    return 1 + max(block.rows // CELL_ROWS, block.bytes // CELL_BYTES)


def assigned(
    docs: DataFrame, old_shard: Column, shards: int, capacities: Sequence[int] | None = None
) -> DataFrame:
    """The columns of ``docs`` and old_shard, shard, slot.

    ``capacities`` are the rows of each new shard, by default counts at most one apart.
    ``old_shard`` has a bounded number of values, and depends on the row's columns only; a null
    one is -1. Slots of a shard count from 0 without a gap. A null text has no bytes. Columns of
    ``docs`` with the names of added ones are replaced.
    """
    docs = docs.drop("old_shard", "shard", "slot")
    blocked = _blocked(docs, old_shard)
    blocks = _blocks(blocked)
    plan = transfers(blocks, capacities or even_capacities(blocks, shards)) if blocks else []
    return _placed(blocked, blocks, plan).select(*docs.columns, "old_shard", "shard", "slot")


def _placed(blocked: DataFrame, blocks: Sequence[Block], plan: Sequence[tuple]) -> DataFrame:
    """The rows of ``blocks`` with old_shard, shard and slot as the transfers of ``plan`` have it."""
    spark = blocked.sparkSession
    schema = "_old int not null, _class int not null, _cells int not null, _before double, _share double"
    per_block, before = [], 0.0
    for b in blocks:
        weight = max(b.rows / BATCH_ROWS, b.bytes / BATCH_BYTES)
        per_block.append((b.old, b.size_class, _cells(b), before, weight / _cells(b)))
        before += weight
    # Rows that share a doc_id, or have none, spread by their texts.
    numbered = blocked.join(F.broadcast(spark.createDataFrame(per_block, schema)), BLOCK).withColumn(
        "_cell", F.pmod(F.xxhash64("doc_id", _text()), "_cells").cast("int")
    )
    runs = _runs(numbered, plan)
    order = ["doc_id", "_size", F.crc32(_text())]
    # Ranges of cells would be even by rows only. Batches keep neighbours together, for few files.
    batch = F.floor(F.col("_before") + F.col("_cell") * F.col("_share"))
    in_cell = Window.partitionBy("_batch", *CELL).orderBy(*order)
    ranked = (
        numbered.withColumn("_batch", batch)
        .repartition("_batch")
        .withColumn("_rank", F.row_number().over(in_cell) - 1)
    )
    inside = (F.col("_rank") >= F.col("_low")) & (F.col("_rank") < F.col("_high"))
    return (
        ranked.join(runs, CELL)
        .filter(inside)
        .withColumns(
            {
                "old_shard": F.col("_old"),
                "shard": F.col("_shard"),
                "slot": F.col("_base") + F.col("_rank") - F.col("_low"),
            }
        )
    )


def _runs(numbered: DataFrame, plan: Sequence[tuple]) -> DataFrame:
    """For each cell and shard the cell's ranks that go there, and the slot of the first."""
    spark = numbered.sparkSession
    schema = "_old int, _class int, _shard int, low long, high long"
    intervals = F.broadcast(spark.createDataFrame(list(plan), schema))  # blocks and shards at most
    in_block = Window.partitionBy(*BLOCK).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    in_shard = (
        Window.partitionBy("_shard").orderBy(*CELL).rowsBetween(Window.unboundedPreceding, -1)
    )
    cells = materialise(numbered.groupBy(*CELL).agg(F.count("*").alias("n")), "shard-cells")
    placed = cells.withColumn("at", F.coalesce(F.sum("n").over(in_block), F.lit(0)))
    cut = (
        placed.join(intervals, BLOCK)
        .withColumns(
            {
                "_low": F.greatest(F.col("low") - F.col("at"), F.lit(0)),
                "_high": F.least(F.col("high") - F.col("at"), F.col("n")),
            }
        )
        .filter("_low < _high")
        .withColumn(
            "_base", F.coalesce(F.sum(F.col("_high") - F.col("_low")).over(in_shard), F.lit(0))
        )
        .select(*CELL, "_shard", "_low", "_high", "_base")
    )
    return small(materialise(cut, "shard-runs"))


def write_shards(assignment: DataFrame, folder: str, only: Sequence[int] | None = None) -> None:
    """Write assigned rows to one folder per shard, all shards or ``only`` those that change."""
    chosen = assignment if only is None else assignment.filter(F.col("shard").isin(list(only)))
    chosen.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "shard"
    ).parquet(folder)


def changed(assignment: DataFrame, shards: int) -> list[int]:
    """The shards whose rows are not the ones they had, from counts of moves between shards."""
    moves = assignment.filter("old_shard != shard").select("old_shard", "shard").distinct()
    found = {k for row in moves.collect() for k in row}  # pairs of shards
    return sorted(k for k in found if 0 <= k < shards)


def resharded(
    docs: DataFrame, old_shard: Column, shards: int, folder: str | None = None
) -> DataFrame:
    """``docs`` rewritten as shards of equal row counts, and read back with shard and slot."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "shards")
    assignment = assigned(docs, old_shard, shards)
    write_shards(assignment, folder)
    return spark.read.schema(assignment.schema).parquet(folder)


def rebalanced(
    spark: SparkSession, folder: str, shards: int, capacities: Sequence[int] | None = None
) -> list[int]:
    """Bring the shards below ``folder`` to ``shards`` ones in place; the shards that were rewritten.

    ``folder`` is as ``write_shards`` leaves it. Shards that neither give nor get rows keep their
    files, with the slots in them; they are only read to be counted. Columns stay as they are. Rows without a shard, or in
    shards from ``shards`` on, move. The rewritten shards are complete in the shared scratch folder
    before the first file is replaced, and are deleted there after the last one: what an interrupted
    run left undone is done by writing them again. A folder without files stays as it is.
    """
    try:
        held = spark.read.parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return []
    rows = held.drop("slot", "old_shard").withColumnRenamed("shard", "_from")
    blocked = _blocked(rows, F.col("_from"))
    blocks = _blocks(blocked)
    plan = transfers(blocks, capacities or even_capacities(blocks, shards)) if blocks else []
    changes = {k for old, _, shard, *_ in plan if old != shard for k in (old, shard)}
    if not changes:
        return []
    named = F.coalesce("_from", F.lit(-1)).isin(sorted(changes))  # prunes folders
    placed = _placed(
        blocked.filter(named),
        [b for b in blocks if b.old in changes],
        [part for part in plan if part[0] in changes],
    )
    # Files that stay and new ones have the same columns and types.
    same = [F.col(field.name).cast(field.dataType) for field in held.schema]
    staged = materialise(placed.select(*same), "shards")
    write_shards(staged, folder)
    filled = {shard for _, _, shard, *_ in plan}
    for k in changes - filled:
        name = "__HIVE_DEFAULT_PARTITION__" if k == -1 else k
        delete_folder(spark, f"{folder.rstrip('/')}/shard={name}")
    spark.catalog.refreshByPath(folder)
    discard(staged)
    return sorted(changes & filled)


def shard_digests(rows: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    return rows.select(
        "doc_id",
        (F.octet_length(_text()) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(_text()).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
