from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from yearpanel.llm import sharding
from yearpanel.llm.sharding import Block


def test_the_flow_moves_the_fewest_bytes():
    rng = random.Random(4)
    for _ in range(25):
        shards = rng.randint(1, 3)
        rows = [(rng.randint(-1, 3), rng.randint(1, 40)) for _ in range(rng.randint(1, 5))]
        blocks = [Block(old, k, 1, size) for k, (old, size) in enumerate(rows)]
        most = sharding.even_capacities(blocks, shards)
        moved = sum(
            b.bytes for b in blocks for o, c, s, *_ in sharding.transfers(blocks, most)
            if (o, c) == (b.old, b.size_class) and s != b.old
        )
        costs = []
        for choice in itertools.product(range(shards), repeat=len(blocks)):
            filled = Counter(choice)
            if all(filled[s] == most[s] for s in range(shards)):
                costs.append(sum(b.bytes for b, s in zip(blocks, choice) if s != b.old))
        assert moved == min(costs)


def test_transfers_cut_blocks_into_whole_intervals():
    blocks = [Block(0, 5, 70, 2240), Block(0, 9, 30, 15360), Block(1, 5, 7, 224), Block(9, 5, 11, 352)]
    plan = sharding.transfers(blocks, sharding.even_capacities(blocks, 4))
    for b in blocks:
        own = sorted((low, high) for o, c, _, low, high in plan if (o, c) == (b.old, b.size_class))
        assert own[0][0] == 0 and own[-1][1] == b.rows
        assert all(x[1] == y[0] for x, y in zip(own, own[1:]))
    assert (0, 9, 0, 0, 30) in plan  # large rows stay
    with pytest.raises(ValueError):
        sharding.transfers(blocks, [1])


@pytest.mark.parametrize("name, shards", [("documents", 4), ("documents", 40), ("odd_documents", 2)])
def test_shards_of_a_table(request, monkeypatch, name, shards):
    monkeypatch.setattr(sharding, "CELL_ROWS", 3)
    docs = request.getfixturevalue(name)
    old = F.pmod(F.crc32(F.coalesce("source", F.lit(""))), F.lit(3))
    found = sharding.resharded(docs, old, shards)
    rows = found.collect()
    n, sizes = docs.count(), Counter(r.shard for r in rows)
    assert len(rows) == n and all(n // shards <= sizes[s] <= -(-n // shards) for s in range(shards))
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in docs.collect())
    for r in sharding.shard_digests(found).collect():
        assert (r.law, r.grown_shard) == ("rows", None)
    digests = Counter((r.doc_id, r["size"], r.text_crc32) for r in sharding.shard_digests(found).collect())
    texts = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    assert digests == Counter((i, len(t) + 16, zlib.crc32(t)) for i, t in texts)


def test_only_changed_shards_are_rewritten(spark, tmp_path, documents):
    even = sharding.assigned(documents, F.lit(0), 1)
    assert sharding.changed(even, 1) == []
    spread = sharding.assigned(documents, F.lit(0), 3)
    assert sharding.changed(spread, 3) == [0, 1, 2]
    sharding.write_shards(spread, str(tmp_path / "s"), only=[1])
    assert [p.name for p in (tmp_path / "s").glob("shard=*")] == ["shard=1"]


def _held(spark, folder):
    rows = spark.read.parquet(folder).collect()
    out = {}
    for r in rows:
        out.setdefault(r.shard, []).append(r)
    for k, own in out.items():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    return out


def _files(folder):
    return {p.parent.name: p.name for p in sorted(folder.glob("shard=*/part-*"))}


def test_only_affected_files_are_rewritten_in_place(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 3)
    docs = spark.createDataFrame([(k, "a" * (k % 50)) for k in range(60)], "doc_id long, text string")
    old = F.when(F.col("doc_id") < 20, 0).when(F.col("doc_id") < 40, 1).when(F.col("doc_id") < 55, 2)
    place = tmp_path / "shards"
    folder = str(place)
    slots = F.row_number().over(Window.partitionBy(old).orderBy("doc_id")) - 1
    sharding.write_shards(docs.withColumns({"shard": F.coalesce(old, F.lit(3)), "slot": slots}), folder)
    before = _files(place)
    assert sharding.rebalanced(spark, folder, 4, [20, 20, 10, 10]) == [2, 3]
    after = _files(place)
    assert all(before[k] == after[k] for k in ("shard=0", "shard=1"))
    assert all(before[k] != after[k] for k in ("shard=2", "shard=3"))
    held = _held(spark, folder)
    assert {k: len(v) for k, v in held.items()} == {0: 20, 1: 20, 2: 10, 3: 10}
    assert sharding.rebalanced(spark, folder, 4, [20, 20, 10, 10]) == []
    # Fewer shards: the rows of those that vanish move, their folders go.
    assert sharding.rebalanced(spark, folder, 2, [40, 20]) == [0]
    held = _held(spark, folder)
    assert {k: len(v) for k, v in held.items()} == {0: 40, 1: 20}
    assert Counter((r.doc_id, r.text) for v in held.values() for r in v) == Counter(map(tuple, docs.collect()))
    # More shards, and one that is emptied.
    sharding.rebalanced(spark, folder, 3, [0, 30, 30])
    held = _held(spark, folder)
    assert {k: len(v) for k, v in held.items()} == {1: 30, 2: 30}
    assert Counter((r.doc_id, r.text) for v in held.values() for r in v) == Counter(map(tuple, docs.collect()))


def test_rows_without_a_shard_and_empty_folders(spark, tmp_path):
    folder = str(tmp_path / "shards")
    rows = [(None, "x", None), (1, None, 0), (1, None, 0), (2, "", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    slots = F.row_number().over(Window.partitionBy("shard").orderBy("doc_id")) - 1
    sharding.write_shards(docs.withColumn("slot", slots), folder)
    assert sharding.rebalanced(spark, folder, 2) == [1]
    held = _held(spark, folder)
    assert {k: len(v) for k, v in held.items()} == {0: 2, 1: 2}
    assert sorted(p.name for p in (tmp_path / "shards").glob("shard=*")) == ["shard=0", "shard=1"]
    empty = tmp_path / "empty"
    empty.mkdir()
    assert sharding.rebalanced(spark, str(empty), 2) == []


def test_cells_are_bounded_by_rows_and_bytes(spark, monkeypatch):
    assert sharding._cells(Block(0, 20, 100, 100 << 20)) == 13
    assert sharding._cells(Block(0, 5, 20_000, 20_000 << 5)) == 5
    monkeypatch.setattr(sharding, "CELL_BYTES", 1000)
    rows = spark.createDataFrame([(None, f"{k} " + "z" * 100) for k in range(200)], "doc_id long, text string")
    found = sharding.assigned(rows, F.lit(0), 1).collect()
    assert sorted(r.slot for r in found) == list(range(200))  # rows without an id share no cell


def test_no_rows(no_documents):
    assert sharding.resharded(no_documents, F.lit(0), 4).count() == 0
