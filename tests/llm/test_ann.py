from __future__ import annotations

import numpy as np
import pytest

from yearpanel.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, score int, leaf string"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8))
    rows = []
    for k in range(600):
        x = centres[k % 12] + 0.3 * rng.normal(size=8)
        rows.append((k, [float(v) for v in x.astype(np.float32)], 1, None, "x"))
    same = rows[1][1]
    rows += [(k, same, 1, None, None) for k in range(1000, 1060)]  # many copies of one vector
    rows += [
        (2000, None, 1, None, None),
        (2020, [], 1, None, None),
        (2040, [0.0] * 8, 1, None, None),
        (2060, [1.0] * 7 + [None], 1, None, None),
        (2080, [1.0] * 7 + [float("nan")], 1, None, None),
        (2100, [1.0] * 7 + [float("inf")], 1, None, None),
        (2120, [1.0] * 5, 1, None, None),
        (None, same, 1, None, None),
        rows[40],
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def brute(vectors, every, k):
    good, size = {}, len(vectors.first().embedding)
    for r in vectors.collect():
        x = r.embedding
        if r.vec_id is not None and x and len(x) == size and None not in x and np.isfinite(x).all() and any(x):
            good[r.vec_id] = np.array(x, dtype=float)
    ids = np.array(sorted(good))
    x = np.stack([good[i] for i in ids])
    out = {}
    for q in ids[ids % every == 0]:
        scores = ann.products(good[q][None], x)[0]
        own = ids != q
        order = np.lexsort((ids[own], -scores[own]))[:k]
        out[int(q)] = list(zip(ids[own][order].tolist(), scores[own][order].tolist()))
    return out


def test_neighbours(vectors, monkeypatch):
    monkeypatch.setattr(ann, "CELL_VECTORS", 50)
    monkeypatch.setattr(ann, "CELL_QUERIES", 10)
    truth = brute(vectors, 20, 20)
    found = {}
    for r in sorted(ann.search(vectors).collect()):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(found) == set(truth)
    hits = sum(len({i for i, _ in truth[q]} & {i for i, _ in found[q]}) for q in truth)
    assert hits >= 0.9 * sum(map(len, truth.values()))
    for q, own in found.items():
        assert len(own) == 20 and q not in {i for i, _ in own}
        assert own == sorted(own, key=lambda p: (-p[1], p[0]))


def test_all_candidates_if_there_are_fewer(spark):
    rows = [(k, [float(k + 1), 1.0], 0, None, None) for k in range(6)]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = ann.search(frame, every=2).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in found[:5]] == [
        (0, k + 1, 5 - k, float(6 - k) + 1) for k in range(5)
    ]
    assert len(found) == 15
    assert ann.search(frame.limit(1)).count() == 0


def test_no_usable_vector(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert ann.search(empty).count() == 0
    assert ann.search(spark.createDataFrame([(0, None, 1, 1, "")], SCHEMA)).count() == 0


def test_leaves_come_in_the_order_of_the_queue():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    tree = ann.build_tree(x, float(np.sqrt((x * x).sum(1).max())))
    assert len(tree.leaf_ids) > 20
    assert set(tree.leaf_of(x)) <= set(tree.leaf_ids.tolist())
    ((order, reach),) = tree.leaves(x[:1])
    assert sorted(order) == sorted(tree.leaf_ids.tolist())
    assert reach == sorted(reach) and reach[0] == 0
    ((few, _),) = tree.leaves(x[:1], lambda own, _: len(own) >= 7)
    assert few == order[:7]
    ((near, _),) = tree.leaves(x[:1], lambda _, farther: farther > reach[20])
    assert near[:21] == order[:21] and len(near) < len(order)


def test_alike_vectors_are_one_leaf():
    tree = ann.build_tree(np.ones((500, 4)), 2.0)
    assert tree.leaf_ids.tolist() == [0] and set(tree.leaf_of(np.ones((3, 4)))) == {0}


def recalls(vectors, every=20, k=20):
    """Share of the exact neighbours that each query finds, by their scores."""
    truth = brute(vectors, every, k)
    found = {}
    for r in ann.search(vectors, every, k).collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert all(len(found[q]) == len(truth[q]) for q in truth)
    least = {q: own[-1][1] for q, own in truth.items()}
    return [sum(s >= least[q] for _, s in found[q]) / len(truth[q]) for q in truth]


def test_every_query_gets_its_rows_among_many_copies(spark):
    """20 vectors 300 times each, and 100 alone: a lone one's leaf may hold no other vector."""
    rng = np.random.default_rng(5)
    few, lone = rng.normal(size=(20, 8)), 3 * rng.normal(size=(100, 8))
    x = np.concatenate([np.repeat(few, 300, axis=0), lone])
    rows = [(k, row.tolist(), 1, None, "") for k, row in enumerate(x)]
    found = recalls(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert min(found) > 0 and np.mean(found) >= 0.9


def test_the_worst_query_among_clusters(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(60, 8))
    x = np.repeat(centres, 101, axis=0) + 0.15 * rng.normal(size=(6060, 8))
    rows = [(k, row.tolist(), 1, None, "") for k, row in enumerate(x)]
    found = recalls(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert min(found) > 0 and np.mean(found) >= 0.9


def test_recall_on_a_whole_table(spark):
    found = recalls(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet"))
    assert min(found) > 0 and np.mean(found) >= 0.9
