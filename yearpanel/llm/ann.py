"""Nearest neighbours by inner product through a hierarchical k-means tree.

The tree is built on a bounded sample, every vector is filed under a leaf. A query takes nodes
from a priority queue, nearest centre first, so that it meets the leaves best bin first. How many
leaves queries visit is calibrated: for some queries the exact neighbours are found by a scan, and
visits widen until the leaves visited hold the wanted share of them. A query goes farther by itself
while its leaves hold too few vectors, and while the next node is about as near as its first leaf.

For the tree, vectors get one more component that makes all of them equally long. The largest
inner product is then the smallest distance. Scores are those of the original vectors.

Spark joins queries and vectors in cells: a subtree, a share of its vectors and a share of the
queries that visit it. Cells have a bounded size however many vectors a leaf holds.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from yearpanel.sources.scratch import materialise

K = 20
#: Bounds of the sample for the tree: vectors, and numbers in them.
SAMPLE_VECTORS, SAMPLE_NUMBERS = 20_000, 4_000_000
#: Children of a node, and sample vectors of a leaf at most.
BRANCHES, LEAF_SAMPLE = 8, 64
#: Queries that visits are calibrated on, and the share of exact neighbours they must find.
CALIBRATION, TARGET = 128, 0.97
#: The share that each of these queries must find.
FLOOR = 0.5
#: Vectors and queries of a cell on average.
CELL_VECTORS, CELL_QUERIES = 4096, 2048
#: Queries that are scored at once.
QUERY_BLOCK = 256


@dataclass
class Tree:
    """Nodes in the order they were made; node 0 is the root."""

    centres: np.ndarray  # nodes x (dimension + 1)
    children: list[list[int]]
    subtree: np.ndarray  # for each node the ancestor (or itself) at depth 2 at most
    longest: float
    leaf_ids: np.ndarray = field(init=False)

    def __post_init__(self):
        self.leaf_ids = np.array([k for k, c in enumerate(self.children) if not c])

    def longer(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Vectors with the component that makes them equally long; queries get a zero."""
        if query:
            x = x / np.sqrt((x * x).sum(1, keepdims=True))
            return np.concatenate([x * self.longest, np.zeros((len(x), 1))], axis=1)
        rest = self.longest**2 - (x * x).sum(1, keepdims=True)
        return np.concatenate([x, np.sqrt(np.maximum(rest, 0))], axis=1)

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest child at every level."""
        x = self.longer(x)
        at = np.zeros(len(x), dtype=np.int64)
        moving = np.arange(len(x)) if self.children[0] else np.array([], dtype=int)
        while len(moving):
            for node in np.unique(at[moving]):
                own = moving[at[moving] == node]
                below = np.array(self.children[node])
                at[own] = below[_distances(x[own], self.centres[below]).argmin(1)]
            moving = moving[[bool(self.children[n]) for n in at[moving]]]
        return at

    def leaves(
        self, queries: np.ndarray, enough: Callable[[list[int], float], bool] | None = None
    ) -> list[tuple[list[int], list[float]]]:
        """For each query the leaves in the order of its priority queue, and how far it has gone.

        How far is the largest distance that left the queue up to a leaf, less that of the first
        leaf. ``enough`` is asked with the leaves so far and how far the next node would go; without
        it all leaves are given.
        """
        far = _distances(self.longer(queries, query=True), self.centres)
        found = []
        for row in far.tolist():
            heap, order, reach = [(row[0], 0)], [], []
            first = farthest = -np.inf
            while heap:
                if enough and order and enough(order, max(heap[0][0] - first, 0.0)):
                    break
                distance, node = heapq.heappop(heap)
                farthest = max(farthest, distance) if order else distance
                if not self.children[node]:
                    if not order:
                        first = distance
                    order.append(node)
                    reach.append(max(farthest - first, 0.0))
                for child in self.children[node]:
                    heapq.heappush(heap, (row[child], child))
            found.append((order, reach))
        return found


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)


def _centres(x: np.ndarray, k: int, random: np.random.Generator) -> np.ndarray:
    """Which of at most ``k`` clusters each vector is in."""
    centres = x[random.choice(len(x), k, replace=False)]
    for _ in range(10):
        own = _distances(x, centres).argmin(1)
        centres = np.stack([x[own == j].mean(0) if (own == j).any() else centres[j] for j in range(k)])
    return _distances(x, centres).argmin(1)


def build_tree(sample: np.ndarray, longest: float) -> Tree:
    """Split nodes by k-means until their part of the sample is small or all alike."""
    tree = Tree(np.zeros((0, 0)), [], np.zeros(0), longest)
    x = tree.longer(sample)
    random = np.random.default_rng(0)
    centres, children, subtree = [x.mean(0)], [[]], [0]
    waiting = [(0, np.arange(len(x)), 0)]
    while waiting:
        node, rows, depth = waiting.pop()
        if len(rows) <= LEAF_SAMPLE:
            continue
        own = _centres(x[rows], BRANCHES, random)
        if len(np.unique(own)) < 2:
            continue
        for j in np.unique(own):
            part, child = rows[own == j], len(centres)
            centres.append(x[part].mean(0))
            children.append([])
            children[node].append(child)
            subtree.append(child if depth < 2 else subtree[node])
            waiting.append((child, part, depth + 1))
    return Tree(np.stack(centres), children, np.array(subtree), longest)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the vectors that take part, one row for each vec_id.

    A null id, a null, empty or zero vector and one with a null or non-finite component take no
    part. Of rows that share an id the one with the smallest vector counts. Of different
    dimensions the most frequent takes part, of equally frequent ones the largest.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("embedding").cast("array<double>").alias("embedding"),
        )
        .filter(F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0))
        .groupBy("vec_id")
        .agg(F.min("embedding").alias("embedding"))
    )


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products, each summed in the order of the components, so that equal vectors get
    equal scores wherever they stand."""
    out = np.zeros((len(a), len(b)))
    for d in range(a.shape[1]):
        out += a[:, d, None] * b[None, :, d]
    return out


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest scores of a row, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def _block(
    q: np.ndarray, query: np.ndarray, x: np.ndarray, ids: np.ndarray, open_to: np.ndarray, k: int
) -> pd.DataFrame:
    """The ``k`` best of the vectors that each query is open to.

    A matrix product finds who may be among them, with room for its rounding; these get the exact
    score, by which they are ranked.
    """
    rough = np.where(open_to, q @ x.T, -np.inf)
    if len(ids) > k:
        least = np.partition(rough, len(ids) - k, axis=1)[:, len(ids) - k, None]
        room = 1e-9 * (1 + np.abs(q).sum(1, keepdims=True) * np.abs(x).max())
        open_to = open_to & (rough >= np.where(np.isfinite(least), least - room, -np.inf))
    row, col = np.nonzero(open_to)
    score = np.zeros(len(row))
    for d in range(q.shape[1]):
        score += q[row, d] * x[col, d]
    order = np.lexsort((ids[col], -score, row))
    row, col, score = row[order], col[order], score[order]
    first = np.searchsorted(row, row)  # where the row's run starts
    top = np.arange(len(row)) - first < k
    return pd.DataFrame({"query_id": query[row[top]], "vec_id": ids[col[top]], "score": score[top]})


@dataclass
class Index:
    tree: Tree
    filed: DataFrame  # vec_id, embedding, leaf, subtree


def build_index(vectors: DataFrame) -> Index | None:
    """Fit the tree on the sample with the smallest hashes and file every usable vector.

    None if no vector is usable.
    """
    rows = materialise(usable(vectors), "vectors")
    norm = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)
    sizes = rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"), F.max(norm).alias("m"))
    first = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    if first is None:
        return None
    rows = rows.filter(F.size("embedding") == first.d)
    most = max(BRANCHES, min(SAMPLE_VECTORS, SAMPLE_NUMBERS // first.d))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(most).select("embedding").toPandas()
    tree = build_tree(_matrix(sample["embedding"]), float(np.sqrt(first.m)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                leaf = tree.leaf_of(_matrix(batch["embedding"]))
                yield batch.assign(leaf=leaf, subtree=tree.subtree[leaf])

    filed = rows.mapInPandas(run, "vec_id long, embedding array<double>, leaf int, subtree int")
    return Index(tree, materialise(filed, "filed-vectors"))


def exact(index: Index, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """query_id and leaf of each exact neighbour of a few queries, by a scan of all vectors."""
    ids, q = queries["vec_id"].to_numpy(), _matrix(queries["embedding"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = [pd.DataFrame() for _ in ids]
        for batch in batches:
            if not len(batch):
                continue
            scores = products(q, _matrix(batch["embedding"]))
            own = batch["vec_id"].to_numpy()
            scores[own[None, :] == ids[:, None]] = -np.inf
            for j in range(len(ids)):
                at = best(scores[j], own, k)
                new = pd.DataFrame({"vec_id": own[at], "leaf": batch["leaf"].to_numpy()[at], "score": scores[j][at]})
                both = pd.concat([held[j], new[new["score"] > -np.inf]])
                held[j] = both.iloc[best(both["score"].to_numpy(), both["vec_id"].to_numpy(), k)]
        for j, found in enumerate(held):
            if len(found):
                yield found.assign(query_id=ids[j])[["query_id", "vec_id", "leaf", "score"]]

    near = index.filed.mapInPandas(run, "query_id long, vec_id long, leaf int, score double")
    return _ranked(near, k).select("query_id", "leaf").toPandas()


def _ranked(near: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


@dataclass
class Bound:
    """A query goes on until it has seen ``visits`` leaves, as many vectors as it needs, and the
    next node is farther than ``reach`` behind its first leaf."""

    visits: int
    reach: float
    sizes: dict[int, int]  # vectors by leaf

    def enough(self, k: int) -> Callable[[list[int], float], bool]:
        def done(order: list[int], next_reach: float) -> bool:
            if len(order) < self.visits or next_reach <= self.reach:
                return False
            return sum(self.sizes.get(leaf, 0) for leaf in order) > k  # one may be the query

        return done


def calibrated(index: Index, queries: DataFrame, k: int, target: float, floor: float) -> Bound:
    """The fewest leaves that hold the wanted share of the exact neighbours of some queries, and
    the reach in which each of these finds ``floor`` of its own."""
    # A row for each leaf, and leaves are made of a bounded sample.
    sizes = {r.leaf: r["count"] for r in index.filed.groupBy("leaf").count().collect()}
    few = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATION)
    few = few.select("vec_id", "embedding").toPandas()
    truth = exact(index, few, k) if len(few) else few
    if not len(truth):
        return Bound(1, 0.0, sizes)
    ranks, reaches = [], [0.0]
    walks = dict(zip(few["vec_id"], index.tree.leaves(_matrix(few["embedding"]))))
    for query, own in truth.groupby("query_id"):
        order, reach = walks[query]
        place = {leaf: at for at, leaf in enumerate(order)}
        needed = sorted(place[leaf] for leaf in own["leaf"])
        ranks += needed
        reaches.append(reach[needed[int(np.ceil(floor * len(needed))) - 1]])
    ranks.sort()
    visits = ranks[int(np.ceil(target * len(ranks))) - 1] + 1
    return Bound(visits, max(reaches), sizes)


def search(
    vectors: DataFrame, every: int = 20, k: int = K, target: float = TARGET, floor: float = FLOOR
) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found for the ids divisible by ``every``.

    Every query gets ``k`` rows, or all other vectors if there are fewer.
    A vector is never its own neighbour. Ties go to the smaller vec_id. See ``usable`` for the
    rows that take no part; without a usable vector the result is empty.
    """
    spark = vectors.sparkSession
    index = build_index(vectors)
    schema = "query_id long, rank int, vec_id long, score double"
    if index is None:
        return spark.createDataFrame([], schema)
    tree = index.tree
    queries = index.filed.filter(F.col("vec_id") % every == 0)
    enough = calibrated(index, queries, k, target, floor).enough(k)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            walks = tree.leaves(_matrix(batch["embedding"]), enough)
            rows = []
            for query, vector, (order, _) in zip(batch["vec_id"], batch["embedding"], walks):
                by: dict[int, list[int]] = {}
                for leaf in order:
                    by.setdefault(int(tree.subtree[leaf]), []).append(leaf)
                rows += [(query, vector, s, leaves) for s, leaves in by.items()]
            yield pd.DataFrame(rows, columns=["query_id", "vector", "subtree", "leaves"])

    routed = materialise(
        queries.select("vec_id", "embedding").mapInPandas(
            route, "query_id long, vector array<double>, subtree int, leaves array<int>"
        ),
        "routed-queries",
    )
    # A row for each subtree, at most BRANCHES ** 2 of them.
    shares = T.StructType([T.StructField(c, T.IntegerType()) for c in ("subtree", "parts", "query_parts")])
    held = {r.subtree: r["count"] for r in index.filed.groupBy("subtree").count().collect()}
    asked = {r.subtree: r["count"] for r in routed.groupBy("subtree").count().collect()}
    cells = [
        (s, 1 + held[s] // CELL_VECTORS, 1 + asked[s] // CELL_QUERIES) for s in held if s in asked
    ]
    cells = F.broadcast(spark.createDataFrame(cells, shares))

    def dealt(parts: str):
        return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))

    left = (
        routed.join(cells, "subtree")
        .withColumn("query_part", F.pmod(F.xxhash64("query_id"), "query_parts").cast("int"))
        .select("subtree", dealt("parts").alias("part"), "query_part", "query_id", "vector", "leaves")
    )
    right = (
        index.filed.join(cells, "subtree")
        .withColumn("part", F.pmod(F.xxhash64("vec_id"), "parts").cast("int"))
        .select("subtree", "part", dealt("query_parts").alias("query_part"), "vec_id", "embedding", "leaf")
    )

    def score(asking: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []})]
        if len(asking) and len(there):
            x, ids = _matrix(there["embedding"]), there["vec_id"].to_numpy()
            numbers, leaf = np.unique(there["leaf"].to_numpy(), return_inverse=True)
            for start in range(0, len(asking), QUERY_BLOCK):
                some = asking.iloc[start : start + QUERY_BLOCK]
                visited = np.stack([np.isin(numbers, own) for own in some["leaves"]])
                query = some["query_id"].to_numpy()
                open_to = visited[:, leaf] & (ids != query[:, None])
                found.append(_block(_matrix(some["vector"]), query, x, ids, open_to, k))
        return pd.concat(found)

    key = ["subtree", "part", "query_part"]
    near = (
        left.groupBy(*key)
        .cogroup(right.groupBy(*key))
        .applyInPandas(score, "query_id long, vec_id long, score double")
    )
    return _ranked(near, k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
