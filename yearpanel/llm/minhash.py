"""Near-duplicate documents by MinHash with tensored banding.

A table key would need several minhashes of its own. Here two small collections of hashes are
made, each hash from two minhashes, and every pair of a hash of the first and one of the second
collection is a table key: 12 and 12 give 144 tables from 48 minhashes. Two documents meet in a
table if and only if they share a hash of either collection, so that hashes that no other document
has are dropped before pairs are formed; that loses nothing.

Documents with the same set of shingles are one class. In every table all members are first paired
with one pivot only, the document that is in most company; each document is verified against the
pivot it meets most often, on the full sets. Verified links give components. Documents that share
a table and still are in different components are then compared with each other, in blocks: first
by signature, to find who has a partner that may be similar enough, then on the full sets. A block
gives only the links that connect components, so that neither links inside what is connected nor
pairs that fail are listed. No link is lost but to the chance that two documents meet in no table
or in too few minhashes, which is 1e-5 at a similarity of 0.8 and falls steeply above.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearpanel.llm.common import keyed_texts, small
from yearpanel.llm.components import components
from yearpanel.sources.scratch import materialise

#: Words of a shingle, and the similarity of a link in percent.
WORDS, PERCENT = 4, 80
#: Hashes of a collection, minhashes of a hash.
HALVES, ROWS = 12, 2
MINHASHES = 2 * HALVES * ROWS
#: Equal minhashes of a pair that is verified. At a similarity of 0.8 fewer have a chance of 1e-6.
MIN_EQUAL = 22
#: Members of a table that are compared with each other in one block.
BLOCK = 1024
#: Words whose hashes a task remembers.
REMEMBERED = 500_000

SIGNATURE = (
    "doc_id long, text_key long, n_shingles long, high long, low long, halves array<long>, signature array<int>"
)

_words: dict[bytes, int] = {}


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """The sorted hashes of a text's different shingles of lower-cased words (ASCII rules)."""
    tokens = text.encode().lower().split()
    if not tokens:
        return np.zeros(0, dtype=np.uint64)
    if len(_words) > REMEMBERED:
        _words.clear()
    codes = list(map(_words.get, tokens))
    if None in codes:
        for token in tokens:
            if token not in _words:
                _words[token] = xxhash.xxh3_64_intdigest(token)
        codes = list(map(_words.__getitem__, tokens))
    code = np.array(codes, dtype=np.uint64)
    width = min(words, len(code))
    n = len(code) - width + 1
    found = np.full(n, 0 if width == words else width, dtype=np.uint64)
    for k in range(width):
        found = (found ^ found >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) + code[k : k + n]
    found = (found ^ found >> np.uint64(30)) * np.uint64(0x94D049BB133111EB)
    return np.unique(found ^ found >> np.uint64(31))


@functools.cache
def _factors() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(1)
    draw = functools.partial(random.integers, 0, 2**64, MINHASHES, dtype=np.uint64)
    return draw() | np.uint64(1), draw()


def minhashes(shingle: np.ndarray) -> np.ndarray:
    factor, shift = _factors()
    out = np.full(MINHASHES, ~np.uint64(0))
    for start in range(0, len(shingle), 4096):
        some = shingle[start : start + 4096, None] * factor + shift
        out = np.minimum(out, some.min(0))
    return out


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles, high, low, halves, signature of every row with a doc_id.

    high and low are a digest of the set; they, the halves and the signature are null for a text
    without words.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                own = shingles(text or "")
                if not len(own):
                    out.append((0, None, None, None, None))
                    continue
                value = xxhash.xxh3_128_intdigest(own.tobytes())
                least = minhashes(own)
                pair = least.reshape(-1, ROWS)
                half = pair[:, 0] * np.uint64(0x9E3779B97F4A7C15) + pair[:, 1]
                half = half + np.arange(2 * HALVES, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
                out.append(
                    (
                        len(own),
                        (value >> 64) - (1 << 63),
                        (value & (1 << 64) - 1) - (1 << 63),
                        half.view(np.int64),
                        (least >> np.uint64(32)).astype(np.uint32).view(np.int32),
                    )
                )
            names = ["n_shingles", "high", "low", "halves", "signature"]
            result = pd.DataFrame(out, columns=names).astype({"high": "Int64", "low": "Int64"})
            result.insert(0, "text_key", batch["text_key"].to_numpy())
            result.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield result

    return keyed_texts(docs).mapInPandas(run, SIGNATURE)


def tables(classes: DataFrame) -> DataFrame:
    """key and id: the table keys of the classes that share a hash of either collection."""
    halves = classes.select("id", F.posexplode("halves").alias("at", "half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).filter("n > 1").select("half")
    own = (
        halves.join(small(materialise(shared, "shared-halves")), "half", "left_semi")
        .groupBy("id")
        .agg(
            F.collect_set(F.when(F.col("at") < HALVES, F.col("half"))).alias("first"),
            F.collect_set(F.when(F.col("at") >= HALVES, F.col("half"))).alias("second"),
        )
    )
    return (
        own.filter("size(first) > 0 and size(second) > 0")
        .select("id", "second", F.explode("first").alias("half"))
        .select("id", "half", F.explode("second").alias("other"))
        .select(F.xxhash64("half", "other").alias("key"), "id")
    )


def company(keys: DataFrame) -> DataFrame:
    """key, id, weight of the tables with more than one member; weight is the company of an id in
    all its tables."""
    keys = materialise(keys, "table-keys")
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    members = materialise(keys.join(small(materialise(sizes, "table-sizes")), "key"), "table-members")
    weights = members.groupBy("id").agg(F.sum("n").alias("weight"))
    return members.drop("n").join(weights, "id")


def pivot_pairs(members: DataFrame) -> DataFrame:
    """a and b: every member with the pivot that it meets in most tables."""
    lead = members.groupBy("key").agg(
        F.max(F.struct("weight", (-F.col("id")).alias("minus"))).alias("lead")
    )
    lead = lead.select("key", (-F.col("lead.minus")).alias("pivot"), F.col("lead.weight").alias("pivot_weight"))
    return (
        members.join(lead, "key")
        .filter("id != pivot")
        .groupBy("id", "pivot")
        .agg(F.count("*").alias("met"), F.max("pivot_weight").alias("pivot_weight"))
        .groupBy("id")
        .agg(F.max(F.struct("met", "pivot_weight", (-F.col("pivot")).alias("minus"))).alias("best"))
        .select(F.col("id").alias("a"), (-F.col("best.minus")).alias("b"))
    )


def texts_of(ids: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """id and text of the classes in ``ids``, one row for each: the text of the class's own row."""
    places = classes.select("id", "doc_id", "text_key").join(ids, "id", "left_semi")
    chosen = keyed_texts(docs).join(small(materialise(places, "text-ids")), ["doc_id", "text_key"])
    return materialise(chosen.groupBy("id").agg(F.min("text").alias("text")), "texts")


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar enough."""
    pairs = materialise(pairs, "pairs")
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    texts = texts_of(ids, classes, docs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = functools.lru_cache(maxsize=64)(shingles)
        for batch in batches:
            good = [
                similar(shingles(one or ""), known(other or ""))
                for one, other in zip(batch["a_text"], batch["b_text"])
            ]
            yield batch.loc[good, ["a", "b"]]

    left = texts.select(F.col("id").alias("a"), F.col("text").alias("a_text"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("b_text"))
    return pairs.join(left, "a").join(right, "b").mapInPandas(run, "a long, b long")


def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The groups of rows sorted by key and cell, whole ones."""
    rest = None
    for batch in batches:
        batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        mark = batch["key"].to_numpy(), batch["cell"].to_numpy()
        edges = np.flatnonzero((mark[0][1:] != mark[0][:-1]) | (mark[1][1:] != mark[1][:-1])) + 1
        starts = [0, *edges.tolist()]
        for start, end in zip(starts, starts[1:]):
            yield batch.iloc[start:end]
        rest = batch.iloc[starts[-1] :]
    if rest is not None and len(rest):
        yield rest


def _dealt(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """``rows`` (key, id, label, ...) repeated for the cells of their bucket.

    Members with the label that most of a bucket have are never compared with each other. The others
    make up the first ``minor`` of its ``parts``. A cell is a pair of parts of which one is such a
    part: those members go to the cells of their part with any part, and members of the common label
    only to the cells with the minor parts. Buckets of up to BLOCK members are one cell.
    """
    mixed = F.pmod(F.xxhash64("id"), "minor")
    others = F.greatest(F.col("parts") - F.col("minor"), F.lit(1))
    common = F.col("minor") + F.pmod(F.xxhash64("id"), others)
    rare = (F.col("label") != F.col("common")) | (F.col("parts") == 1)
    part = F.when(rare, mixed).otherwise(common).cast("int")
    met = F.when(rare, F.col("parts")).otherwise(F.col("minor"))
    cells = F.transform(
        F.sequence(F.lit(0), met - 1),
        lambda k: F.least("part", k) * F.col("parts") + F.greatest("part", k),
    )
    joined = rows.join(sizes, "key").withColumn("part", part).withColumn("cell", F.explode(cells))
    return joined.drop("part", "parts", "minor", "common")


def _bucket_sizes(firsts: DataFrame) -> DataFrame:
    """key, parts, minor, common of the buckets with more than one label.

    ``common`` is the label that most members have. The others are dealt into ``minor`` parts, all
    members into ``parts``.
    """
    counted = firsts.groupBy("key", "label").agg(F.count("*").alias("n"))
    sizes = counted.groupBy("key").agg(
        F.sum("n").alias("n"),
        F.count("*").alias("labels"),
        F.max(F.struct("n", "label")).alias("most"),
    )
    minor = F.ceil((F.col("n") - F.col("most.n")) / BLOCK)
    parts = F.when(F.col("n") <= BLOCK, 1).otherwise(minor + F.ceil(F.col("most.n") / BLOCK))
    return sizes.filter("labels > 1").select(
        "key",
        parts.cast("int").alias("parts"),
        F.when(F.col("n") <= BLOCK, 1).otherwise(minor).cast("int").alias("minor"),
        F.col("most.label").alias("common"),
    )


def _by_cell(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "cell").sortWithinPartitions("key", "cell")


def meeting(members: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
    """key, cell, id, label: where documents of different components meet that may be similar.

    Buckets are the hashes of the first collection. A pair is looked at in the first bucket it
    shares, and counts if it also shares a hash of the second collection, which means a table, if
    its sizes allow the similarity and if enough of its minhashes agree. A document is named once
    for each cell in which it has such a partner, however many partners it has.
    """
    labelled = members.select("key", "id").join(labels, "id", "left")
    labelled = materialise(
        labelled.select("key", "id", F.coalesce("component", "id").alias("label")), "labelled-members"
    )
    mixed = (
        labelled.groupBy("key")
        .agg(F.min("label").alias("least"), F.max("label").alias("most"))
        .filter("least < most")
        .select("key")
    )
    open_ids = labelled.join(small(materialise(mixed, "mixed-tables")), "key", "left_semi")
    open_ids = materialise(open_ids.select("id", "label").distinct(), "open-members")
    own = classes.join(small(open_ids), "id").select("id", "label", "n_shingles", "halves", "signature")
    firsts = own.select("*", F.explode(F.slice("halves", 1, HALVES)).alias("key"))
    sizes = materialise(_bucket_sizes(firsts), "open-buckets")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _groups(batches):
            label = group["label"].to_numpy()
            if len(label) < 2 or (label == label[0]).all():
                continue
            size, key = group["n_shingles"].to_numpy(), group["key"].iloc[0]
            half, own = np.stack(group["halves"].to_numpy()), np.stack(group["signature"].to_numpy())
            at = int(np.flatnonzero(half[0, :HALVES] == key)[0])
            found = np.zeros(len(label), dtype=bool)
            for k in range(len(label) - 1):
                low, high = np.minimum(size[k], size[k + 1 :]), np.maximum(size[k], size[k + 1 :])
                near = (label[k] != label[k + 1 :]) & (100 * low >= PERCENT * high)
                other = np.flatnonzero(near) + k + 1
                equal = half[other] == half[k]
                other = other[~equal[:, :at].any(1) & equal[:, HALVES:].any(1)]
                other = other[(own[other] == own[k]).sum(1) >= MIN_EQUAL]
                found[other] = True
                found[k] |= len(other) > 0
            if found.any():
                yield group.loc[found, ["key", "cell", "id", "label"]]

    return _by_cell(_dealt(firsts, small(sizes))).mapInPandas(
        run, "key long, cell int, id long, label long"
    )


def spanning_links(sets: list[np.ndarray], label: np.ndarray) -> list[tuple[int, int]]:
    """Links between similar sets that connect different labels, as few as connect the same ones."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    every, place = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(n), size)
    shared = np.bincount(place, minlength=len(every)) > 1
    row, place = row[shared[place]], (np.cumsum(shared) - 1)[place[shared[place]]]
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    both = np.zeros((n, n), dtype=np.float32)
    for start in range(0, int(shared.sum()), 4096):
        low, high = np.searchsorted(place, (start, start + 4096))
        part = np.zeros((n, 4096), dtype=np.float32)
        part[row[low:high], place[low:high] - start] = 1
        both += part @ part.T
    both = both.astype(np.int64)
    similar = 100 * both >= PERCENT * (size[:, None] + size - both)
    a, b = np.nonzero(np.triu(similar & (label[:, None] != label), 1))
    parent = {int(x): int(x) for x in label}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = root(int(label[x])), root(int(label[y]))
        if p != q:
            parent[max(p, q)] = min(p, q)
            links.append((x, y))
    return links


def cross_links(members: DataFrame, labels: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """a and b: links between the components, found on full sets where documents meet."""
    met = materialise(meeting(members, labels, classes), "meetings")
    texts = texts_of(met.select("id").distinct(), classes, docs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _groups(batches):
            ids = group["id"].to_numpy()
            sets = [shingles(text or "") for text in group["text"]]
            links = spanning_links(sets, group["label"].to_numpy())
            if links:
                yield pd.DataFrame([(ids[x], ids[y]) for x, y in links], columns=["a", "b"])

    rows = met.join(texts, "id")
    return _by_cell(rows).mapInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: ``judged`` without the text_key."""
    return judged(docs).drop("text_key")


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept, one row per row with a doc_id.

    Documents with at least 80 % of their shingles of four words in common are linked;
    component_id is the smallest doc_id reachable, and kept says that it is the document's own. A
    null or empty text has no shingle and no link. Rows without a doc_id are left out. Rows that
    share a doc_id get equal results if their texts are equal; else each goes by its own text.
    """
    own = materialise(signatures(docs), "signatures")
    content = F.struct("doc_id", "text_key", "n_shingles", "halves", "signature")
    # A doc_id may have several texts, so classes have numbers of their own.
    classes = materialise(
        own.filter("n_shingles > 0")
        .groupBy("high", "low")
        .agg(F.min(content).alias("c"), F.count("*").alias("n"))
        .select("high", "low", "n", "c.*", F.monotonically_increasing_id().alias("id")),
        "classes",
    )
    members = materialise(company(tables(classes)), "members")
    links = materialise(verified(pivot_pairs(members), classes, docs), "pivot-links")
    labels = materialise(components(links), "labels")
    crossed = materialise(cross_links(members, labels, classes, docs), "cross-links")
    if not crossed.isEmpty():
        labels = materialise(components(links.unionByName(crossed)), "labels")
    named = materialise(classes.select("id", "doc_id").join(labels, "id"), "labelled-classes")
    least = named.groupBy("component").agg(F.min("doc_id").alias("least"))
    least = named.join(small(materialise(least, "components")), "component").select("id", "least")
    joined = (
        classes.select("high", "low", "n", "id", "doc_id")
        .join(least, "id", "left")
        .withColumn("component", F.coalesce("least", "doc_id"))
        .filter("n > 1 or component != doc_id")
        .select("high", "low", "component")
    )
    component = F.coalesce("component", "doc_id")
    return (
        own.select("doc_id", "text_key", "n_shingles", "high", "low")
        .join(small(materialise(joined, "joined-classes")), ["high", "low"], "left")
        .select(
            "doc_id",
            "text_key",
            "n_shingles",
            component.alias("component_id"),
            (component == F.col("doc_id")).alias("kept"),
        )
    )
