"""Quality rules: base counts of a document, and lines labelled by a conditional random field.

A linear-chain conditional random field with the states boilerplate and content labels the lines
of a document by Viterbi decoding. A document stays if content lines hold enough of its words.
The field is fitted on a bounded sample of documents with a quality label; everything else runs
over every document, next to the scan, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = b"0123456789"
MARKS = b"!?.,:;-_/\\()[]{}\"'`~^+=@"

#: Words of a repeated window, and the shares in percent beyond which the base rules reject.
WINDOW, MIN_WORDS, MAX_REPEATED = 8, 20, 30
#: Bound of the sample that the field is fitted on: documents of each label, lines of each.
SAMPLE_DOCS, SAMPLE_LINES = 1000, 100
#: Share of a document's words that content lines must hold.
MIN_CONTENT = 0.5

N_FEATURES = 9
BOILERPLATE, CONTENT = 0, 1


@dataclass(frozen=True)
class LineField:
    """Weights of the field: a vector for each state, a score for each pair of states, a start."""

    emission: np.ndarray  # features x 2
    transition: np.ndarray  # 2 x 2, from and to
    start: np.ndarray  # 2

    @staticmethod
    def content_only() -> LineField:
        """For want of labels: every line is content."""
        emission = np.zeros((N_FEATURES, 2))
        emission[0, CONTENT] = 1
        return LineField(emission, np.zeros((2, 2)), np.zeros(2))


def base_counts(text: bytes) -> tuple[int, int, int, int]:
    """n_words, n_symbols, n_dup_lines, n_repeat_words of a text in UTF-8."""
    words = text.split()
    seen: set[bytes] = set()
    doubles = 0
    for line in text.split(b"\n"):
        if line in seen:
            doubles += 1
        elif line.strip(WHITE):
            seen.add(line)
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    return len(words), symbols, doubles, repeated_words(words)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in windows found at least twice.

    A window is compared by a 64-bit hash of its words; the hash only has to agree within the
    text, so that Python's own hash of each word serves.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    code = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    code = (code ^ code >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    found = np.zeros(n, dtype=np.uint64)
    for k in range(window):
        found = found * np.uint64(0xD1342543DE82EF95) + code[k : k + n]
    ordered = np.sort(found)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    hit = np.flatnonzero(np.isin(found, twice))
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, hit, 1)
    np.add.at(edges, hit + window, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def line_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A row of features for each line with a word, and the words of each.

    Shares of symbols, capitals, digits and marks among the characters that are no white space,
    share of different words, whether the line occurred before, length, end of a sentence.
    """
    out, counts = [], []
    seen: set[bytes] = set()
    for line in text.split(b"\n"):
        words = line.split()
        if not words:
            continue
        size = sum(map(len, words))
        share = [
            (len(line) - len(line.translate(None, kind))) / size
            for kind in (SYMBOLS, UPPER, DIGITS, MARKS)
        ]
        end = words[-1][-1:] in (b".", b"?", b"!")
        variety = len(set(words)) / len(words)
        out.append((1.0, *share, variety, line in seen, np.log1p(len(words)), end))
        counts.append(len(words))
        seen.add(line)
    return np.array(out, dtype=float).reshape(-1, N_FEATURES), np.array(counts, dtype=np.int64)


def viterbi(field: LineField, features: np.ndarray) -> np.ndarray:
    """The likeliest states of a document's lines. Ties go to content."""
    scores = features @ field.emission
    n = len(scores)
    if not n:
        return np.zeros(0, dtype=np.int64)
    (stay0, cross0), (cross1, stay1) = field.transition.tolist()
    low, high = (scores[0] + field.start).tolist()
    back = []
    for s0, s1 in scores[1:].tolist():
        to0 = (low + stay0, high + cross1)
        to1 = (low + cross0, high + stay1)
        back.append((int(to0[1] >= to0[0]), int(to1[1] >= to1[0])))
        low, high = max(to0) + s0, max(to1) + s1
    path = [int(high >= low)]
    for step in reversed(back):
        path.append(step[path[-1]])
    return np.array(path[::-1])


def content_share(field: LineField, text: bytes) -> float:
    """The share of words in content lines; 1 for a text without words."""
    features, counts = line_features(text)
    if not len(counts):
        return 1.0
    return float(counts[viterbi(field, features) == CONTENT].sum() / counts.sum())


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Newton steps for a weighted logistic regression."""
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - ridge * w
        curvature = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(curvature, gradient)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_field(docs: list[np.ndarray], good: list[bool], rounds: int = 120) -> LineField:
    """A field from the line features of labelled documents.

    Lines have no labels of their own. All lines of good documents count as content. In bad ones
    a logistic regression of the document's label first tells the lines that look bad from those
    that don't. The likelihood of these states is then climbed by gradient steps.
    """
    pairs = [(x, y) for x, y in zip(docs, good) if len(x)]
    if len({y for _, y in pairs}) < 2:
        return LineField.content_only()
    lines = np.concatenate([x for x, _ in pairs])
    truth = np.concatenate([np.full(len(x), float(y)) for x, y in pairs])
    weight = np.where(truth > 0, 1 / truth.sum(), 1 / (len(truth) - truth.sum())) * len(truth) / 2
    w = _logistic(lines, truth, weight, ridge=1.0)
    states = np.where(truth > 0, 1, (lines @ w > 0).astype(int))

    sizes = np.array([len(x) for x, _ in pairs])
    n, longest = len(pairs), sizes.max()
    there = np.arange(longest) < sizes[:, None]
    hot = np.zeros((n, longest, 2))
    hot[there] = np.eye(2)[states]
    both = hot[:, :-1].reshape(-1, 2).T @ hot[:, 1:].reshape(-1, 2)
    seen = lines.T @ hot[there]

    emission, transition, start = np.zeros((N_FEATURES, 2)), np.zeros((2, 2)), np.zeros(2)
    state = [np.zeros_like(v) for v in (emission, transition, start) for _ in range(2)]
    for k in range(1, rounds + 1):
        scores = np.zeros((n, longest, 2))
        scores[there] = lines @ emission
        node, edge = _marginals(scores, transition, start, there)
        gradients = (
            (seen - lines.T @ node[there]) / n - 1e-3 * emission,
            (both - edge) / n - 1e-3 * transition,
            (hot[:, 0].sum(0) - node[:, 0].sum(0)) / n - 1e-3 * start,
        )
        for j, (value, g) in enumerate(zip((emission, transition, start), gradients)):
            mean, square = state[2 * j], state[2 * j + 1]
            mean += 0.1 * (g - mean)
            square += 0.01 * (g * g - square)
            rate = 0.1 * np.sqrt(1 - 0.99**k) / (1 - 0.9**k)
            value += rate * mean / (np.sqrt(square) + 1e-8)
    return LineField(emission, transition, start)


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))


def _marginals(scores, transition, start, there) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward: the probability of each state, and of each pair in a row, summed."""
    n, longest, _ = scores.shape
    forward = np.zeros((n, longest, 2))
    backward = np.zeros((n, longest, 2))
    forward[:, 0] = scores[:, 0] + start
    for t in range(1, longest):
        step = _logsum(forward[:, t - 1, :, None] + transition, 1) + scores[:, t]
        forward[:, t] = np.where(there[:, t, None], step, forward[:, t - 1])
    for t in range(longest - 2, -1, -1):
        step = _logsum(transition + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        backward[:, t] = np.where(there[:, t + 1, None], step, 0)
    total = _logsum(forward[:, -1], 1)
    node = np.exp(forward + backward - total[:, None, None]) * there[:, :, None]
    edge = np.exp(
        forward[:, :-1, :, None]
        + transition
        + (scores[:, 1:] + backward[:, 1:])[:, :, None, :]
        - total[:, None, None, None]
    )
    return node, (edge * there[:, 1:, None, None]).sum((0, 1))


def line_run(features: np.ndarray, lines: int, doc_id: int) -> np.ndarray:
    """At most ``lines`` neighbouring lines of a document, drawn by a hash of its id.

    A run may begin before the first line or end behind the last one, and what it has of the
    document is taken, so that every line of a long document has the same chance.
    """
    n = len(features)
    if n <= lines:
        return features
    drawn = xxhash.xxh3_64_intdigest(f"lines {doc_id}".encode())
    start = drawn % (n + lines - 1) - (lines - 1)
    return features[max(start, 0) : start + lines]


def sampled_features(
    docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_DOCS, lines: int = SAMPLE_LINES
) -> tuple[list[np.ndarray], list[bool]]:
    """Line features of at most ``per_label`` documents of each label, a run of ``lines`` of each.

    The sample is the same in every run: the labelled ids with the smallest hashes. Only its
    numbers reach the driver, no text.
    """
    known = labels.filter("doc_id is not null").select("doc_id", "quality").distinct()
    order = F.xxhash64("doc_id", F.lit("quality")), F.col("doc_id")
    chosen = [known.filter(F.col("quality") == q).orderBy(*order).limit(per_label) for q in (0, 1)]
    sample = chosen[0].unionByName(chosen[1])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()  # no more than the sample has ids
        for batch in batches:
            for doc_id, quality, text in zip(batch["doc_id"], batch["quality"], batch["text"]):
                if doc_id in seen:
                    continue
                seen.add(doc_id)
                own, _ = line_features((text or "").encode())
                own = line_run(own, lines, doc_id)
                yield pd.DataFrame(
                    {"doc_id": [doc_id], "quality": [quality], "own": [own.ravel().tolist()]}
                )

    rows = (
        docs.select("doc_id", F.col("text").cast("string").alias("text"))
        .join(F.broadcast(sample), "doc_id")  # 2 * per_label rows at most
        .select("doc_id", "quality", "text")
        .mapInPandas(run, "doc_id long, quality int, own array<double>")
        .collect()
    )
    first: dict[int, tuple] = {}
    for row in sorted(rows, key=lambda r: (r.doc_id, r.own)):
        first.setdefault(row.doc_id, row)
    found = [first[k] for k in sorted(first)]
    return (
        [np.array(r.own).reshape(-1, N_FEATURES) for r in found],
        [r.quality == 1 for r in found],
    )


def fitted(docs: DataFrame, labels: DataFrame) -> LineField:
    """The field of a corpus; one that finds content only, if a label has no document."""
    return fit_field(*sampled_features(docs, labels))


def judged(docs: DataFrame, field: LineField, min_content: float = MIN_CONTENT) -> DataFrame:
    """The columns of ``docs``, and after them n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, content_share, base_failed and kept.

    A null or empty text has no words and is rejected by the base rules. Repeated rows get equal
    results. A column of ``docs`` that has one of these names is replaced.
    """
    names = "n_words n_symbols n_dup_lines n_repeat_words".split()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [(text or "").encode() for text in batch["text"]]
            out = batch.assign(**dict(zip(names, zip(*map(base_counts, texts)))))
            out["word_chars"] = [
                len(text or "") - (len(raw) - len(raw.translate(None, WHITE)))
                for text, raw in zip(batch["text"], texts)
            ]
            out["content_share"] = [content_share(field, raw) for raw in texts]
            yield out

    rest = [c for c in docs.columns if c not in {*names, *ADDED}]
    frame = docs.select(*rest).withColumn("text", F.col("text").cast("string"))
    schema = ", ".join(
        [f"`{c.replace('`', '``')}` {t}" for c, t in frame.dtypes]
        + [f"{c} long" for c in names]
        + ["word_chars long", "content_share double"]
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")
    )
    return (
        frame.mapInPandas(run, schema)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("content_share") >= min_content))
    )


ADDED = ("word_chars", "content_share", "base_failed", "kept")
