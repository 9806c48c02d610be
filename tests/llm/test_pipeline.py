"""The whole pipeline against its stages by brute force."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from yearpanel.llm import packing, quality

from .brute import late_lines, late_units, tiles_of
from .conftest import DOCUMENTS, prose
from .test_near import linked
from .test_quality import counts


class Rows:
    """Rows that look like a collected table."""

    def __init__(self, rows):
        self.rows = rows

    def collect(self):
        return self.rows


class Row:
    def __init__(self, doc_id, text):
        self.doc_id, self.text = doc_id, text


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(8)
    passage = prose(900, 1, 60).replace("\n", " ")
    texts = []
    for k in range(40):
        text = prose(k, rng.randint(3, 6), 14)
        if k % 5 == 1:
            text += " " + passage + "\nA closing line that many of the documents have."
        if k % 7 == 2:
            text = " ".join(w + rng.choice(["***", "$$$", "%%%"]) for w in text.split(" "))
        texts.append(text)
    texts += [texts[3], texts[4].replace(" ", "  ", 1), texts[6] + " more", "", None, "short", "la " * 300]
    texts += [texts[8].replace("o", "0", 1), texts[9][:-1] + "!"]
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = [(k, t, "en", f"s{k % 2}", len(t or "")) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCUMENTS).repartition(2).write.parquet(f"{folder}/documents.parquet")
    labels = [(k, int(k % 7 != 2), 0) for k in range(0, 40)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    frame.write.parquet(f"{folder}/labels.parquet")
    return folder, {k: t for k, t in enumerate(texts)}


def kept_by_rules(spark, folder, texts):
    field = quality.fitted(
        spark.read.parquet(f"{folder}/documents.parquet"),
        spark.read.parquet(f"{folder}/labels.parquet"),
    )
    out = {}
    for k, t in texts.items():
        own = counts(t or "")
        if own[0] >= 20 and 100 * own[3] <= 30 * own[0]:
            if quality.content_share(field, (t or "").encode()) >= quality.MIN_CONTENT:
                out[k] = t
    return out


def without_late_lines(texts):
    rows, out = sorted(texts.items()), {}
    for (k, text), gone in zip(rows, late_lines(rows)):
        kept = "\n".join(line for line, g in zip(text.split("\n"), gone) if not g)
        if not any(gone) or kept.strip():
            out[k] = kept
    return out


def without_late_units(texts):
    rows, out = sorted(texts.items()), {}
    for (k, text), gone in zip(rows, late_units(rows)):
        kept = "".join(t for t, g in zip(tiles_of(text), gone) if not g)
        if not any(gone) or kept.strip():
            out[k] = kept
    return out


def test_the_pipeline_is_its_stages(spark, tables):
    folder, texts = tables
    kept = kept_by_rules(spark, folder, texts)
    assert 5 < len(kept) < len(texts) - 8
    lines = without_late_lines(kept)
    assert lines != kept
    near = linked(Rows([Row(k, t) for k, t in lines.items()]))
    single = {k: lines[k] for k, _, _, own in near if own}
    units = without_late_units(single)
    assert units != single
    own = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    tokens = {k: len(own.encode(t, add_special_tokens=False).ids) + 1 for k, t in units.items()}
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id: r.doc_tokens for r in pieces} == tokens
    assert sum(r.length for r in pieces) == sum(tokens.values())
