"""Filter audit against a walk over every document and order."""

from __future__ import annotations

import re
from itertools import permutations

from pyspark.sql import functions as F

from yearpanel.llm import filter_audit

LABELS = "doc_id long, quality int, toxic int, part string, mask int"


def failures(rows):
    texts = [(r.doc_id, r.text or "") for r in rows]
    out = []
    for row in rows:
        text = row.text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = ""
        fails += "A" * (len(words) < 50)
        fails += "B" * (100 * len(set(words)) < 65 * len(words))
        fails += "C" * (100 * len(re.findall("[A-Z]", text)) > 5 * len(text))
        fails += "D" * bool(re.search(r"[#$%&*|]", text))
        smaller = [d for d, t in texts if t == text and None not in (d, row.doc_id) and d < row.doc_id]
        out.append((row, fails + "E" * bool(smaller)))
    return out


def expected(rows, labels):
    good = {d for d, quality, toxic in labels if quality == 1}
    bad = {d for d, quality, toxic in labels if toxic == 1}
    parts = {}
    for row, fails in failures(rows):
        parts.setdefault(row.source or "", []).append((row.doc_id, fails))
    out = {}
    for part, own in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [r for r in left if letter in r[1]]
                left = [r for r in left if letter not in r[1]]
                failing = sum(letter in fails for _, fails in own)
                earlier = sum(letter in f and any(x in f for x in order[: step - 1]) for _, f in own)
                assert failing == len(gone) + earlier
                shapley[letter] += len(gone)
                counts = (
                    len(left),
                    len(gone),
                    earlier,
                    sum(fails == letter for _, fails in own),
                    sum(d in good and d is not None for d, _ in gone),
                    sum(d in bad and d is not None for d, _ in gone),
                )
                out[part, order, step] = [*counts, letter]
        for (p, _, _), counts in out.items():
            if p == part:
                counts[-1] = shapley[counts[-1]]
    return {key: tuple(counts) for key, counts in out.items()}


def found(docs, labels):
    rows = filter_audit.audit(docs, labels).collect()
    keyed = {tuple(r)[:3]: tuple(r)[3:] for r in rows}
    assert len(keyed) == len(rows)
    return keyed


def labelled(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], LABELS)


def test_audit_equals_a_walk_over_every_order(spark, documents):
    texts = [
        ("Word " * 60, "a"), ("word " * 60, "a"), ("one two " * 40 + "#", None), ("A" * 300, ""),
        (" ".join(f"w{k}" for k in range(60)), "a"), (" ".join(f"w{k}" for k in range(60)), None),
        ("\x0b \x1c x", "ü"), ("x y " * 70, "a"),
    ]
    more = [(100 + k, text, "en", source, 0) for k, (text, source) in enumerate(texts)]
    docs = documents.unionByName(spark.createDataFrame(more, documents.schema))
    labels = [(0, 1, 0), (1, 1, 1), (3, 0, 1), (3, 1, 0), (100, 1, None), (101, None, 1), (None, 1, 1)]
    labels += [(999, 1, 1)]
    assert found(docs, labelled(spark, labels)) == expected(docs.collect(), labels)


def test_nulls_clashing_columns_and_empty_tables(spark, odd_documents, no_documents):
    docs = odd_documents.withColumns({"mask": F.lit(1), "part": F.lit("p"), "cells": F.lit(2)})
    labels = [(7, 1, 1)]
    got = found(docs, labelled(spark, labels))
    assert got == expected(docs.select("doc_id", "text", "source").collect(), labels)
    assert got["", "ABCDE", 1][1] == 3 and len(got) == 600
    assert found(docs, labelled(spark, []))["", "ABCDE", 1][4] == 0
    assert found(no_documents, labelled(spark, labels)) == {}


def test_copies_of_a_text_in_most_rows(spark):
    docs = spark.range(3000).selectExpr(
        "id as doc_id", "if(id % 3 = 0, 'same text', concat('text ', id)) as text", "'s' as source"
    )
    got = found(docs, labelled(spark, []))
    assert got["s", "EABCD", 1][:2] == (2001, 999)
    assert got["s", "ABCDE", 5][2] == 999
