"""The registered queries and the pipeline on the small tables."""

from __future__ import annotations

import re

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from yearpanel.llm import catalog, line_dedup, minhash, quality, substring_dedup
from yearpanel.sources.scratch import materialise


def test_every_operator_has_one_query():
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in catalog.QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert set(catalog.QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(catalog.ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(catalog.ORACLES))
def test_query_equals_its_twin(spark, small_tables, name):
    connection = duckdb.connect()
    for table in ("documents", "labels"):
        connection.execute(f"CREATE VIEW {table} AS FROM '{small_tables}/{table}.parquet'")
    cursor = connection.execute(catalog.ORACLES[name])
    columns = [c[0] for c in cursor.description]
    found = catalog.QUERIES[name](spark, small_tables)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(cursor.fetchall())


def test_the_pipeline_keeps_columns_and_decisions(spark, small_tables):
    docs = spark.read.parquet(f"{small_tables}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules",
        "line_dedup",
        "near_dedup",
        "substring_dedup",
        "packing",
    ]
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, docs, small_tables), name)
        if name == "quality_rules":
            field = quality.fitted(docs, spark.read.parquet(f"{small_tables}/labels.parquet"))
            kept = {r.doc_id for r in quality.judged(docs, field).filter("kept").collect()}
            assert {r.doc_id for r in out.collect()} == kept
        if name == "near_dedup":
            kept = {r.doc_id for r in minhash.near_duplicates(docs).filter("kept").collect()}
            assert {r.doc_id for r in out.collect()} == kept
        for own, operator in (("line_dedup", line_dedup), ("substring_dedup", substring_dedup)):
            if name == own:
                texts = {r.doc_id: r.kept_text for r in operator.deduplicated(docs).collect()}
                got = {r.doc_id: r.text for r in out.collect()}
                assert got == {k: t for k, t in texts.items() if k in got}
                assert all(not texts[k].strip() for k in texts.keys() - got.keys())
                assert all(r.n_chars == len(r.text) for r in out.collect())
        if name != "packing":
            assert out.columns == columns and 0 < out.count() <= docs.count()
            docs = out
        else:
            assert {r.doc_id for r in out.select("doc_id").collect()} == {r.doc_id for r in docs.collect()}


def test_stages_take_null_and_repeated_rows(spark, documents, odd_documents, no_documents, small_tables):
    for docs in (documents, odd_documents, no_documents):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, small_tables)
            rows = out.collect()
            if name != "packing":
                assert out.columns == docs.columns and len(rows) <= docs.count()
            if name.endswith("_dedup"):  # rows without an id have no place, and stay
                assert sum(r.doc_id is None for r in rows) == docs.filter("doc_id is null").count()
