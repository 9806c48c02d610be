"""A corpus pipeline: quality rules, line dedup, near-dedup, substring dedup, packing.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and
reread as the next one's docs. All but the last return the columns of the documents they got.

Rows without a doc_id have no place in the order that the stages keep the earliest by; the dedup
stages pass them on as they are. Rows that repeat whole pass all stages alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yearpanel.llm import line_dedup, minhash, packing, quality, substring_dedup
from yearpanel.llm.common import small
from yearpanel.sources.scratch import materialise, scratch_path


def _text_key() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _with_texts(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """``docs`` with the kept_text of ``changed`` (doc_id, text_key, kept_text) where it has one.

    A document that has lost text and has no word left goes. n_chars follows the text.
    """
    new = changed.select(
        F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), "kept_text"
    ).dropDuplicates(["_doc", "_key"])
    joined = docs.join(
        new, (F.col("doc_id").cast("long") == F.col("_doc")) & (_text_key() == F.col("_key")), "left"
    )
    lost = F.col("kept_text").isNotNull()
    texts = {"text": F.when(lost, F.col("kept_text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        size = F.char_length("kept_text").cast(kind)
        texts["n_chars"] = F.when(lost, size).otherwise(F.col("n_chars"))
    empty = lost & (F.trim(F.regexp_replace("kept_text", r"\s+", " ")) == "")
    return joined.filter(~empty).withColumns(texts).select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the labelled lines keep."""
    field = quality.fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judged(docs, field).filter("kept").select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that are equal to an earlier one or, if they are not short, within
    one edit of it."""
    result = line_dedup.deduplicated(docs).filter("n_removed > 0")
    return _with_texts(docs, result)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id.

    Rows that share a doc_id go or stay by their own texts.
    """
    gone = minhash.judged(docs).filter("not kept")
    gone = gone.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key")).distinct()
    own = (F.col("doc_id").cast("long") == F.col("_doc")) & (_text_key() == F.col("_key"))
    return docs.join(small(materialise(gone, "near-duplicates")), own, "left_anti").select(
        *docs.columns
    )


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier ones have."""
    result = substring_dedup.deduplicated(docs).filter("n_removed > 0")
    return _with_texts(docs, result)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed token windows."""
    return packing.piece_digests(packing.packed(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup_stage),
    ("packing", pack),
]

#: Labelling lines and tokenising are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
