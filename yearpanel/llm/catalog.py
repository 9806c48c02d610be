"""The registered queries over the test tables, and SQL twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearpanel.llm import (
    ann,
    bpe,
    conversations,
    filter_audit,
    line_dedup,
    minhash,
    mixing,
    packing,
    quality,
    sharding,
    substring_dedup,
    suffix_dedup,
    twins,
    warc,
)
from yearpanel.sources.scratch import scratch_path

OLD_SHARDS, SHARDS = 32, 40

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without the units that an earlier one has."""
    return substring_dedup.digests(substring_dedup.deduplicated(table(spark, sf, "documents")))


def op2_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """The nearest vectors of every twentieth one."""
    return ann.search(table(spark, sf, "embeddings"))


def op3_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Every page written to archives and read back."""
    folder = scratch_path(spark, "warc")
    warc.write_archives(warc.planned(table(spark, sf, "pages")), folder)
    return warc.read_archives(spark, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Every document packed, one row per piece."""
    return packing.piece_digests(packing.packed(table(spark, sf, "documents")))


def op5_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without the bytes of strings that a smaller one has."""
    return suffix_dedup.digests(suffix_dedup.deduplicated(table(spark, sf, "documents")))


def op6_sharding(spark: SparkSession, sf: str) -> DataFrame:
    """Documents kept by source in 32 shards, rewritten as 40 shards of equal row counts."""
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    old = F.pmod(F.crc32(source), F.lit(OLD_SHARDS))
    return sharding.shard_digests(sharding.resharded(docs, old, SHARDS))


def op7_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Every document encoded and decoded."""
    return bpe.token_digests(table(spark, sf, "documents"))


def op8_minhash(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with its component of near-duplicates."""
    return minhash.near_duplicates(table(spark, sf, "documents"))


def op9_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without the lines that are within one edit of an earlier one."""
    return line_dedup.digests(line_dedup.deduplicated(table(spark, sf, "documents")))


def op10_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Base counts and verdict of every document."""
    docs = table(spark, sf, "documents")
    field = quality.fitted(docs, table(spark, sf, "labels"))
    return quality.judged(docs.select("doc_id", "text"), field).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op11_conversations(spark: SparkSession, sf: str) -> DataFrame:
    """Faults and cheapest repair of every conversation."""
    return conversations.repaired(table(spark, sf, "conversations"))


def op12_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    """What each filter removes at each step of every order, by source."""
    return filter_audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op13_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """How many words of each document the mix of sources takes."""
    return mixing.mixed(table(spark, sf, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_neighbours": op2_neighbours,
    "op3_warc": op3_warc,
    "op4_packing": op4_packing,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_sharding": op6_sharding,
    "op7_bpe": op7_bpe,
    "op8_minhash": op8_minhash,
    "op9_line_dedup": op9_line_dedup,
    "op10_quality": op10_quality,
    "op11_conversations": op11_conversations,
    "op12_filter_audit": op12_filter_audit,
    "op13_mixing": op13_mixing,
}

ORACLES: dict[str, str] = dict(twins.ORACLES)
