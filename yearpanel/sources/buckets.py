"""Copies of two tables dealt into the same buckets, which join without a shuffle.

For tables that many studies join on the same key: the shuffle is paid once, when the copies are
written. A bucket is read by one task, so that rows of a key with more than a bucket's share would
make a long one. Fewer keys than there are buckets can be that hot. Their rows are kept in a plain
table beside the buckets, which Spark reads in splits and joins with the few rows of the other
table that have such a key.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearpanel.functions.coerce import named, quoted
from yearpanel.sources.scratch import delete_folder, materialise, scratch_path

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"


class Copies(NamedTuple):
    """``rows`` and ``other`` are in buckets of their keys; ``hot`` and ``few`` are plain tables."""

    rows: DataFrame
    other: DataFrame
    hot: DataFrame
    few: DataFrame
    key: str
    other_key: str


def _bucketed(df: DataFrame, key: str, buckets: int, label: str) -> DataFrame:
    """The frame as a table with one file per bucket, written by one task each."""
    path = scratch_path(df.sparkSession, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    dealt = df.repartition(buckets, named(key)).write.format("parquet")
    dealt.bucketBy(buckets, key).option("path", path).saveAsTable(name)
    table = df.sparkSession.table(quoted(name))
    table.scratch, table.registered = path, name
    return table


def dealt(
    large: DataFrame, key: str, other: DataFrame, other_key: str, buckets: int | None = None
) -> Copies:
    """Copies of a large table and of one with a row per key, in as many buckets as a shuffle has.

    Both keys have the same type, as values of different types hash differently. A row of the
    large table without a key is kept beside the buckets, like those of a hot key.
    """
    spark = large.sparkSession
    if large.schema[key].dataType != other.schema[other_key].dataType:
        raise ValueError(f"{key} and {other_key} have different types")
    buckets = buckets or int(spark.conf.get(SHUFFLE_PARTITIONS))
    counts = large.groupBy(named(key)).agg(F.count(F.lit(1)).alias("_rows"))
    counts = materialise(counts, "bucket-counts")
    share = counts.agg(F.sum("_rows") / buckets).scalar()
    often = counts.filter(F.col("_rows") > share).filter(named(key).isNotNull()).select(quoted(key))
    often = materialise(often.coalesce(1), "bucket-hot-keys")
    hot = large.join(often, key, "left_semi").select(large.columns)
    hot = hot.unionByName(large.filter(named(key).isNull()))
    rows = large.filter(named(key).isNotNull()).join(often, key, "left_anti").select(large.columns)
    few = other.join(often.withColumnRenamed(key, other_key), other_key, "left_semi")
    return Copies(
        _bucketed(rows, key, buckets, "buckets"),
        _bucketed(other, other_key, buckets, "other-buckets"),
        materialise(hot, "bucket-hot-rows"),
        materialise(few.select(other.columns), "bucket-hot-others"),
        key,
        other_key,
    )


def joined(
    copies: Copies, prepared: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> DataFrame:
    """The inner join of both tables, ``prepared`` rows of the large one first.

    ``prepared`` may narrow, filter or group the rows, but groups by the key among others.
    Only rows of hot keys can meet a shuffle, and none where their few partners are broadcast.
    """

    def pair(rows: DataFrame, other: DataFrame) -> DataFrame:
        left, right = prepared(rows), other
        return left.join(right, left[quoted(copies.key)] == right[quoted(copies.other_key)])

    return pair(copies.rows, copies.other).unionByName(pair(copies.hot, copies.few))


def dropped(copies: Copies) -> None:
    """Drop the tables of the copies and delete their files."""
    spark = copies.rows.sparkSession
    for frame in copies[:4]:
        if hasattr(frame, "registered"):
            spark.sql(f"DROP TABLE IF EXISTS {quoted(frame.registered)}")
        delete_folder(spark, frame.scratch)
