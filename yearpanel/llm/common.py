"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from yearpanel.sources.scratch import materialise

#: Rows of a narrow table up to which it is broadcast.
BROADCAST_ROWS = 500_000


def small(narrow: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``narrow`` (a written table of numbers), to be broadcast if it has at most ``rows`` rows.

    Beyond that it is left to Spark, which joins it by a shuffle. The result is the same.
    """
    return F.broadcast(narrow) if narrow.count() <= rows else narrow


def numbered(rows: DataFrame, order: list, label: str) -> DataFrame:
    """``rows`` with ``place``, from 0 in the given order, written to the shared folder.

    Ranges of the order are sorted by a task each. The rows of all ranges before, one number for
    each range, turn places in a range into global ones.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    held = materialise(ranged.withColumn("_id", F.monotonically_increasing_id()), label)
    part = F.shiftright("_id", 33)
    sizes = held.groupBy(part.alias("_part")).agg((F.max("_id") - F.min("_id") + 1).alias("n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    inside = F.col("_id") - F.shiftleft(F.col("_part"), 33)
    return (
        held.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # a row for each range
        .withColumn("place", F.col("_before") + inside)
        .drop("_id", "_part", "_before")
    )


def keyed_texts(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, text of the rows that have a doc_id. A null text is an empty one.

    ``text_key`` tells different texts apart that share a doc_id.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.filter("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("text_key"),
        text.alias("text"),
    )
