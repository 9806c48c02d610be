"""Connected components of links between numbers, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearpanel.sources.scratch import materialise


def components(links: DataFrame) -> DataFrame:
    """id and component (the smallest id reachable) of every id in ``links`` (columns a and b).

    Large stars and small stars in turn until nothing changes: every step points neighbours at the
    smallest one they share, so that the longest way shrinks by a factor each time. A step is
    written to the shared folder. Only two numbers a step reach the driver.
    """
    at = materialise(
        links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    state = None
    while True:
        size = at.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if size == state:
            break
        state = size
        both = at.unionByName(at.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialise(large.filter("a != b").distinct(), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        turned = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = turned.unionByName(least.select("a", F.col("m").alias("b")))
        at = materialise(
            small.filter("a != b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .distinct(),
            "links",
        )
    found = at.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
    roots = at.select(F.col("b").alias("id")).distinct().withColumn("component", F.col("id"))
    return found.unionByName(roots)
