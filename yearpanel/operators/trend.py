"""Linear trend of every country in one grouped aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearpanel.functions.stats import slope
from yearpanel.operators.totals import ranked, totals


def slopes(panel: DataFrame, value: str, group: str = "country") -> DataFrame:
    """Least-squares slope of the yearly totals on the year, per group."""
    yearly = totals(panel, [group, "year"], value)
    return yearly.groupBy(group).agg(slope(value, "year").alias("slope"))


def fastest_growing(panel: DataFrame, value: str, n: int = 10, group: str = "country") -> DataFrame:
    """The ``n`` groups with the steepest rising trend."""
    return ranked(slopes(panel, value, group).filter(F.col("slope") > 0), "slope", n, tie=group)
