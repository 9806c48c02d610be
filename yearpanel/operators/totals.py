"""Grouped totals and rankings.

All aggregates combine on the map side before the shuffle, so a country with a third of all
rows arrives as one row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearpanel.functions.stats import exact_sum


def totals(
    panel: DataFrame,
    keys: Sequence[str],
    value: str,
    name: str | None = None,
    digits: int | None = None,
    how: Callable[[Column], Column] = exact_sum,
) -> DataFrame:
    """``value`` summed (or combined by ``how``) per group, rounded if ``digits`` is given."""
    result = how(F.col(value))
    if digits is not None:
        result = F.round(result, digits)
    return panel.groupBy(*keys).agg(result.alias(name or value))


def ranked(
    df: DataFrame, by: str, n: int = 10, tie: str = "country", descending: bool = True
) -> DataFrame:
    """The first ``n`` rows by a column, ties broken by name.

    Ascending rankings put nulls first. Spark keeps ``n`` rows per task and merges those.
    """
    order = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_first()
    return df.orderBy(order, F.col(tie)).limit(n)
