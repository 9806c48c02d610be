"""Two panels side by side: same-year join, lagged join, correlation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearpanel.functions.stats import pearson

KEYS = ["country", "year"]


def same_year(left: DataFrame, right: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Inner join of two panels of totals on their keys."""
    return left.join(right, list(keys))


def lagged(
    cause: DataFrame,
    effect: DataFrame,
    lags: Sequence[int] = range(6),
    cause_year: str = "cause_year",
    effect_year: str = "effect_year",
) -> DataFrame:
    """Pair each cause with the effect ``lag`` years later, for all lags in one plan.

    Both panels hold totals by country and year, under different value names. Each cause row is repeated once per lag under
    the year it is compared with, which leaves one equality join whatever the number of lags. It
    differs from a window ``lag`` where years are missing: no row is paired with the wrong year.
    """
    shifted = cause.withColumnRenamed("year", cause_year).select(
        "*", F.explode(F.array(*[F.lit(lag) for lag in lags])).alias("lag")
    )
    shifted = shifted.withColumn(effect_year, F.col(cause_year) + F.col("lag"))
    return shifted.join(effect.withColumnRenamed("year", effect_year), ["country", effect_year])


def correlation(
    panel: DataFrame,
    x: str,
    y: str,
    by: Sequence[str] = (),
    name: str = "correlation",
    digits: int | None = None,
    nulls_as_zero: bool = False,
) -> DataFrame:
    """Pearson correlation per group, or one row without groups."""
    value = pearson(x, y, nulls_as_zero)
    if digits is not None:
        value = F.round(value, digits)
    return panel.groupBy(*by).agg(value.alias(name))
