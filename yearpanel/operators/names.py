"""Country names across tables: lookup, distinct names, names that fail to match."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearpanel.functions.coerce import named, quoted
from yearpanel.functions.names import canonical


def harmonise(
    df: DataFrame, aliases: Mapping[str, str] | DataFrame, column: str = "country"
) -> DataFrame:
    """Replace names by their common names.

    A mapping becomes a literal inside the projection. A frame (alias, canonical) of any size is
    left-joined: Spark broadcasts it if it is below the session's threshold, and otherwise
    shuffles, where adaptive execution splits a hot name. Its aliases are lower-cased like the
    names; of several common names for one alias the first in the alphabet counts.
    """
    if not isinstance(aliases, DataFrame):
        return df.withColumn(column, canonical(named(column), aliases))
    table = aliases.groupBy(F.lower("alias").alias("_alias")).agg(
        F.min("canonical").alias("_canonical")
    )
    lowered = F.lower(named(column))
    return (
        df.join(table, lowered == F.col("_alias"), "left")
        .withColumn(column, F.coalesce(F.col("_canonical"), lowered))
        .drop("_alias", "_canonical")
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column, as a frame and not on the driver."""
    return df.select(named(column)).distinct()


def unmatched(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``left`` that ``right`` lacks; a null matches a null.

    Both sides are deduplicated before they meet, so the join never sees raw rows.
    """
    mine = distinct_values(left, column).alias("mine")
    theirs = distinct_values(right, column).alias("theirs")
    name = quoted(column)
    same = F.col(f"mine.{name}").eqNullSafe(F.col(f"theirs.{name}"))
    return mine.join(theirs, same, "left_anti")
