"""Lenient typing of text columns, independent of the session's ANSI setting."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that Spark reads as a double: a decimal or hexadecimal number, infinity or NaN, within
# blanks.
NUMBER_TEXT = (
    r"(?i)^[\x00-\x20]*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?[df]?|inf(?:inity)?|nan"
    r"|0x[0-9a-f]*\.?[0-9a-f]*p[+-]?\d+[df]?)[\x00-\x20]*$"
)
SPECIAL_NUMBERS = ["inf", "infinity", "nan"]


def quoted(name: str) -> str:
    """Column name in backticks, so that dots, blanks, slashes and parentheses are safe."""
    return "`" + name.replace("`", "``") + "`"


def named(name: str) -> Column:
    return F.col(quoted(name))


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def to_double(name: str) -> Column:
    """Double value of a column; text that is no number becomes null."""
    return named(name).try_cast("double")


def number_in_text(name: str) -> Column:
    """The same for a text column in which numbers may be rare.

    A failed ``try_cast`` costs about twenty times a successful one, because the parser throws
    inside. Here the form of the text is tested first.
    """
    return F.when(named(name).rlike(NUMBER_TEXT), to_double(name))


def to_year(df: DataFrame, name: str) -> Column:
    """Integer year of a column; ``'2001.7'`` gives 2001 and text that is no number gives null.

    An integer column is returned as it is.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return named(name)
    if isinstance(kind, T.LongType):
        return named(name).try_cast("int")
    return to_double(name).try_cast("int")


def typed_once(df: DataFrame, typed: Mapping[str, Column]) -> DataFrame:
    """The frame with further columns, each computed once however often it is used.

    A column of ``select`` is computed again by every filter on it, as the optimizer moves filters
    below the projection. A generator of one row per row stays where it is and inside generated
    code. For costly expressions, as parsing a text.
    """
    row = F.struct(*[value.alias(name) for name, value in typed.items()])
    return df.select("*", F.inline(F.array(row)))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores appended while the frame has such a column."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_year(df: DataFrame, name: str, years: tuple[int, int]) -> tuple[DataFrame, Column]:
    """Rows of a range of years, ends included, and the column that holds their year as an integer.

    Text is parsed once. On whole numbers the range reaches the scan.
    """
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return df.filter(in_years(df, name, years)), to_year(df, name)
    year = free_name(df, "typed_year")
    typed = typed_once(df, {year: to_year(df, name)})
    return typed.filter(named(year).between(*years)), named(year)


def with_double(df: DataFrame, name: str) -> tuple[DataFrame, Column]:
    """The frame and a column that holds the double value of ``name``; text is parsed once."""
    if not is_text(df, name):
        return df, to_double(name)
    double = free_name(df, "typed_double")
    return typed_once(df, {double: to_double(name)}), named(double)


def in_years(df: DataFrame, name: str, years: tuple[int, int]) -> Column:
    """True for years of a range, ends included. On whole numbers the range reaches the scan."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return named(name).between(*years)
    return to_year(df, name).between(*years)


def blank(df: DataFrame, name: str) -> Column:
    """True for null and, in text columns, for the empty string."""
    missing = named(name).isNull()
    return missing | (named(name) == "") if is_text(df, name) else missing
