"""Raw text tables to typed panels.

Every step is a built-in expression next to the scan, so Spark prunes columns and fuses the
whole cleaning into the scan stage. Nothing here shuffles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearpanel.functions.coerce import named, to_double, with_double, with_year
from yearpanel.functions.names import (
    EMISSIONS_ALIASES,
    GENERATION_ALIASES,
    INVESTMENT_ALIASES,
    canonical,
)
from yearpanel.functions.units import GWH_DIVISORS, normalised

# The year ranges of the reports.
REPORT_YEARS = (2000, 2023)
GENERATION_TREND_YEARS = (2006, 2017)

#: Buckets of the lookup that a frame of countries becomes.
COUNTRY_BUCKETS = 1024

# Headers of the raw files.
EMISSIONS_COLUMNS = ["Year", "Country", "Total", "Per Capita"]
GENERATION_COLUMNS = [
    "Years",
    "IRENA Menu Label",
    "Technology",
    "Type",
    "UN Region English",
    "Unit",
    "Values",
]
AMOUNT_COLUMN = "Amount (2020 USD million)"


def trimmed_headers(df: DataFrame) -> DataFrame:
    """Column names without outer blanks, in one projection."""
    return df.toDF(*[name.strip() for name in df.columns])


def clean_emissions(
    raw: DataFrame,
    years: tuple[int, int] = REPORT_YEARS,
    aliases: Mapping[str, str] = EMISSIONS_ALIASES,
) -> DataFrame:
    """country, year, total, per_capita.

    A row with a missing cell among the four goes; a figure that is no number stays as null.
    """
    complete = raw.select(*[named(name) for name in EMISSIONS_COLUMNS]).na.drop()
    kept, year = with_year(complete, "Year", years)
    return kept.select(
        canonical(F.col("Country"), aliases).alias("country"),
        year.alias("year"),
        to_double("Total").alias("total"),
        to_double("Per Capita").alias("per_capita"),
    )


def clean_generation(
    raw: DataFrame,
    years: tuple[int, int] = REPORT_YEARS,
    aliases: Mapping[str, str] = GENERATION_ALIASES,
    divisors: Mapping[str, float] = GWH_DIVISORS,
) -> DataFrame:
    """country, year, technology, type, region, unit, value in the GWh scale.

    A row with a missing cell goes, and so does one whose figure is no number.
    """
    needed = trimmed_headers(raw).select(*[named(name) for name in GENERATION_COLUMNS])
    kept, year = with_year(needed.na.drop(), "Years", years)
    kept, figure = with_double(kept, "Values")
    panel = kept.select(
        canonical(named("IRENA Menu Label"), aliases).alias("country"),
        year.alias("year"),
        named("Technology").alias("technology"),
        named("Type").alias("type"),
        named("UN Region English").alias("region"),
        named("Unit").alias("unit"),
        normalised(named("Unit"), figure, divisors).alias("value"),
    )
    return panel.na.drop(subset=["value"])


def clean_investment(
    raw: DataFrame,
    years: tuple[int, int] = REPORT_YEARS,
    aliases: Mapping[str, str] = INVESTMENT_ALIASES,
    countries: Sequence[str] | DataFrame | None = None,
    technology: str | None = None,
    keep_raw: bool = False,
) -> DataFrame:
    """country, year, technology, region, amount.

    A row with a missing cell in any raw column goes; an amount that is no number stays as null.
    ``countries`` narrows to a list of common names, or to those in the first column of a frame
    (see ``in_countries``). ``keep_raw`` keeps all raw columns and appends the typed ones.
    """
    complete = raw.na.drop()
    if technology is not None:
        complete = complete.filter(named("Technology") == technology)
    kept, year = with_year(complete, "Year", years)
    country = canonical(named("Country/Area"), aliases)
    if keep_raw:
        kept = kept.select(*[named(name) for name in raw.columns])
        panel = kept.withColumns({"Country": country, "TotalFinanceFlow": to_double(AMOUNT_COLUMN)})
        key = "Country"
    else:
        key = "country"
        panel = kept.select(
            country.alias("country"),
            year.alias("year"),
            named("Technology").alias("technology"),
            named("Region").alias("region"),
            to_double(AMOUNT_COLUMN).alias("amount"),
        )
    return panel if countries is None else in_countries(panel, countries, key)


def in_countries(
    panel: DataFrame,
    countries: Sequence[str] | DataFrame,
    key: str = "country",
    listed: bool = True,
) -> DataFrame:
    """Rows of the given countries, a list or the first column of a frame. Null is no country.

    A frame becomes a filter that Spark fills in when an action runs: its names, dealt into
    buckets by hash, are one value of a scalar subquery, and a row looks into one bucket. Nothing
    runs before the action and the panel does not shuffle. The names have to fit into one row, as
    those of all countries do; without ``listed`` a frame of any length is matched by a semi join.
    """
    if not isinstance(countries, DataFrame):
        return panel.filter(named(key).isin(list(countries)))
    wanted = countries.select(named(countries.columns[0]).alias("listed")).filter("listed is not null")
    if not listed:
        return panel.join(wanted.withColumnRenamed("listed", key), key, "left_semi")

    def bucket(name: Column) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(COUNTRY_BUCKETS)).cast("int")

    held = wanted.groupBy(bucket(F.col("listed")).alias("bucket")).agg(
        F.collect_set("listed").alias("listed")
    )
    every = panel.sparkSession.range(COUNTRY_BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    buckets = every.join(held, "bucket", "left").agg(
        F.array_sort(F.collect_list(F.struct("bucket", "listed"))).alias("buckets")
    )
    lookup = buckets.select(F.transform("buckets", lambda b: b["listed"])).scalar()
    return panel.filter(F.array_contains(F.get(lookup, bucket(named(key))), named(key)))
