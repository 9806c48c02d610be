"""The three panels, typed and raw, made from the test tables.

Orders are placed by customers and line items come from suppliers, and both have a nation; that
makes them country-year data. A panel joins only the tables that its requested columns need.

At scale the two joins that matter are orders with customers and line items with suppliers (and
parts). Both are equality joins in which adaptive execution splits a hot key. Line items are
many per supplier, so ``subtotal`` combines them per supplier (or per part) and year before the
join, which shrinks the shuffled side by two orders of magnitude and reduces a hot supplier to a
row per task. There are too few orders per customer and year for that to pay.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yearpanel.functions.units import normalised
from yearpanel.sources.buckets import Copies, dealt, joined

GENERATION = ["country", "year", "technology", "type", "region", "unit", "value"]
SUPPLY_INVESTMENT = ["country", "year", "technology", "region", "amount"]

# What panels read of line items and parts.
LINE_ITEM_COLUMNS = [
    "l_suppkey",
    "l_partkey",
    "l_shipdate",
    "l_linestatus",
    "l_returnflag",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
]
PART_COLUMNS = ["p_partkey", "p_type"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _in_years(df: DataFrame, date: str, years: tuple[int, int] | None) -> DataFrame:
    """Year range as a range of the date column, which the parquet scan can skip by."""
    if years is None:
        return df
    first, last = years
    return df.filter(
        (F.col(date) >= F.lit(f"{first}-01-01").cast("timestamp_ntz"))
        & (F.col(date) < F.lit(f"{last + 1}-01-01").cast("timestamp_ntz"))
    )


def _orders_by_nation(
    spark: SparkSession, sf_dir: str, years: tuple[int, int] | None
) -> DataFrame:
    orders = _in_years(table(spark, sf_dir, "orders"), "o_orderdate", years)
    customer = table(spark, sf_dir, "customer")
    placed = orders.join(customer, orders.o_custkey == customer.c_custkey)
    return _with_nation(spark, sf_dir, placed, "c_nationkey")


def _with_nation(spark: SparkSession, sf_dir: str, df: DataFrame, key: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return df.join(nation, df[key] == nation.n_nationkey)


def _with_region(spark: SparkSession, sf_dir: str, df: DataFrame) -> DataFrame:
    region = table(spark, sf_dir, "region")
    return df.join(region, df.n_regionkey == region.r_regionkey)


def emissions(
    spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None
) -> DataFrame:
    """country, year, total, per_capita: one row per order."""
    return _orders_by_nation(spark, sf_dir, years).select(
        F.col("n_name").alias("country"),
        F.year("o_orderdate").alias("year"),
        F.col("o_totalprice").alias("total"),
        F.col("c_acctbal").alias("per_capita"),
    )


def investment(
    spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None
) -> DataFrame:
    """country, year, technology, region, amount: one row per order."""
    return _with_region(spark, sf_dir, _orders_by_nation(spark, sf_dir, years)).select(
        F.col("n_name").alias("country"),
        F.year("o_orderdate").alias("year"),
        F.col("o_orderpriority").alias("technology"),
        F.col("r_name").alias("region"),
        (F.col("o_totalprice") * 0.001).alias("amount"),
    )


def part_copies(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> Copies:
    """Line items and parts in the same buckets of parts, for any number of panels."""
    items = table(spark, sf_dir, "lineitem").select(LINE_ITEM_COLUMNS)
    parts = table(spark, sf_dir, "part").select(PART_COLUMNS)
    return dealt(items, "l_partkey", parts, "p_partkey", buckets)


def _line_items(
    spark: SparkSession,
    sf_dir: str,
    columns: Sequence[str],
    measure: Column,
    years: tuple[int, int] | None,
    subtotal: Callable[[Column], Column] | None,
    reduce: Callable[[DataFrame, list[str]], DataFrame] | None = None,
    copies: Copies | None = None,
) -> DataFrame:
    """Line items with the requested dimensions and a measure named by the last column.

    Where both parts and suppliers are needed, ``reduce`` combines the rows of a supplier between
    the two joins. Columns that it adds stay. With the ``copies`` of ``part_copies`` neither the
    join with parts nor a subtotal per part shuffles line items, but those of hot parts.
    """
    wanted, value = set(columns), columns[-1]
    by_nation, by_part = bool(wanted & {"country", "region"}), "technology" in wanted
    keys = [
        *(["l_suppkey"] if by_nation else []),
        *(["l_partkey"] if by_part else []),
        *[name for name in ("year", "type", "unit") if name in wanted],
    ]

    def narrowed(rows: DataFrame) -> DataFrame:
        items = _in_years(rows, "l_shipdate", years).withColumns(
            {
                "year": F.year("l_shipdate"),
                "type": F.col("l_linestatus"),
                "unit": _unit(F.col("l_returnflag")),
                value: measure,
            }
        )
        items = items.select(*keys, value)
        if subtotal is not None and by_nation != by_part:
            items = items.groupBy(*keys).agg(subtotal(F.col(value)).alias(value))
        return items

    added = []
    if by_part and copies is not None:
        items = joined(copies, narrowed)
    else:
        items = narrowed(table(spark, sf_dir, "lineitem"))
        if by_part:
            part = table(spark, sf_dir, "part")
            items = items.join(part, items.l_partkey == part.p_partkey)
    if reduce is not None and by_nation and by_part:
        kept = [*[key for key in keys if key != "l_partkey"], "p_type"]
        items = reduce(items.select(*kept, value), kept)
        added = [name for name in items.columns if name not in {*kept, value}]
    if by_nation:
        supplier = table(spark, sf_dir, "supplier")
        items = items.join(supplier, items.l_suppkey == supplier.s_suppkey)
    # The names come last, so that the large joins shuffle keys and not texts.
    if by_nation:
        items = _with_nation(spark, sf_dir, items, "s_nationkey")
    if "region" in wanted:
        items = _with_region(spark, sf_dir, items)
    names = {"country": "n_name", "region": "r_name", "technology": "p_type"}
    return items.select(*[F.col(names.get(name, name)).alias(name) for name in columns], *added)


def _unit(flag: Column) -> Column:
    return F.when(flag == "A", "MW").when(flag == "N", "GWh").otherwise("TJ")


def generation(
    spark: SparkSession,
    sf_dir: str,
    columns: Sequence[str] = GENERATION,
    years: tuple[int, int] | None = None,
    subtotal: Callable[[Column], Column] | None = None,
    reduce: Callable[[DataFrame, list[str]], DataFrame] | None = None,
    copies: Copies | None = None,
) -> DataFrame:
    """The requested generation columns, ``value`` last and in the GWh scale."""
    measure = normalised(_unit(F.col("l_returnflag")), F.col("l_quantity"))
    return _line_items(spark, sf_dir, columns, measure, years, subtotal, reduce, copies)


def supply_investment(
    spark: SparkSession,
    sf_dir: str,
    columns: Sequence[str] = SUPPLY_INVESTMENT,
    years: tuple[int, int] | None = None,
    subtotal: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Investment from line items, so that it does not stem from the emissions' orders."""
    measure = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return _line_items(spark, sf_dir, columns, measure, years, subtotal)


# Names in the raw panels that the alias lookup has to find.
RAW_ALIASES = {f"nation_{k} (formerly x)": f"nation_{k}" for k in range(3)}


def _flawed(key: Column, every: int, flaw: str | None, value: Column) -> Column:
    """``value``, or ``flaw`` where the key is a multiple of ``every``. No row is left out."""
    return F.when(key % every == 0, F.lit(flaw)).otherwise(value)


def _raw_country(key: Column) -> Column:
    name = F.col("n_name")
    renamed = (key % 7 == 0) & (F.col("n_nationkey") < 3)
    return (
        F.when(key % 3 == 0, F.lower(name))
        .when(renamed, F.concat(name, F.lit(" (FORMERLY X)")))
        .otherwise(name)
    )


def _figure(value: Column, digits: int = 2) -> Column:
    return value.cast(f"decimal(18,{digits})").cast("string")


def raw_emissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The emissions panel as a text table with flaws at fixed keys."""
    key = F.col("o_orderkey")
    total = _flawed(key, 89, None, _figure(F.col("o_totalprice")))
    return _orders_by_nation(spark, sf_dir, None).select(
        _flawed(key, 101, "n/a", F.year("o_orderdate").cast("string")).alias("Year"),
        _raw_country(key).alias("Country"),
        _flawed(key, 97, "n/a", total).alias("Total"),
        _flawed(key, 83, None, _figure(F.col("c_acctbal"))).alias("Per Capita"),
    )


def raw_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generation panel as a text table with flaws at fixed keys and padded headers."""
    key = F.col("l_orderkey")
    items = table(spark, sf_dir, "lineitem")
    supplier, part = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "part")
    joined = items.join(supplier, items.l_suppkey == supplier.s_suppkey).join(
        part, items.l_partkey == part.p_partkey
    )
    value = _flawed(key, 89, None, _figure(F.col("l_quantity")))
    named = _with_nation(spark, sf_dir, joined, "s_nationkey")
    return _with_region(spark, sf_dir, named).select(
        _flawed(key, 101, "n/a", F.year("l_shipdate").cast("string")).alias(" Years "),
        _raw_country(key).alias("IRENA Menu Label "),
        F.col("p_type").alias(" Technology"),
        F.col("l_linestatus").alias("Type"),
        F.col("r_name").alias(" UN Region English "),
        _unit(F.col("l_returnflag")).alias("Unit"),
        _flawed(key, 97, "n/a", value).alias(" Values "),
    )


def raw_investment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The investment panel as a text table with flaws at fixed keys and an unused column."""
    key = F.col("o_orderkey")
    amount = _figure(F.col("o_totalprice") * 0.001, digits=5)
    return _with_region(spark, sf_dir, _orders_by_nation(spark, sf_dir, None)).select(
        _raw_country(key).alias("Country/Area"),
        _flawed(key, 101, "n/a", F.year("o_orderdate").cast("string")).alias("Year"),
        _flawed(key, 97, "n/a", amount).alias("Amount (2020 USD million)"),
        F.col("o_orderpriority").alias("Technology"),
        F.col("r_name").alias("Region"),
        _flawed(key, 79, None, F.col("o_orderstatus")).alias("Status"),
    )
