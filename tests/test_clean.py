from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from yearpanel.functions.units import normalised
from yearpanel.operators import clean
from yearpanel.sources.files import read_table

EMISSIONS = """Year,Country,Total,Per Capita,Note
2001,Italy (including San Marino),10.5,1.0,x
abcd,Italy,1,1,x
2002,Italy,bad,2.0,x
2003,Italy,,2.0,x
2004,Italy,"",2.0,x
1999,Italy,3,1,x
2024,Italy,3,1,x
2023,CZECH REPUBLIC (CZECHIA),7,1,
2001.7,Italy,4,1,x
"""

GENERATION_HEADER = [
    " Years ",
    "IRENA Menu Label ",
    "Technology",
    " Type",
    "UN Region English",
    "Unit",
    "Values ",
    "Avg. HH size",
]


@pytest.fixture(scope="module")
def emissions_csv(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("raw") / "emissions.csv"
    path.write_text(EMISSIONS)
    return read_table(spark, str(path))


@pytest.fixture(params=[True, False], ids=["ansi", "lenient"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_csv_columns_are_text(emissions_csv):
    assert {kind for _, kind in emissions_csv.dtypes} == {"string"}


def test_clean_emissions_keeps_unreadable_totals_as_null(emissions_csv, ansi):
    panel = clean.clean_emissions(emissions_csv)
    assert dict(panel.dtypes) == {
        "country": "string",
        "year": "int",
        "total": "double",
        "per_capita": "double",
    }
    assert rows(panel) == [
        ("czech republic", 2023, 7.0, 1.0),
        ("italy", 2001, 10.5, 1.0),
        ("italy", 2001, 4.0, 1.0),
        ("italy", 2002, None, 2.0),
    ]


def test_year_range_is_a_parameter(emissions_csv):
    assert rows(clean.clean_emissions(emissions_csv, years=(1999, 1999)), "year") == [(1999,)]


def generation(spark, *records):
    return spark.createDataFrame(
        [("2010", country, "Wind", "On-grid", "Europe", unit, value, None)
         for country, unit, value in records],
        ", ".join(f"`{name}` string" for name in GENERATION_HEADER),
    )


def test_clean_generation_drops_unreadable_values_and_scales_units(spark, ansi):
    raw = generation(
        spark,
        ("Czechia", "GWh", "10.5"),
        ("Cote d'Ivoire", "MW", "10.5"),
        ("Spain", "TJ", "3"),
        ("Spain", "GWh", "n/a"),
        ("Spain", None, "3"),
        ("Spain", "GWh", None),
        (None, "GWh", "3"),
        ("Spain", "GWh", "NaN"),
    )
    assert rows(clean.clean_generation(raw), "country", "unit", "value") == [
        ("cote d ivoire", "MW", 0.0105),
        ("czech republic", "GWh", 10.5),
        ("spain", "TJ", 3.0),
    ]


def test_headers_are_trimmed_in_one_projection(spark):
    trimmed = clean.trimmed_headers(generation(spark, ("Spain", "GWh", "1")))
    assert trimmed.columns == [name.strip() for name in GENERATION_HEADER]


def test_unit_table_can_be_replaced(spark):
    df = spark.createDataFrame([("TWh", 2.0), ("GWh", 3.0)], "unit string, value double")
    value = normalised(F.col("unit"), F.col("value"), {"TWh": 0.001})
    assert rows(df.select("unit", value.alias("value"))) == [("GWh", 3.0), ("TWh", 2000.0)]


@pytest.fixture
def investment(spark):
    amount = "Amount (2020 USD million)"
    return spark.createDataFrame(
        [
            ("Türkiye", "2001", "1.5", "Wind", "Asia", "a"),
            ("Guinea-Bissau", "2001", "oops", "Wind", "Africa", "a"),
            ("Spain", "2002", "2", "Solar", "Europe", None),
            ("Spain", "2003", "4", "Solar", "Europe", "a"),
            ("Canada", "2003", "8", "Wind", "America", "a"),
            ("Canada", "1990", "8", "Wind", "America", "a"),
        ],
        f"`Country/Area` string, Year string, `{amount}` string, Technology string, "
        "Region string, Donor string",
    )


def test_clean_investment_drops_on_any_raw_column_but_keeps_unreadable_amounts(investment, ansi):
    assert rows(clean.clean_investment(investment), "country", "amount") == [
        ("canada", 8.0),
        ("guinea bissau", None),
        ("spain", 4.0),
        ("turkey", 1.5),
    ]


def test_investment_filters(spark, investment):
    def countries(**filters):
        return [name for (name,) in rows(clean.clean_investment(investment, **filters), "country")]

    table = spark.createDataFrame([("spain",), ("spain",)], "name string")
    assert countries(countries=["spain", "canada"]) == ["canada", "spain"]
    assert countries(technology="Wind") == ["canada", "guinea bissau", "turkey"]
    assert countries(countries=["spain", "canada"], technology="Wind") == ["canada"]
    assert countries(countries=table) == ["spain"]
    assert countries(countries=["spain", "canada"], keep_raw=True) == ["canada", "spain"]


def test_raw_columns_can_be_kept(investment):
    kept = clean.clean_investment(investment, keep_raw=True)
    assert kept.columns == [*investment.columns, "Country", "TotalFinanceFlow"]


def test_cleaning_does_not_shuffle(investment, emissions_csv):
    for panel in (clean.clean_investment(investment), clean.clean_emissions(emissions_csv)):
        assert "Exchange" not in panel._jdf.queryExecution().executedPlan().toString()


def test_a_table_of_countries_is_looked_up_when_an_action_runs(spark, tmp_path):
    names = [f"land {k}" for k in range(3000)] + [None, "Ünï"]
    panel = spark.createDataFrame([(n, k) for k, n in enumerate(names)], "country string, k int")
    wanted = spark.createDataFrame([(n,) for n in names[::3] + [None, "elsewhere"]], "name string")
    path = str(tmp_path / "wanted")
    wanted.write.parquet(path)
    spark.sparkContext.setJobGroup("lookup", "")
    found = clean.in_countries(panel, spark.read.schema("name string").parquet(path))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("lookup")
    expected = sorted(n for n in names[::3] if n)
    assert sorted(n for (n, _) in found.collect()) == expected
    many = clean.in_countries(panel, wanted, listed=False)
    assert sorted(n for (n, _) in many.collect()) == expected
    assert clean.in_countries(panel, wanted.limit(0)).count() == 0
    main = found._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    assert "Exchange" not in main and "Join" not in main


def test_each_text_is_parsed_once(spark, tmp_path):
    raw = spark.createDataFrame(
        [("2003", "x", "a", "b", "c", "MW", "1.5"), ("1900", "y", "a", "b", "c", "MW", "n/a")],
        [f" {name} " for name in clean.GENERATION_COLUMNS],
    )
    path = str(tmp_path / "raw")
    raw.write.parquet(path)
    cleaned = clean.clean_generation(spark.read.parquet(path), (2000, 2005))
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert plan.count("as double") == 2  # the year and the figure
    assert "Exchange" not in plan and "*(1) Generate" in plan
    assert [tuple(row)[:2] for row in cleaned.collect()] == [("x", 2003)]


def test_a_column_named_like_the_typed_year(spark):
    raw = spark.createDataFrame(
        [("2003", "x", "a", "r", "5", "mine")],
        ["Year", "Country/Area", "Technology", "Region", clean.AMOUNT_COLUMN, "TYPED_year"],
    )
    kept = clean.clean_investment(raw, (2000, 2005), keep_raw=True)
    assert kept.columns == [*raw.columns, "Country", "TotalFinanceFlow"]
    assert kept.first()["TYPED_year"] == "mine"
    assert clean.clean_investment(raw, (2000, 2005)).first()["year"] == 2003
