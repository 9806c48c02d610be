from __future__ import annotations

import statistics

import pytest
from conftest import rows
from pyspark.sql import functions as F

from yearpanel.functions.coerce import NUMBER_TEXT, number_in_text
from yearpanel.operators import profile

NUMBERS = ["1", "1.", "+.5e3", " 2 ", "Infinity", "-inf", "0x1p3", "1d", "-7.25E-2"]
TEXTS = ["1-URGENT", "", "A", "1.2.3", "e5", "n/a", "--1", "0x", "12 34"]


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [("a", "1", 1.0), ("b", "n/a", 2.0), ("", "3", None), (None, "3", 4.0)],
        "`Avg. HH size` string, `Country/Area` string, ` Years ` double",
    )


def test_schema_rows(table):
    assert rows(profile.schema_rows(table)) == [
        (1, "Avg. HH size", "string", 4),
        (2, "Country/Area", "string", 4),
        (3, " Years ", "double", 4),
    ]


def test_blank_counts(table):
    assert rows(profile.blank_counts(table)) == [
        (" Years ", 1),
        ("Avg. HH size", 2),
        ("Country/Area", 0),
    ]


@pytest.mark.parametrize("approx", [False, True])
def test_distinct_counts_count_null_once(table, approx):
    assert rows(profile.distinct_counts(table, approx)) == [
        (" Years ", 4),
        ("Avg. HH size", 4),
        ("Country/Area", 3),
    ]


def test_distinct_counts_equal_the_loop(spark, small_tables):
    df = spark.read.parquet(f"{small_tables}/lineitem.parquet")
    loop = [(name, df.select(name).distinct().count()) for name in df.columns]
    assert rows(profile.distinct_counts(df)) == sorted(loop)


def test_summary_equals_describe(spark, small_tables):
    df = spark.read.parquet(f"{small_tables}/orders.parquet")
    described = {row[0]: row.asDict() for row in df.describe().collect()}
    for row in profile.summary(df).collect():
        name = row["column"]
        assert row["count"] == int(described["count"][name])
        if row["mean"] is not None:
            for mine, theirs in [("mean", "mean"), ("stddev", "stddev"), ("min", "min")]:
                assert row[mine] == pytest.approx(float(described[theirs][name]))
        else:
            assert (row["min_text"], row["max_text"]) == (
                described["min"][name],
                described["max"][name],
            )


def test_summary_of_text_uses_the_cells_that_are_numbers(table):
    found = {row["column"]: row for row in profile.summary(table).collect()}
    numbers = found["Country/Area"]
    assert numbers["count"] == 4
    assert numbers["mean"] == pytest.approx(7 / 3)
    assert numbers["stddev"] == pytest.approx(statistics.stdev([1, 3, 3]))
    assert (numbers["min_text"], numbers["max_text"], numbers["min"]) == ("1", "n/a", None)
    assert found["Avg. HH size"]["mean"] is None


def test_summary_per_group(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 5.0)], "lag int, x double")
    assert rows(profile.summary(df, by=["lag"]), "lag", "count", "mean", "min", "max") == [
        (0, 2, 2.0, 1.0, 3.0),
        (1, 1, 5.0, 5.0, 5.0),
    ]


def test_whole_numbers_keep_all_digits(spark):
    df = spark.createDataFrame([(9007199254740993,), (1,)], "x bigint")
    assert rows(profile.summary(df), "min_text", "max_text") == [("1", "9007199254740993")]


def test_tables_without_a_fitting_column_have_an_empty_profile(spark):
    df = spark.sql("select date'2020-01-01' as d")
    assert rows(profile.summary(df)) == []
    assert profile.summary(df).columns == profile.summary(spark.range(1)).columns
    assert rows(profile.distinct_counts(df.select())) == []


def test_sample_is_stable_with_an_order(spark):
    df = spark.createDataFrame([(3,), (1,), (None,), (2,)], "x int")
    assert [row.x for row in profile.sample(df, 3, ["x"]).collect()] == [None, 1, 2]


def test_number_form_agrees_with_the_cast(spark):
    df = spark.createDataFrame([(text,) for text in NUMBERS + TEXTS], "v string")
    cast = F.col("v").try_cast("double")
    wrong = df.filter(~cast.eqNullSafe(number_in_text("v")))
    assert rows(wrong) == []
    assert df.filter(F.col("v").rlike(NUMBER_TEXT)).count() == len(NUMBERS)


def test_sketches_of_new_files_are_added_to_the_kept_ones(spark):
    """Counts from sketches per file, before and after a file comes in, without the first files."""

    def day(k, n):
        return spark.range(n).selectExpr(
            f"{k} as file", f"id + {k * n // 2} as number", "cast(id % 50 as string) as text",
            "if(id % 10 = 0, null, id % 7 / 2.0) as share", "id % 2 = 0 as flag",
        )

    n = 4000
    first = profile.distinct_sketches(day(0, n).union(day(1, n)), ["file"])
    assert first.columns == ["file", "column", "sketch", "blanks"] and first.count() == 8
    exact = {"text": 50, "share": 8, "flag": 2}
    for kept, numbers in ((first, 1.5 * n), (first.union(profile.distinct_sketches(day(2, n), ["file"])), 2 * n)):
        found = dict(rows(profile.sketched_counts(kept)))
        assert found.pop("number") == pytest.approx(numbers, rel=0.08)
        assert found == exact
    by_file = rows(profile.sketched_counts(first, ["file"]).filter("column = 'text'"))
    assert by_file == [(0, "text", 50), (1, "text", 50)]


def test_sketches_of_nothing(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert rows(profile.sketched_counts(profile.distinct_sketches(empty))) == [("a", 0), ("b", 0)]
    assert profile.distinct_sketches(empty, ["a", "b"]).count() == 0
    nulls = spark.createDataFrame([(None, None)], "a int, b string")
    assert rows(profile.sketched_counts(profile.distinct_sketches(nulls))) == [("a", 1), ("b", 1)]
