from __future__ import annotations

from conftest import rows

from yearpanel.functions.names import (
    DEVELOPED_COUNTRIES,
    EMISSIONS_ALIASES,
    GENERATION_ALIASES,
    INVESTMENT_ALIASES,
)
from yearpanel.operators import names


def frame(spark, *values):
    return spark.createDataFrame([(value,) for value in values], "country string")


def test_fixed_tables():
    sizes = [len(t) for t in (EMISSIONS_ALIASES, GENERATION_ALIASES, INVESTMENT_ALIASES)]
    assert sizes == [18, 6, 9]
    assert len(DEVELOPED_COUNTRIES) == 28


def test_mapping_and_frame_give_the_same_names(spark):
    raw = frame(spark, "Türkiye", "CÔTE D'IVOIRE", "Spain", None)
    aliases = spark.createDataFrame(
        list(INVESTMENT_ALIASES.items()), "alias string, canonical string"
    )
    expected = [(None,), ("cote d ivoire",), ("spain",), ("turkey",)]
    assert rows(names.harmonise(raw, INVESTMENT_ALIASES)) == expected
    assert rows(names.harmonise(raw, aliases)) == expected


def test_repeated_aliases_do_not_multiply_rows(spark):
    aliases = spark.createDataFrame(
        [("burma", "myanmar"), ("burma", "myanmar")], "alias string, canonical string"
    )
    assert rows(names.harmonise(frame(spark, "Burma"), aliases)) == [("myanmar",)]


def test_sources_keep_their_own_aliases(spark):
    raw = frame(spark, "North Macedonia")
    assert rows(names.harmonise(raw, GENERATION_ALIASES)) == [("macedonia",)]
    assert rows(names.harmonise(raw, INVESTMENT_ALIASES)) == [("north macedonia",)]


def test_unmatched_is_a_set_difference_in_which_nulls_match(spark):
    left = frame(spark, "a", "a", "b", "c", None)
    assert rows(names.unmatched(left, frame(spark, "b", None), "country")) == [("a",), ("c",)]
    assert rows(names.unmatched(left, frame(spark, "b"), "country")) == [(None,), ("a",), ("c",)]


def test_distinct_values(spark):
    assert rows(names.distinct_values(frame(spark, "a", "a", None), "country")) == [(None,), ("a",)]
