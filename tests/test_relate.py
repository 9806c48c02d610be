from __future__ import annotations

import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from yearpanel.operators import relate


def pairs(spark, *records):
    return spark.createDataFrame(list(records), "x double, y double")


def corr(df, **options):
    return relate.correlation(df, "x", "y", **options).first().correlation


def test_correlation_leaves_out_or_zeroes_missing_sides(spark):
    df = pairs(spark, (1.0, None), (2.0, 4.0), (3.0, 6.5), (None, 1.0))
    assert corr(df) == pytest.approx(1.0)
    assert corr(df, nulls_as_zero=True) == pytest.approx(df.stat.corr("x", "y"))
    assert corr(df, nulls_as_zero=True, digits=3) == 0.896


def test_correlation_of_degenerate_groups_is_null(spark):
    assert corr(pairs(spark, (1.0, 2.0), (1.0, 3.0))) is None
    assert corr(pairs(spark, (1.0, 2.0))) is None
    assert corr(pairs(spark, (1.0, None))) is None
    assert corr(pairs(spark)) is None


def test_correlation_equals_the_builtin(spark):
    rng = random.Random(3)
    df = pairs(spark, *[(rng.gauss(1e6, 5), rng.gauss(0, 1)) for _ in range(500)])
    assert corr(df) == pytest.approx(df.select(F.corr("x", "y")).first()[0], abs=1e-12)


@pytest.fixture
def panels(spark):
    cause = [("a", y, float(y - 1999)) for y in (2000, 2001, 2003)] + [("b", 2000, 7.0)]
    effect = [("a", y, float((y - 1999) ** 2)) for y in range(2000, 2006)] + [("c", 2000, 1.0)]
    return (
        spark.createDataFrame(cause, "country string, year int, amount double"),
        spark.createDataFrame(effect, "country string, year int, value double"),
    )


def test_lagged_join_equals_one_join_per_lag(panels):
    cause, effect = panels
    found = rows(relate.lagged(cause, effect), "lag", "country", "cause_year", "effect_year")
    expected = []
    for lag in range(6):
        shifted = cause.select("country", (F.col("year") + lag).alias("year"))
        joined = shifted.join(effect, ["country", "year"])
        expected += [(lag, r.country, r.year - lag, r.year) for r in joined.collect()]
    assert found == sorted(expected)


def test_a_missing_year_is_never_bridged(panels):
    lagged = relate.lagged(*panels, lags=[1])
    assert rows(lagged, "cause_year", "effect_year") == [(2000, 2001), (2001, 2002), (2003, 2004)]


def test_lag_correlation_per_lag(panels):
    lagged = relate.lagged(*panels)
    found = dict(rows(relate.correlation(lagged, "amount", "value", by=["lag"])))
    assert set(found) == set(range(6))
    mine = [(1, 1), (2, 4), (4, 16)]
    n, sx, sy = 3, sum(x for x, _ in mine), sum(y for _, y in mine)
    sxy = sum(x * y for x, y in mine) - sx * sy / n
    sxx = sum(x * x for x, _ in mine) - sx * sx / n
    syy = sum(y * y for _, y in mine) - sy * sy / n
    assert found[0] == pytest.approx(sxy / math.sqrt(sxx * syy))


def test_lagged_join_needs_one_join_and_no_nested_loop(panels):
    plan = relate.lagged(*panels)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_same_year(panels):
    cause, effect = panels
    joined = relate.same_year(cause, effect)
    assert rows(joined, "country", "year") == [("a", 2000), ("a", 2001), ("a", 2003)]
