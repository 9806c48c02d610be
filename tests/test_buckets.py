"""Copies in the same buckets: joins without a shuffle, hot keys beside the buckets."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from yearpanel.operators import model
from yearpanel.sources import panels
from yearpanel.sources.buckets import dealt, dropped, joined

NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def no_broadcast(spark):
    before = {name: spark.conf.get(name, None) for name in NO_BROADCAST}
    for name, value in NO_BROADCAST.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def tables(spark, n=2000, hot=3):
    """A third of the rows has key 7, a ninth has no key, key 50 and more have no partner."""
    key = F.when(F.col("id") % hot == 0, 7).when(F.col("id") % 9 == 1, None)
    large = spark.range(n).select(
        F.col("id").alias("row"), key.otherwise(F.col("id") % 60).cast("bigint").alias("a key")
    )
    other = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("name"))
    return large, other


def test_joins_like_the_tables(spark):
    large, other = tables(spark)
    copies = dealt(large, "a key", other, "k", 4)
    assert rows(joined(copies)) == rows(large.join(other, large["`a key`"] == other["k"]))
    assert rows(copies.rows.unionByName(copies.hot)) == rows(large)


def test_only_hot_and_missing_keys_stay_out_of_the_buckets(spark):
    large, other = tables(spark)
    copies = dealt(large, "a key", other, "k", 4)
    assert {row[0] for row in copies.hot.select("`a key`").distinct().collect()} == {7, None}
    assert [row["k"] for row in copies.few.collect()] == [7]
    largest = copies.rows.groupBy("`a key`").count().agg(F.max("count")).first()[0]
    assert largest <= 2000 / 4


def test_a_bucket_is_one_file(spark):
    large, other = tables(spark)
    copies = dealt(large, "a key", other, "k", 4)
    for frame in (copies.rows, copies.other):
        files = [row[0] for row in frame.select(F.input_file_name()).distinct().collect()]
        assert len(files) <= 4


def test_buckets_join_without_an_exchange(spark, no_broadcast):
    large, other = tables(spark)
    copies = dealt(large, "a key", other, "k", 4)
    buckets = copies.rows.join(copies.other, copies.rows["`a key`"] == copies.other["k"])
    assert "Exchange" not in plan_of(buckets)
    per_key = copies.rows.groupBy("`a key`").agg(F.sum("row"))
    assert "Exchange" not in plan_of(per_key)


def test_rows_may_be_prepared(spark):
    large, other = tables(spark)
    copies = dealt(large, "a key", other, "k", 4)
    summed = lambda df: df.filter("row > 10").groupBy("`a key`").agg(F.sum("row").alias("rows"))
    expected = summed(large)
    expected = expected.join(other, expected["`a key`"] == other["k"])
    assert rows(joined(copies, summed)) == rows(expected)


@pytest.mark.parametrize("n, condition", [(0, "true"), (50, "false"), (50, "`a key` is null")])
def test_empty_tables_and_no_keys(spark, n, condition):
    large, other = tables(spark, n)
    copies = dealt(large.filter(condition), "a key", other, "k", 4)
    assert joined(copies).count() == 0
    assert copies.rows.count() + copies.hot.count() == large.filter(condition).count()


def test_keys_of_different_types_are_refused(spark):
    large, other = tables(spark)
    with pytest.raises(ValueError, match="different types"):
        dealt(large, "a key", other.withColumn("k", F.col("k").cast("int")), "k", 4)


def test_copies_are_dropped(spark):
    copies = dealt(*[x for pair in zip(tables(spark), ["a key", "k"]) for x in pair], 4)
    folders = [frame.scratch for frame in copies[:4]]
    assert all(os.path.isdir(folder) for folder in folders)
    dropped(copies)
    assert not any(os.path.isdir(folder) for folder in folders)
    assert not spark.catalog.tableExists(copies.rows.registered)


def test_line_items_do_not_shuffle_below_the_join_with_parts(spark, small_tables, no_broadcast):
    copies = panels.part_copies(spark, small_tables, 4)
    assert copies.hot.count() == 0
    columns = ["country", "year", "technology", "value"]
    frame = panels.generation(
        spark, small_tables, columns, reduce=model.supplier_points, copies=copies
    )
    plan = plan_of(frame)
    by_part = [line for line in plan.splitlines() if "hashpartitioning(l_partkey" in line]
    plain = plan_of(panels.generation(spark, small_tables, columns, reduce=model.supplier_points))
    assert "hashpartitioning(l_partkey" in plain
    # What shuffles by part are the rows of hot parts only, of which there are none here.
    assert len(by_part) <= 1
    bucketed = copies.rows.join(copies.other, F.col("l_partkey") == F.col("p_partkey"))
    assert "Exchange" not in plan_of(bucketed) and "Bucketed: true" in plan_of(bucketed)
