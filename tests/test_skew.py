"""A customer, a supplier and a part that hold a third of all rows each."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from yearpanel.operators import model
from yearpanel.plans import reports
from yearpanel.sources import panels

TABLES = ["region", "nation", "customer", "supplier", "part"]
SMALL_CLUSTER = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.files.maxPartitionBytes": "128KB",
    "spark.sql.files.openCostInBytes": "64KB",
}


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    source = "/root/testdata/sf0.1"

    def heavy(df, key, chosen):
        return df.withColumn(key, F.when(chosen, F.lit(7).cast("bigint")).otherwise(F.col(key)))

    for name in TABLES:
        panels.table(spark, source, name).write.parquet(f"{folder}/{name}.parquet")
    orders = panels.table(spark, source, "orders")
    orders = heavy(orders, "o_custkey", F.xxhash64("o_orderkey") % 3 == 0)
    orders.repartition(8).write.parquet(f"{folder}/orders.parquet")
    items = panels.table(spark, source, "lineitem")
    draw = F.pmod(F.xxhash64(*items.columns), F.lit(3))
    items = heavy(heavy(items, "l_suppkey", draw == 0), "l_partkey", draw == 1)
    items.repartition(8).write.parquet(f"{folder}/lineitem.parquet")
    return folder


@pytest.fixture
def small_cluster(spark):
    before = {name: spark.conf.get(name, None) for name in SMALL_CLUSTER}
    for name, value in SMALL_CLUSTER.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def executed(df):
    found = sorted(tuple(row) for row in df.collect())
    return found, df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_customer_is_split(spark, skewed, small_cluster):
    found, plan = executed(reports.emissions_country_year(panels.emissions(spark, skewed)))
    assert "skew=true" in plan
    assert len(found) == 175


def test_a_hot_supplier_arrives_combined(spark, skewed, small_cluster):
    columns = ["country", "year", "value"]
    combined = panels.generation(spark, skewed, columns, subtotal=F.sum)
    plain = panels.generation(spark, skewed, columns)
    mine, mine_plan = executed(reports.generation_country_year(combined, digits=2))
    other, other_plan = executed(reports.generation_country_year(plain, digits=2))
    assert mine == other
    assert "skew=true" in other_plan and "skew=true" not in mine_plan


def test_a_hot_part_is_split_and_a_hot_supplier_arrives_reduced(spark, skewed, small_cluster):
    columns = ["country", "year", "technology", "value"]
    reduced = panels.generation(spark, skewed, columns, reduce=model.supplier_points)
    mine, plan = executed(model.label_points(reduced))
    assert "skew=true" in plan
    other, _ = executed(model.label_points(panels.generation(spark, skewed, columns)))
    assert len(mine) == len(other) > 1000
    for a, b in zip(mine, other):
        assert a[:3] == b[:3] and a[4] == b[4]
        assert a[3] == pytest.approx(b[3], rel=1e-9)


def test_hot_keys_of_the_raw_panel_are_split(spark, skewed, small_cluster):
    raw = panels.raw_generation(spark, skewed).groupBy("Type", "Unit").agg(F.count("*").alias("n"))
    found, plan = executed(raw)
    assert "skew=true" in plan
    assert sum(row[2] for row in found) == panels.table(spark, skewed, "lineitem").count()
