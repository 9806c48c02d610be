"""Every registered query against its SQL twin, and the shape of plans that must scale."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from yearpanel.operators import clean
from yearpanel.plans.catalog import QUERIES
from yearpanel.sources import panels

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@pytest.fixture(scope="module")
def twin(small_tables):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small_tables}/{name}.parquet'")
    return connection


def plain(value):
    if value is None:
        return ""
    return repr(float(value)) if isinstance(value, (int, float)) else str(value)


def comparable(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in found)


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_twin(spark, small_tables, twin, name):
    df = contract.queries()[name](spark, small_tables)
    cursor = twin.execute(contract.oracle_sql()[name])
    columns = [item[0] for item in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert comparable(df.columns, df.collect()) == comparable(columns, cursor.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() == 10


def plan_of(spark, sf_dir, name):
    """The plan with no side small enough to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


LAZY = [
    name
    for name in QUERIES
    if not name.startswith(("csv_", "ml_within", "ml_impact", "ml_pred", "ml_coef", "profile_distinct"))
]


@pytest.mark.parametrize("name", LAZY)
def test_no_plan_broadcasts_by_hint_or_loops(spark, small_tables, name):
    plan = plan_of(spark, small_tables, name)
    assert "Broadcast" not in plan
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert "Python" not in plan and "ScalaUDF" not in plan


@pytest.mark.parametrize(
    "name, columns",
    [
        ("top10_emitters", "o_custkey:bigint,o_totalprice:double"),
        ("generation_by_type", "l_quantity:double,l_returnflag:string,l_linestatus:string"),
    ],
)
def test_scans_read_only_what_is_needed(spark, small_tables, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan_of(spark, small_tables, name)


def test_year_range_reaches_the_scan(spark, small_tables):
    panel = panels.emissions(spark, small_tables, (1995, 2000))
    plan = panel._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1995-01-01" in plan


def test_bigint_years_are_pruned_in_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw = spark.sql("select 2001L as Year, 'x' as Country, '1' as Total, '2' as `Per Capita`")
    raw.write.parquet(path)
    cleaned = clean.clean_emissions(spark.read.parquet(path), (2000, 2005))
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(Year,2000)" in plan and "LessThanOrEqual(Year,2005)" in plan
    assert dict(cleaned.dtypes)["year"] == "int" and cleaned.count() == 1


def test_a_table_of_countries_does_not_shuffle_the_panel(spark, small_tables):
    plan = plan_of(spark, small_tables, "investment_filtered_country_table")
    assert "LeftSemi" not in plan and "hashpartitioning(country" not in plan


def test_line_items_are_reduced_before_suppliers_are_joined(spark, small_tables):
    plan = plan_of(spark, small_tables, "ml_training_frame")
    join = plan.index("Join [l_suppkey")
    assert "partial_stddev_pop" in plan[join : plan.index("l_suppkey:bigint")]


def test_line_items_are_combined_before_the_join(spark, small_tables):
    plan = plan_of(spark, small_tables, "generation_by_region_year")
    scan = plan.index("l_suppkey:bigint")
    last_join = plan.rindex("Join [l_suppkey", 0, scan)
    assert "partial_sum" in plan[last_join:scan]
