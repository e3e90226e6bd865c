"""Every registered query against its SQL on the smallest tables, and the shape of the plans."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from starmill.oracles import ORACLES
from starmill.registry import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in os.listdir(sf_dir):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{file}'")
    return connection


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(str(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    expected = duck.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    assert normal(df.columns, df.collect()) == normal(columns, expected.fetchall())


def test_entry(spark):
    assert entry_points.entry(spark).count() == 5


LOADS = ("kept_", "revenue_", "marketing_load", "marketing_created", "loaded_dim", "upsert_sparse", "declared")
READS = [n for n in QUERIES if not n.startswith(LOADS) or n.startswith("revenue_by")]


@pytest.mark.parametrize("name", READS)
def test_plan_stays_in_the_jvm_without_cross_joins(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_scans_the_fact_once(spark, sf_dir):
    plan = final_plan(QUERIES["revenue_by_region"](spark, sf_dir))
    final = plan[: plan.index("Initial Plan")]
    assert final.count("FileScan") == 1


@pytest.mark.parametrize("name", ["dim_product", "dim_branch"])
def test_first_and_last_values_need_no_sort_aggregate(spark, sf_dir, name):
    assert "SortAggregate" not in final_plan(QUERIES[name](spark, sf_dir))


def test_conflicts_are_really_exercised(spark, sf_dir):
    assert QUERIES["branch_conflicts"](spark, sf_dir).count() > 0
    assert QUERIES["product_conflicts"](spark, sf_dir).count() > 0


def test_mart_reads_only_its_columns(spark, sf_dir):
    plan = QUERIES["revenue_by_region"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<region:string,revenue:decimal(18,2),profit:decimal(18,2)>" in plan
