"""Report state: batches added, replaced rows taken away, reports without a row of the fact."""

import pytest
from pyspark.sql import functions as F
from test_loads import MARKETING, SALES, raw

from starmill.config import MartConfig
from starmill.contracts import DIM_DATE, DIM_STAGE, FACT_MARKETING, FACT_SALES
from starmill.operators import summaries
from starmill.plans import loads, marketing_marts, revenue_marts
from starmill.sources.warehouse import Run, Warehouse


def order(i, region="North", branch="B1", product="P1", revenue="10", day="2024-01-05"):
    return (str(i), day, region, branch, product, "Milk", revenue)


def same(rows, warehouse, fact, report, *dims):
    tables = [warehouse.read(d) for d in dims]
    kept = report(loads.summary(warehouse, fact), *tables)
    assert rows(kept) == rows(report(warehouse.read(fact), *tables))
    return kept


def test_state_follows_added_and_replaced_orders(spark, tmp_path, rows):
    """Orders move between groups, groups vanish, amounts change; files are rewritten or only cut."""
    config = MartConfig(str(tmp_path), "revenue", rows_per_file=20)
    warehouse = Warehouse(spark, config)
    batches = [
        [order(i, region="R%d" % (i % 3), branch=None if i % 7 == 0 else f"B{i % 5}") for i in range(60)] + [order(99, region="Gone")],
        [order(99, region="R0", revenue="-5.5"), order(3, product=None), order(31, day="2024-03-09")],
        [order(i, region="R9", revenue=str(i)) for i in range(55)],
        [],
    ]
    for batch in batches:
        loads.load(spark, config, loads.REVENUE, raw(spark, SALES, batch))
        for report in (revenue_marts.revenue_by_region, revenue_marts.region_branch_rollup, revenue_marts.kpi_totals, revenue_marts.revenue_by_promotion):
            same(rows, warehouse, FACT_SALES, report)
        same(rows, warehouse, FACT_SALES, revenue_marts.monthly_trend, DIM_DATE)
    assert "Gone" not in {r.region_name for r in revenue_marts.revenue_by_region(loads.summary(warehouse, FACT_SALES)).collect()}


def test_reports_read_no_row_of_the_fact(spark, tmp_path, rows):
    config = MartConfig(str(tmp_path), "revenue")
    loads.load(spark, config, loads.REVENUE, raw(spark, SALES, [order(i) for i in range(9)]))
    warehouse = Warehouse(spark, config)
    kept = same(rows, warehouse, FACT_SALES, revenue_marts.revenue_by_region)
    assert kept.inputFiles() and all("/fact_sales_summary/" in f for f in kept.inputFiles())


def test_marketing_state(spark, tmp_path, rows):
    config = MartConfig(str(tmp_path), "marketing", rows_per_file=4)
    warehouse = Warehouse(spark, config)
    first = [(str(i), "2024-01-0%d" % (1 + i % 3), "Demo" if i % 2 else "Click", "TV", str(i), "Tet") for i in range(9)]
    for batch in (first, [("1", "2024-02-01", "Click", "Radio", "77", None), ("20", "2024-02-01", "Click", "TV", "1", "x")]):
        loads.load(spark, config, loads.MARKETING, raw(spark, MARKETING, batch))
        same(rows, warehouse, FACT_MARKETING, marketing_marts.stage_funnel, DIM_STAGE)
        same(rows, warehouse, FACT_MARKETING, marketing_marts.target_vs_actual, DIM_DATE)
        same(rows, warehouse, FACT_MARKETING, marketing_marts.campaign_roi)
        same(rows, warehouse, FACT_MARKETING, marketing_marts.cost_breakdown)


def test_a_fact_from_before_there_was_a_state_is_summed_up(spark, tmp_path, rows, monkeypatch):
    config = MartConfig(str(tmp_path), "revenue")
    with monkeypatch.context() as patch:
        patch.setattr(loads, "_load_summary", lambda *a: None)
        loads.load(spark, config, loads.REVENUE, raw(spark, SALES, [order(i) for i in range(9)]))
    loads.load(spark, config, loads.REVENUE, raw(spark, SALES, [order(3, revenue="50")]))
    same(rows, Warehouse(spark, config), FACT_SALES, revenue_marts.revenue_by_region)


def test_state_of_two_loads_at_one_time(spark, tmp_path, rows, monkeypatch):
    config = MartConfig(str(tmp_path), "revenue", rows_per_file=50)
    loads.load(spark, config, loads.REVENUE, raw(spark, SALES, [order(i) for i in range(40)]))
    publish, between = Run.publish, [[order(i, revenue="3") for i in range(30, 60)]]

    def late(self):
        if between:
            loads.load(spark, config, loads.REVENUE, raw(spark, SALES, between.pop()))
        return publish(self)

    monkeypatch.setattr(Run, "publish", late)
    loads.load(spark, config, loads.REVENUE, raw(spark, SALES, [order(i, revenue="7") for i in range(25, 35)]))
    same(rows, Warehouse(spark, config), FACT_SALES, revenue_marts.revenue_by_region)


@pytest.mark.parametrize("spec", summaries.SPECS.values())
def test_grouping_numbers_are_those_of_spark(spark, spec):
    assert len({spec.number(g) for g in spec.groupings}) == len(spec.groupings)


def test_sums_by_parts_are_exact(spark):
    """Measures of either sign, of all 18 digits, and missing ones; no sum is kept as bytes by row."""
    values = ["9999999999999999.99", "-9999999999999999.99", "0.01", "-0.99", "123456789.10", None]
    spec = summaries.Spec((("g",), ("h",)), ("m", "r"))
    rows = spark.createDataFrame([(i % 2, i % 7, values[i % 6]) for i in range(6000)] + [(9, 9, None)], "g INT, h INT, m STRING")
    rows = rows.select("g", "h", F.col("m").cast("decimal(18,2)").alias("m"), (F.col("m").cast("decimal(18,2)") / 10000).cast("decimal(18,6)").alias("r"))
    state = summaries.summarize(rows, spec)
    for key in ("g", "h"):
        sums = [F.sum(m).cast(f"decimal(38,{s})").alias(f"sum_{m}") for m, s in (("m", 2), ("r", 6))]
        plain = rows.groupBy(key).agg(F.count("*").alias("orders"), *sums, F.count("m").alias("count_m"), F.count("r").alias("count_r"))
        own = state.filter(F.col("grouping") == spec.number([key])).select(*plain.columns)
        assert own.schema.simpleString() == plain.schema.simpleString()
        assert own.exceptAll(plain).isEmpty() and plain.exceptAll(own).isEmpty()
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "decimal(28" not in plan.split("HashAggregate")[-1] and "partial_sum(_high_m" in plan
