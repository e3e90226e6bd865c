"""Dashboard queries over the marketing star schema (A10-A17). Same rules as the revenue marts; ``fact``
may be the rows of the fact or its summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starmill.functions.numbers import RATIO, TOTAL, ratio, total
from starmill.operators.summaries import Rows, Summary, measured

Fact = DataFrame | Summary

COSTS = ["raw_material_cost", "labor_cost", "logistics_cost", "marketing_cost"]


def _average(source: Rows | Summary, column: str) -> Column:
    """Mean over the rows that have a value, from exact sums."""
    return ratio(source.sum(column).cast("decimal(38,6)"), source.count(column).cast("decimal(20,0)"))


def _total(source: Rows | Summary, column: str, alias: str | None = None) -> Column:
    return source.sum(column).cast(TOTAL).alias(alias or column)


def _performance(fact: Fact, *keys: str) -> DataFrame:
    source = measured(fact)
    totals = [_total(source, c) for c in ("revenue", "profit", "marketing_cost", "budget", "target")]
    return source.rows(*keys).groupBy(*keys).agg(source.orders().alias("orders"), *totals)


def _rolled(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(
        F.sum("orders").alias("orders"),
        *[total(c).alias(c) for c in ("revenue", "profit", "marketing_cost", "budget", "target")],
    )


def stage_funnel(fact: Fact, dim_stage: DataFrame) -> DataFrame:
    """A10. Every stage, also without orders, against the step before it.

    The step before is found by an equi-join on the order number, not by a window over all stages:
    unseen stages share number 99, have no step before, and there may be any number of them.
    """
    source = measured(fact)
    seen = source.rows("stage_name").groupBy("stage_name").agg(
        source.orders().alias("orders"),
        _total(source, "revenue"),
        _average(source, "conversion_proxy").alias("avg_conversion"),
    )
    stages = dim_stage.join(seen, "stage_name", "left").select(
        "stage_name",
        "stage_order",
        "stage_group",
        F.coalesce("orders", F.lit(0)).alias("orders"),
        F.coalesce("revenue", F.lit(0).cast(TOTAL)).alias("revenue"),
        "avg_conversion",
    )
    before = stages.groupBy((F.col("stage_order") + 1).alias("stage_order")).agg(
        F.sum("orders").alias("previous_orders")
    )
    return stages.join(before, "stage_order", "left").select(
        *stages.columns,
        "previous_orders",
        ratio(F.col("orders").cast("decimal(20,0)"), F.col("previous_orders").cast("decimal(20,0)")).alias(
            "step_ratio"
        ),
    )


def channel_effectiveness(fact: Fact, dim_channel: DataFrame) -> DataFrame:
    """A11."""
    rows = _performance(fact, "channel_name").join(dim_channel, "channel_name", "left")
    return rows.select(
        "channel_type",
        "channel_name",
        "orders",
        "revenue",
        "profit",
        "marketing_cost",
        ratio(F.col("revenue"), F.col("marketing_cost")).alias("revenue_per_marketing_cost"),
        ratio(F.col("profit"), F.col("revenue")).alias("margin"),
    )


def channel_type_effectiveness(fact: Fact, dim_channel: DataFrame) -> DataFrame:
    """A11 by type of channel."""
    rows = _rolled(_performance(fact, "channel_name").join(dim_channel, "channel_name", "left"), "channel_type")
    return rows.select(
        "channel_type",
        "orders",
        "revenue",
        "profit",
        "marketing_cost",
        ratio(F.col("revenue"), F.col("marketing_cost")).alias("revenue_per_marketing_cost"),
        ratio(F.col("profit"), F.col("revenue")).alias("margin"),
    )


def campaign_performance(fact: Fact, dim_campaign: DataFrame) -> DataFrame:
    """A12. Orders without a campaign are a group of their own."""
    rows = _performance(fact, "campaign_name").join(dim_campaign, "campaign_name", "left")
    return rows.select("campaign_type", "campaign_name", "orders", "revenue", "profit", "marketing_cost")


def campaign_type_performance(fact: Fact, dim_campaign: DataFrame) -> DataFrame:
    """A12 by type of campaign."""
    rows = _performance(fact, "campaign_name").join(dim_campaign, "campaign_name", "left")
    return _rolled(rows, "campaign_type").select(
        "campaign_type", "orders", "revenue", "profit", "marketing_cost"
    )


def target_vs_actual(fact: Fact, dim_date: DataFrame) -> DataFrame:
    """A13. By channel and month; the gap sums the per-order gaps."""
    source, keys = measured(fact), ("channel_name", "full_date")
    days = source.rows(*keys).groupBy(*keys).agg(
        _total(source, "revenue"), _total(source, "target"), _total(source, "target_gap", "gap")
    )
    months = days.join(dim_date.select("full_date", "year_month"), "full_date").groupBy(
        "channel_name", "year_month"
    )
    return months.agg(
        total("revenue").alias("revenue"), total("target").alias("target"), total("gap").alias("target_gap")
    ).select("*", ratio(F.col("revenue"), F.col("target")).alias("achievement_rate"))


def campaign_roi(fact: Fact) -> DataFrame:
    """A14. Profit over budget; ``avg_roi`` is the mean of the per-order figure."""
    source = measured(fact)
    return source.rows("campaign_name").groupBy("campaign_name").agg(
        _total(source, "profit"),
        _total(source, "budget"),
        ratio(source.sum("profit").cast(TOTAL), source.sum("budget").cast(TOTAL)).alias("roi"),
        _average(source, "roi_marketing_calc").alias("avg_roi"),
    )


def cost_breakdown(fact: Fact) -> DataFrame:
    """A15. One row per machine and cost component, with its share of the machine's cost."""
    source = measured(fact)
    sums = source.rows("machine_name").groupBy("machine_name").agg(
        *[_total(source, c) for c in COSTS],
        _average(source, "unit_cost").alias("avg_unit_cost"),
        _average(source, "cost_per_machine_unit").alias("avg_cost_per_machine_unit"),
    )
    amounts = [F.coalesce(c, F.lit(0).cast(TOTAL)) for c in COSTS]
    wide = sums.withColumn("all_costs", reduce(Column.__add__, amounts).cast(TOTAL))
    kept = ["machine_name", "avg_unit_cost", "avg_cost_per_machine_unit", "all_costs"]
    long = wide.unpivot(kept, COSTS, "component", "amount")
    return long.select(
        "machine_name",
        "component",
        "amount",
        ratio(F.col("amount"), F.col("all_costs")).alias("share"),
        "avg_unit_cost",
        "avg_cost_per_machine_unit",
    )


def operations_summary(fact: Fact) -> DataFrame:
    """A16. By department, machine and information."""
    source, keys = measured(fact), ("department_name", "machine_name", "information_name")
    return source.rows(*keys).groupBy(*keys).agg(
        source.orders().alias("orders"),
        _total(source, "inventory_level", "inventory"),
        _total(source, "calls"),
        _total(source, "waiting_time"),
        _average(source, "inventory_level").alias("avg_inventory"),
        _average(source, "calls").alias("avg_calls"),
        _average(source, "waiting_time").alias("avg_waiting_time"),
    )


def market_metrics(fact: Fact, dim_date: DataFrame) -> DataFrame:
    """A17. By month, from per-day sums and counts."""
    source = measured(fact)
    days = source.rows("full_date").groupBy("full_date").agg(
        _total(source, "market_size"),
        source.count("market_size").alias("n_size"),
        source.sum("market_share").cast("decimal(38,6)").alias("market_share"),
        source.count("market_share").alias("n_share"),
        _total(source, "revenue"),
    )
    months = days.join(dim_date.select("full_date", "year_month"), "full_date").groupBy("year_month")
    sums = months.agg(
        total("market_size").alias("market_size"),
        F.sum("n_size").cast("decimal(20,0)").alias("n_size"),
        F.sum("market_share").cast("decimal(38,6)").alias("share"),
        F.sum("n_share").cast("decimal(20,0)").alias("n_share"),
        total("revenue").alias("revenue"),
    )
    return sums.select(
        "year_month",
        "market_size",
        "revenue",
        ratio(F.col("market_size"), F.col("n_size")).alias("avg_market_size"),
        ratio(F.col("share"), F.col("n_share")).alias("avg_market_share"),
        ratio(F.col("revenue"), F.col("market_size")).cast(RATIO).alias("revenue_of_market"),
    )
