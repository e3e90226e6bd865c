"""Dashboard queries over the revenue star schema.

The fact is aggregated on its own keys first and meets a dimension only as aggregated rows, one per
key. So the shuffles carry groups rather than orders, a key that holds a third of all orders is one
row, and no broadcast has to be forced. Ratios are quotients of sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from starmill.functions.numbers import TOTAL, ratio, total
from starmill.operators.summaries import Summary, measured

Fact = DataFrame | Summary


def _by(fact: Fact, *keys: str) -> DataFrame:
    source = measured(fact)
    totals = [source.sum(m).cast(TOTAL).alias(m) for m in ("revenue", "profit")]
    return source.rows(*keys).groupBy(*keys).agg(source.orders().alias("orders"), *totals)


def _again() -> list[Column]:
    """The same totals over rows that already are totals."""
    return [
        F.sum("orders").alias("orders"), total("revenue").alias("revenue"), total("profit").alias("profit")
    ]


def revenue_by_region(fact: Fact) -> DataFrame:
    """A1. The grand total is a window over the region rows, so the fact is scanned once.

    One task sees that window: a row per region, however many orders there are.
    """
    everything = Window.partitionBy()
    whole = [F.sum(c).over(everything).cast(TOTAL).alias(f"all_{c}") for c in ("revenue", "profit")]
    return _by(fact, "region_name").select("*", *whole).select(
        "region_name",
        "orders",
        "revenue",
        "profit",
        ratio(F.col("revenue"), F.col("all_revenue")).alias("revenue_share"),
        ratio(F.col("profit"), F.col("all_profit")).alias("profit_share"),
    )


def region_branch_rollup(fact: Fact) -> DataFrame:
    """A2. Rolls up branch totals, not orders; ``level`` is 0 branch, 1 region, 3 all."""
    rows = _by(fact, "region_name", "branch_name")
    return rows.rollup("region_name", "branch_name").agg(
        F.grouping_id().cast("int").alias("level"), *_again()
    )


def revenue_by_category_product(fact: Fact, dim_product: DataFrame) -> DataFrame:
    """A3. Orders without a product are one row with neither product nor category."""
    return _by(fact, "product_name").join(dim_product, "product_name", "left").select(
        "category", "product_name", "orders", "revenue", "profit"
    )


def top_products_per_category(fact: Fact, dim_product: DataFrame, n: int = 5) -> DataFrame:
    """A3, best ``n`` products of each category; ties go by name.

    Spark limits each category to ``n`` rows per task before the shuffle.
    """
    best = Window.partitionBy("category").orderBy(F.desc("revenue"), F.asc("product_name"))
    products = revenue_by_category_product(fact, dim_product).filter(F.col("product_name").isNotNull())
    return products.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)


def revenue_by_channel(fact: Fact) -> DataFrame:
    """A4."""
    return _by(fact, "channel_name")


def revenue_by_segment(fact: Fact) -> DataFrame:
    """A5."""
    return _by(fact, "segment_name")


def revenue_by_promotion(fact: Fact) -> DataFrame:
    """A6. Orders without a promotion are a group of their own."""
    return _by(fact, "promotion_campaign").withColumn(
        "margin", ratio(F.col("profit"), F.col("revenue"))
    )


def _by_day(fact: Fact, dim_date: DataFrame) -> DataFrame:
    return _by(fact, "full_date").join(dim_date, "full_date")


def monthly_trend(fact: Fact, dim_date: DataFrame) -> DataFrame:
    """A7. The one-partition window sees months, of which the supported dates span about 7,000."""
    days = _by_day(fact, dim_date)
    months = days.groupBy("year_month").agg(*_again())
    previous = F.lag("revenue").over(Window.orderBy("year_month"))
    return months.withColumn("previous_revenue", previous).select(
        "*",
        (F.col("revenue") - F.col("previous_revenue")).cast("decimal(38,2)").alias("change"),
        ratio(F.col("revenue") - F.col("previous_revenue"), F.col("previous_revenue")).alias("change_rate"),
    )


def calendar_rollup(fact: Fact, dim_date: DataFrame) -> DataFrame:
    """A8. ``level`` is 0 month, 1 quarter, 3 year, 7 all."""
    days = _by_day(fact, dim_date)
    months = days.groupBy("year", "quarter", "year_month").agg(*_again())
    return months.rollup("year", "quarter", "year_month").agg(
        F.grouping_id().cast("int").alias("level"), *_again()
    )


def kpi_totals(fact: Fact) -> DataFrame:
    """A9."""
    measures = ["revenue", "profit", "cost", "market_size", "budget", "logistics_cost", "marketing_cost"]
    source = measured(fact)
    totals = [source.sum(m).cast(TOTAL).alias(m) for m in measures]
    totals = source.rows().agg(F.coalesce(source.orders(), F.lit(0)).alias("orders"), *totals)
    return totals.select("*", ratio(F.col("profit"), F.col("revenue")).alias("margin"))
