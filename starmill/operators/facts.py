"""Fact rows from a clean frame (F1-F6, P8). Plain projections: no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starmill.contracts import FACT_MARKETING, FACT_SALES, Table
from starmill.functions.numbers import MONEY, ratio

# Fact column <- clean column, where the names differ.
RENAMED = {
    "full_date": "date",
    "region_name": "region",
    "branch_name": "branch",
    "product_name": "product",
    "channel_name": "channel",
    "segment_name": "customer_segment",
    "stage_name": "stage",
    "information_name": "information",
    "machine_name": "machine",
    "department_name": "department",
    "campaign_name": "campaign",
}
GENERATED = ("target_gap", "target_achievement_rate", "roi_marketing_calc", "created_at")


def to_fact(clean: DataFrame, table: Table) -> DataFrame:
    return clean.select(
        *[F.col(RENAMED.get(c, c)).alias(c) for c in table.names if c not in GENERATED]
    )


def sales_fact(clean: DataFrame) -> DataFrame:
    return to_fact(clean, FACT_SALES)


def marketing_fact(clean: DataFrame) -> DataFrame:
    """Loaded measures plus the three computed ones, taken from the rounded decimals."""
    zero = F.lit(0).cast(MONEY)
    gap = F.coalesce("revenue", zero) - F.coalesce("target", zero)
    return to_fact(clean, FACT_MARKETING).select(
        "*",
        gap.try_cast(MONEY).alias("target_gap"),
        ratio(F.col("revenue"), F.col("target")).alias("target_achievement_rate"),
        ratio(F.col("profit"), F.col("budget")).alias("roi_marketing_calc"),
    )
