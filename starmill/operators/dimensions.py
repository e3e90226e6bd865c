"""Dimension batches from a clean frame (D1-D13). Each has one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from starmill.contracts import DIM_STAGE
from starmill.sources import seeds
from starmill.sources.headers import ORDINAL


def distinct_names(clean: DataFrame, column: str, key: str) -> DataFrame:
    """The distinct non-null names of a column."""
    return clean.filter(F.col(column).isNotNull()).select(F.col(column).alias(key)).distinct()


def date_dim(clean: DataFrame) -> DataFrame:
    """One row per calendar day, its parts derived after the days are distinct."""
    days = clean.select(F.col("date").alias("full_date")).distinct()
    return days.select(
        "full_date",
        F.year("full_date").alias("year"),
        F.month("full_date").alias("month"),
        F.date_format("full_date", "MMMM").alias("month_name"),
        F.quarter("full_date").alias("quarter"),
        F.date_format("full_date", "yyyy-MM").alias("year_month"),
    )


def attribute_dim(clean: DataFrame, key: str, attribute: str, keep: str, ordinal: str = ORDINAL) -> DataFrame:
    """One attribute value per key: that of the first or last row in ordinal order.

    The value may be NULL: a first row without a category gives no category. Rows are reduced to
    distinct (key, attribute) pairs first, by a hash aggregate, so a hot key never travels as rows.
    Of rows at one position the smallest value counts, whatever the order of tasks.
    """
    edge, order = (F.min, F.col("at").asc()) if keep == "first" else (F.max, F.col("at").desc())
    pairs = clean.filter(F.col(key).isNotNull()).groupBy(key, attribute).agg(edge(ordinal).alias("at"))
    nth = F.row_number().over(Window.partitionBy(key).orderBy(order, F.col(attribute).asc_nulls_last()))
    return pairs.withColumn("_nth", nth).filter("_nth = 1").select(key, attribute)


def branch_dim(clean: DataFrame) -> DataFrame:
    return attribute_dim(clean, "branch", "region", keep="last").toDF("branch_name", "region_name")


def product_dim(clean: DataFrame) -> DataFrame:
    return attribute_dim(clean, "product", "category", keep="first").toDF("product_name", "category")


def key_conflicts(clean: DataFrame, key: str, attribute: str) -> DataFrame:
    """Keys that come with more than one attribute value in a batch (U4); NULL counts as a value."""
    pairs = clean.filter(F.col(key).isNotNull()).groupBy(key, attribute).agg(F.count("*").alias("n"))
    return (
        pairs.groupBy(key)
        .agg(F.count("*").alias("n_values"), F.sum("n").alias("n_rows"))
        .filter("n_values > 1")
    )


def stage_dim(clean: DataFrame) -> DataFrame:
    """All seeded stages plus unseen ones as (99, Other)."""
    seeded = seeds.stage_seed(clean.sparkSession)
    order, group = seeds.UNSEEN_STAGE
    known = [name for name, _, _ in seeds.STAGES]
    unseen = (
        distinct_names(clean, "stage", "stage_name")
        .filter(~F.col("stage_name").isin(known))
        .select("stage_name", F.lit(order).alias("stage_order"), F.lit(group).alias("stage_group"))
    )
    return seeded.unionByName(unseen).select(*DIM_STAGE.names)


def channel_dim(clean: DataFrame) -> DataFrame:
    """Channel and its type, by exact name."""
    types = F.create_map(*[F.lit(x) for pair in seeds.CHANNEL_TYPES.items() for x in pair])
    return distinct_names(clean, "channel", "channel_name").select(
        "channel_name",
        F.coalesce(F.try_element_at(types, F.col("channel_name")), F.lit(seeds.UNSEEN_CHANNEL_TYPE)).alias(
            "channel_type"
        ),
    )


def campaign_dim(clean: DataFrame) -> DataFrame:
    """Campaign and its type, by the first text its name contains."""
    name = F.col("campaign_name")
    rules = F
    for part, kind in seeds.CAMPAIGN_TYPES:
        rules = rules.when(name.contains(part), kind)
    return distinct_names(clean, "campaign", "campaign_name").select(
        "campaign_name", rules.otherwise(seeds.OTHER_CAMPAIGN).alias("campaign_type")
    )


def revenue_dims(clean: DataFrame) -> dict[str, DataFrame]:
    return {
        "dim_date": date_dim(clean),
        "dim_region": distinct_names(clean, "region", "region_name"),
        "dim_branch": branch_dim(clean),
        "dim_product": product_dim(clean),
        "dim_channel": distinct_names(clean, "channel", "channel_name"),
        "dim_customer_segment": distinct_names(clean, "customer_segment", "segment_name"),
        "dim_promotion": distinct_names(clean, "promotion_campaign", "promotion_campaign"),
    }


def marketing_dims(clean: DataFrame) -> dict[str, DataFrame]:
    return {
        "dim_date": date_dim(clean),
        "dim_stage": stage_dim(clean),
        "dim_channel": channel_dim(clean),
        "dim_customer_segment": distinct_names(clean, "customer_segment", "segment_name"),
        "dim_campaign": campaign_dim(clean),
        "dim_department": distinct_names(clean, "department", "department_name"),
        "dim_machine": distinct_names(clean, "machine", "machine_name"),
        "dim_information": distinct_names(clean, "information", "information_name"),
    }
