"""Fixed reference rows of the marketing mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill.contracts import DIM_STAGE

# Funnel stages with their order and group; other stages are (99, Other).
STAGES = [
    ("Impression", 1, "Awareness"),
    ("Visit website", 2, "Consideration"),
    ("Click", 3, "Consideration"),
    ("Add to cart", 4, "Intent"),
    ("Purchase", 5, "Conversion"),
]
UNSEEN_STAGE = (99, "Other")

# Type of each channel; other channels are Other.
CHANNEL_TYPES = {
    "Facebook": "Social",
    "Ecommerce": "Digital commerce",
    "TV": "Broadcast",
    "Retail promotion": "Trade promotion",
    "Traditional trade": "Traditional trade",
    "Other": "Other",
}
UNSEEN_CHANNEL_TYPE = "Other"

# Texts in a campaign name and the type they stand for, tried in this order.
CAMPAIGN_TYPES = [
    ("Tet", "Seasonal"),
    ("Spring", "Seasonal"),
    ("Summer", "Seasonal"),
    ("Mid-Autumn", "Seasonal"),
    ("Year-End", "Year end"),
    ("Back-to-School", "Back to school"),
]
OTHER_CAMPAIGN = "Other"


def stage_seed(spark: SparkSession) -> DataFrame:
    rows = [F.struct(*[F.lit(v).alias(c) for v, c in zip(row, DIM_STAGE.names, strict=True)]) for row in STAGES]
    return spark.range(1).select(F.inline(F.array(*rows)))
