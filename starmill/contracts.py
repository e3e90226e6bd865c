"""Table contracts of both marts: types, keys, NOT NULL, text lengths, foreign keys.

Fixed values: names, types, lengths and keys are those an existing deployment has.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from starmill.functions.numbers import MONEY, RATIO


@dataclass(frozen=True)
class Column:
    name: str
    dtype: T.DataType
    required: bool = False
    max_length: int | None = None
    references: tuple[str, str] | None = None


@dataclass(frozen=True)
class Table:
    """One table. ``policy`` is how a batch meets existing rows: update, ignore or keep_first."""

    name: str
    key: str
    columns: tuple[Column, ...]
    policy: str = "update"
    insert_only: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.dtype) for c in self.columns])

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]


def text(name: str, length: int, required: bool = False, references: tuple[str, str] | None = None) -> Column:
    return Column(name, T.StringType(), required, length, references)


def integer(name: str, required: bool = False) -> Column:
    return Column(name, T.IntegerType(), required)


def money(name: str, required: bool = False) -> Column:
    return Column(name, MONEY, required)


def rate(name: str) -> Column:
    return Column(name, RATIO)


def names_only(table: str, key: str, length: int) -> Table:
    return Table(table, key, (text(key, length, required=True),), policy="ignore")


DIM_DATE = Table(
    "dim_date",
    "full_date",
    (
        Column("full_date", T.DateType(), required=True),
        integer("year", required=True),
        integer("month", required=True),
        text("month_name", 20),
        integer("quarter"),
        text("year_month", 7),
    ),
)
DIM_REGION = names_only("dim_region", "region_name", 50)
DIM_BRANCH = Table(
    "dim_branch", "branch_name", (text("branch_name", 100, required=True), text("region_name", 50))
)
DIM_PRODUCT = Table(
    "dim_product",
    "product_name",
    (text("product_name", 150, required=True), text("category", 100)),
    policy="keep_first",
)
DIM_CHANNEL = names_only("dim_channel", "channel_name", 100)
DIM_SEGMENT = names_only("dim_customer_segment", "segment_name", 100)
DIM_PROMOTION = names_only("dim_promotion", "promotion_campaign", 150)

FACT_SALES = Table(
    "fact_sales",
    "order_id",
    (
        Column("order_id", T.LongType(), required=True),
        Column("full_date", T.DateType(), required=True, references=("dim_date", "full_date")),
        text("region_name", 50, required=True, references=("dim_region", "region_name")),
        text("branch_name", 100, references=("dim_branch", "branch_name")),
        text("product_name", 150, references=("dim_product", "product_name")),
        text("channel_name", 100, references=("dim_channel", "channel_name")),
        text("segment_name", 100, references=("dim_customer_segment", "segment_name")),
        text("promotion_campaign", 150, references=("dim_promotion", "promotion_campaign")),
        money("quantity"),
        money("revenue", required=True),
        money("cost"),
        money("profit"),
        money("market_size"),
        money("budget"),
        money("logistics_cost"),
        money("marketing_cost"),
    ),
)

DIM_STAGE = Table(
    "dim_stage",
    "stage_name",
    (text("stage_name", 50, required=True), integer("stage_order", required=True), text("stage_group", 50)),
)
DIM_CHANNEL_TYPED = Table(
    "dim_channel", "channel_name", (text("channel_name", 100, required=True), text("channel_type", 50))
)
DIM_CAMPAIGN = Table(
    "dim_campaign", "campaign_name", (text("campaign_name", 150, required=True), text("campaign_type", 100))
)
DIM_DEPARTMENT = names_only("dim_department", "department_name", 100)
DIM_MACHINE = names_only("dim_machine", "machine_name", 50)
DIM_INFORMATION = names_only("dim_information", "information_name", 150)

FACT_MARKETING = Table(
    "fact_marketing_sales",
    "order_id",
    (
        Column("order_id", T.LongType(), required=True),
        Column("full_date", T.DateType(), references=("dim_date", "full_date")),
        text("stage_name", 50, references=("dim_stage", "stage_name")),
        text("channel_name", 100, references=("dim_channel", "channel_name")),
        text("information_name", 150, references=("dim_information", "information_name")),
        text("machine_name", 50, references=("dim_machine", "machine_name")),
        text("department_name", 100, references=("dim_department", "department_name")),
        text("segment_name", 100, references=("dim_customer_segment", "segment_name")),
        text("campaign_name", 150, references=("dim_campaign", "campaign_name")),
        money("quantity"),
        money("revenue", required=True),
        money("cost"),
        money("profit"),
        rate("profit_margin"),
        money("inventory_level"),
        money("calls"),
        money("waiting_time"),
        rate("conversion_proxy"),
        money("budget"),
        money("target"),
        money("marketing_cost"),
        rate("roi_marketing"),
        money("raw_material_cost"),
        money("labor_cost"),
        money("logistics_cost"),
        rate("unit_cost"),
        rate("revenue_per_unit"),
        rate("cost_per_machine_unit"),
        money("market_size"),
        rate("market_share"),
        rate("region_profit_share"),
        money("target_gap"),
        rate("target_achievement_rate"),
        rate("roi_marketing_calc"),
        Column("created_at", T.TimestampNTZType()),
    ),
    insert_only=("created_at",),
)

REVENUE_DIMS = (DIM_DATE, DIM_REGION, DIM_BRANCH, DIM_PRODUCT, DIM_CHANNEL, DIM_SEGMENT, DIM_PROMOTION)
MARKETING_DIMS = (
    DIM_DATE,
    DIM_STAGE,
    DIM_CHANNEL_TYPED,
    DIM_SEGMENT,
    DIM_CAMPAIGN,
    DIM_DEPARTMENT,
    DIM_MACHINE,
    DIM_INFORMATION,
)
