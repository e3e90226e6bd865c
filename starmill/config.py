"""Names and locations of one mart."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

# Settings an existing deployment already has, and the table each one names.
REVENUE_SETTINGS = {
    "DIM_DATE_TABLE": "dim_date",
    "DIM_REGION_TABLE": "dim_region",
    "DIM_BRANCH_TABLE": "dim_branch",
    "DIM_PRODUCT_TABLE": "dim_product",
    "DIM_CHANNEL_TABLE": "dim_channel",
    "DIM_CUSTOMER_SEGMENT_TABLE": "dim_customer_segment",
    "DIM_PROMOTION_TABLE": "dim_promotion",
    "FACT_SALES_TABLE": "fact_sales",
}
MARKETING_SETTINGS = {
    "MARKETING_DIM_DATE_TABLE": "dim_date",
    "MARKETING_DIM_STAGE_TABLE": "dim_stage",
    "MARKETING_DIM_CHANNEL_TABLE": "dim_channel",
    "MARKETING_DIM_CUSTOMER_SEGMENT_TABLE": "dim_customer_segment",
    "MARKETING_DIM_CAMPAIGN_TABLE": "dim_campaign",
    "MARKETING_DIM_DEPARTMENT_TABLE": "dim_department",
    "MARKETING_DIM_MACHINE_TABLE": "dim_machine",
    "MARKETING_DIM_INFORMATION_TABLE": "dim_information",
    "FACT_MARKETING_TABLE": "fact_marketing_sales",
}


@dataclass(frozen=True)
class MartConfig:
    """Where one mart reads and writes.

    ``table_names`` maps a contract's table name to the name used on disk. ``rows_per_file`` is the
    size of a file of the fact, see ``Warehouse``; it may change from load to load. The raw table is
    ``raw_name`` in the catalog, or the files at ``raw_path``.

    ``max_deletes`` is how many deleted positions a reader of the fact has to know at most before files
    are written anew. Without it (None) only files with less than half their rows left are, so a reader
    knows a bit for each row, and what a load writes follows its batch however large the fact is.
    ``entries_per_part`` the files a part of the manifest lists, ``commit`` how a run
    becomes visible (``rename`` or ``create``, see ``Manifest.commit``), and ``attempts`` how often a load
    goes on after another one was published first.
    """

    root: str
    mart: str
    staging_schema: str = "staging"
    raw_table: str = "raw_sales"
    table_names: Mapping[str, str] = field(default_factory=dict)
    raw_path: str | None = None
    raw_format: str = "parquet"
    raw_ordinal: str | None = None
    rows_per_file: int = 1 << 20
    max_deletes: int | None = None
    entries_per_part: int = 1000
    commit: str = "rename"
    attempts: int = 10

    def table(self, name: str) -> str:
        return self.table_names.get(name, name)

    @property
    def raw_name(self) -> str:
        return f"{self.staging_schema}.{self.raw_table}"

    @classmethod
    def from_settings(cls, mart: str, settings: Mapping[str, str] | None = None, **overrides) -> MartConfig:
        """Build from environment-style settings; anything not set keeps its default."""
        settings = os.environ if settings is None else settings
        named = REVENUE_SETTINGS if mart == "revenue" else MARKETING_SETTINGS
        values = {
            "root": settings.get("DB_SCHEMA_DWH", "dw"),
            "staging_schema": settings.get("DB_SCHEMA_STAGING", "staging"),
            "raw_table": settings.get("RAW_TABLE", "raw_sales"),
            "raw_path": settings.get("RAW_PATH"),
            "raw_format": settings.get("RAW_FORMAT", "parquet"),
            "raw_ordinal": settings.get("RAW_ORDINAL"),
            "table_names": {table: settings[key] for key, table in named.items() if settings.get(key)},
        }
        return cls(mart=mart, **{**values, **overrides})
