"""Seconds per load and per report at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The wide raw tables are staged first and not timed: a load starts from the staging area. Loads run
into an empty warehouse and then again over the published rows. Reports read the published tables.
Every figure is the median of $BENCH_RUNS runs (3) after one run that is not counted.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from starmill import contracts, staging
from starmill.config import MartConfig
from starmill.plans import loads, marketing_marts, revenue_marts
from starmill.session import local_session
from starmill.sources.warehouse import Warehouse

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def timed(action: Callable[[], object]) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def median(action: Callable[[], object], runs: int = RUNS) -> float:
    action()
    return statistics.median(timed(action) for _ in range(runs))


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def bench_loads(spark, mart: loads.Mart, raw: DataFrame) -> tuple[dict[str, float], Warehouse]:
    configs = [MartConfig(tempfile.mkdtemp(prefix="bench-"), mart.name) for _ in range(RUNS + 1)]
    first = [timed(lambda c=c: loads.load(spark, c, mart, raw)) for c in configs][1:]
    again = [timed(lambda: loads.load(spark, configs[-1], mart, raw)) for _ in range(RUNS)]
    seconds = {f"{mart.name}_load": statistics.median(first), f"{mart.name}_rerun": statistics.median(again)}
    return seconds, Warehouse(spark, configs[-1])


def main() -> None:
    spark = local_session(CPUS)
    raw_sales, raw_marketing = staging.raw_sales(spark, SF_DIR), staging.raw_marketing(spark, SF_DIR)
    seconds, revenue = bench_loads(spark, loads.REVENUE, raw_sales)
    more, marketing = bench_loads(spark, loads.MARKETING, raw_marketing)
    seconds |= more

    sales, events = revenue.read(contracts.FACT_SALES), marketing.read(contracts.FACT_MARKETING)
    products, days = revenue.read(contracts.DIM_PRODUCT), revenue.read(contracts.DIM_DATE)
    stages, channels = marketing.read(contracts.DIM_STAGE), marketing.read(contracts.DIM_CHANNEL_TYPED)
    campaigns, event_days = marketing.read(contracts.DIM_CAMPAIGN), marketing.read(contracts.DIM_DATE)
    a, b = revenue_marts, marketing_marts
    reports = {
        "revenue_by_region": lambda: a.revenue_by_region(sales),
        "region_branch_rollup": lambda: a.region_branch_rollup(sales),
        "revenue_by_category_product": lambda: a.revenue_by_category_product(sales, products),
        "top_products_per_category": lambda: a.top_products_per_category(sales, products),
        "revenue_by_channel": lambda: a.revenue_by_channel(sales),
        "revenue_by_segment": lambda: a.revenue_by_segment(sales),
        "revenue_by_promotion": lambda: a.revenue_by_promotion(sales),
        "monthly_trend": lambda: a.monthly_trend(sales, days),
        "calendar_rollup": lambda: a.calendar_rollup(sales, days),
        "kpi_totals": lambda: a.kpi_totals(sales),
        "stage_funnel": lambda: b.stage_funnel(events, stages),
        "channel_effectiveness": lambda: b.channel_effectiveness(events, channels),
        "channel_type_effectiveness": lambda: b.channel_type_effectiveness(events, channels),
        "campaign_performance": lambda: b.campaign_performance(events, campaigns),
        "campaign_type_performance": lambda: b.campaign_type_performance(events, campaigns),
        "target_vs_actual": lambda: b.target_vs_actual(events, event_days),
        "campaign_roi": lambda: b.campaign_roi(events),
        "cost_breakdown": lambda: b.cost_breakdown(events),
        "operations_summary": lambda: b.operations_summary(events),
        "market_metrics": lambda: b.market_metrics(events, event_days),
    }
    seconds |= {name: median(lambda make=make: drain(make())) for name, make in reports.items()}
    rounded = {name: round(s, 3) for name, s in seconds.items()}
    print(
        json.dumps(
            {
                "metric": "total seconds, loads and reports",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": rounded,
                "sf": SF_DIR.rsplit("sf", 1)[-1].strip("/"),
                "raw_rows": {"sales": raw_sales.count(), "marketing": raw_marketing.count()},
            }
        )
    )


if __name__ == "__main__":
    main()
