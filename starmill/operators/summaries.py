"""Report state that batches keep up to date: sums and counts by group.

All measures of the reports are sums and counts, which can be added and taken away. A load adds what
its batch brings and takes away what the rows it replaces had brought, so the state follows the batch
and a report reads groups instead of orders. A group without an order left goes.

Reports take either the rows of a fact or a ``Summary`` of them, by way of ``measured``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starmill.contracts import FACT_MARKETING, FACT_SALES, Table

GROUPING, ORDERS = "grouping", "orders"


@dataclass(frozen=True)
class Spec:
    """Groupings that the reports of a fact need, and the measures they add up."""

    groupings: tuple[tuple[str, ...], ...]
    measures: tuple[str, ...]

    @property
    def keys(self) -> list[str]:
        return list(dict.fromkeys(key for grouping in self.groupings for key in grouping))

    @property
    def columns(self) -> list[str]:
        return [*self.keys, *self.measures]

    def number(self, grouping: Sequence[str]) -> int:
        """Spark's grouping id: a bit for each key that is left out, the first key highest."""
        return reduce(lambda bits, key: 2 * bits + (key not in grouping), self.keys, 0)


SPECS = {
    FACT_SALES.name: Spec(
        (
            ("region_name", "branch_name"),
            ("product_name",),
            ("channel_name",),
            ("segment_name",),
            ("promotion_campaign",),
            ("full_date",),
        ),
        ("revenue", "profit", "cost", "market_size", "budget", "logistics_cost", "marketing_cost"),
    ),
    FACT_MARKETING.name: Spec(
        (
            ("stage_name",),
            ("channel_name", "full_date"),
            ("campaign_name",),
            ("department_name", "machine_name", "information_name"),
            ("full_date",),
        ),
        (
            *("revenue", "profit", "marketing_cost", "budget", "target", "target_gap", "conversion_proxy"),
            *("raw_material_cost", "labor_cost", "logistics_cost", "unit_cost", "cost_per_machine_unit"),
            *("inventory_level", "calls", "waiting_time", "market_size", "market_share", "roi_marketing_calc"),
        ),
    ),
}


def name_of(table: Table) -> str:
    return f"{table.name}_summary"


def summarize(rows: DataFrame, spec: Spec) -> DataFrame:
    """State of the given rows: one row per grouping and group.

    A sum of 18 digits has 28, which Spark keeps as bytes and not as a number, once for each row, grouping
    and measure. So measures are cut into parts whose sums are 64-bit numbers, and put together by group.
    """
    whole, rest = {m: F.col(m).cast("bigint") for m in spec.measures}, {}
    for m in spec.measures:
        scale = _scale(rows, m)
        rest[m] = (F.col(m) - whole[m].cast(rows.schema[m].dataType)).cast(f"decimal({scale + 1},{scale})")
    parts = [
        part.alias(f"_{name}_{m}")
        for m in spec.measures
        for name, part in (("high", F.expr(f"CAST({m} AS BIGINT) DIV {_CUT}")), ("low", whole[m] % _CUT), ("rest", rest[m]))
    ]
    sums = [_together(m, _scale(rows, m)).alias(f"sum_{m}") for m in spec.measures]
    counts = [F.count(f"_high_{m}").alias(f"count_{m}") for m in spec.measures]
    sets = [[F.col(key) for key in grouping] for grouping in spec.groupings]
    grouped = rows.select(*spec.keys, *parts).groupingSets(sets, *[F.col(key) for key in spec.keys])
    return grouped.agg(F.grouping_id().cast("int").alias(GROUPING), F.count("*").alias(ORDERS), *sums, *counts)


_CUT = 10**8  # a whole number of 16 digits is cut here: sums of either part hold for 10^10 rows


def _together(measure: str, scale: int) -> Column:
    high, low, rest = [F.sum(f"_{name}_{measure}") for name in ("high", "low", "rest")]
    whole = high.cast("decimal(28,0)") * F.lit(_CUT).cast("decimal(9,0)") + low.cast("decimal(28,0)")
    return (whole.cast(f"decimal(38,{scale})") + rest.cast(f"decimal(38,{scale})")).cast(f"decimal(38,{scale})")


def _scale(rows: DataFrame, measure: str) -> int:
    return rows.schema[measure].dataType.scale


def combine(spec: Spec, added: Sequence[DataFrame], taken: Sequence[DataFrame] = ()) -> DataFrame:
    """States put together, those of replaced rows taken away."""
    totals = [ORDERS, *[f"{kind}_{m}" for m in spec.measures for kind in ("sum", "count")]]
    undone = [
        state.select(GROUPING, *spec.keys, *[(-F.col(c)).cast(state.schema[c].dataType).alias(c) for c in totals]) for state in taken
    ]
    whole = reduce(DataFrame.unionByName, [*added, *undone])
    types = {c: whole.schema[c].dataType for c in totals}
    summed = whole.groupBy(GROUPING, *spec.keys).agg(*[F.sum(c).cast(types[c]).alias(c) for c in totals])
    return summed.filter(F.col(ORDERS) > 0)


@dataclass(frozen=True)
class Summary:
    """The state of a fact in place of its rows."""

    spec: Spec
    state: DataFrame

    def rows(self, *keys: str) -> DataFrame:
        """Groups of the narrowest grouping that has the given keys."""
        grouping = min((g for g in self.spec.groupings if set(keys) <= set(g)), key=len)
        return self.state.filter(F.col(GROUPING) == self.spec.number(grouping))

    def orders(self) -> Column:
        return F.sum(ORDERS)

    def sum(self, measure: str) -> Column:
        return F.sum(f"sum_{measure}")

    def count(self, measure: str) -> Column:
        return F.sum(f"count_{measure}")


@dataclass(frozen=True)
class Rows:
    """The rows of a fact, with the same measures."""

    fact: DataFrame

    def rows(self, *keys: str) -> DataFrame:
        return self.fact

    def orders(self) -> Column:
        return F.count("*")

    def sum(self, measure: str) -> Column:
        return F.sum(measure)

    def count(self, measure: str) -> Column:
        return F.count(measure)


def measured(fact: DataFrame | Summary) -> Rows | Summary:
    return fact if isinstance(fact, Summary) else Rows(fact)
