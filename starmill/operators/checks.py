"""Table constraints as queries (K1-K5).

Every check returns (constraint, column, n_violations, sample_key), one row per constraint and
column. Row-level checks share one pass that shuffles a single row per task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from starmill.contracts import Table
from starmill.operators.cleaning import OVERFLOW

COLUMNS = ("constraint", "column", "n_violations", "sample_key")


class ContractViolation(Exception):
    """A batch breaks its table's contract; nothing of it was published."""

    def __init__(self, found: list):
        self.found = found
        lines = [f"{r.constraint} {r.column}: {r.n_violations} rows, e.g. {r.sample_key}" for r in found]
        super().__init__("; ".join(lines))


# A test: constraint, column, and the SQL condition of a violating row.
Test = tuple[str, str, str]


def tally(df: DataFrame, key: str, tests: list[Test], by: Sequence[str] = ()) -> DataFrame:
    """Count the rows meeting each test in one aggregate, then turn each of its rows (a single one, or one
    for each group) into one row per test. The sample is the smallest key."""
    totals = [F.expr(f"count_if({cond}) AS n{i}") for i, (_, _, cond) in enumerate(tests)]
    samples = [F.expr(f"min(CASE WHEN {cond} THEN {key} END) AS k{i}") for i, (_, _, cond) in enumerate(tests)]
    rows = [
        f"struct('{constraint}' AS constraint, '{column}' AS column, n{i} AS n_violations, k{i} AS sample_key)"
        for i, (constraint, column, _) in enumerate(tests)
    ]
    return df.groupBy(*by).agg(*totals, *samples).select(*by, F.expr(f"inline(array({', '.join(rows)}))"))


def not_null_tests(table: Table) -> list[Test]:
    return [("not_null", c.name, f"{c.name} IS NULL") for c in table.columns if c.required]


def length_tests(table: Table) -> list[Test]:
    return [
        ("max_length", c.name, f"char_length({c.name}) > {c.max_length}") for c in table.columns if c.max_length
    ]


def declared_tests(table: Table) -> list[Test]:
    """K2 and K4."""
    return not_null_tests(table) + length_tests(table)


def overflow_tests(columns: list[str]) -> list[Test]:
    """On parsed or clean rows, whose ``_overflow`` lists the columns that did not fit."""
    return [("precision", c, f"find_in_set('{c}', {OVERFLOW}) > 0") for c in columns]


def generated_tests() -> list[Test]:
    """Computed marketing columns that came out NULL although their inputs give a value."""
    lost = "{} IS NULL AND {} IS NOT NULL AND {} <> 0"
    return [
        ("precision", "target_gap", "target_gap IS NULL"),
        (
            "precision",
            "target_achievement_rate",
            lost.format("target_achievement_rate", "revenue", "target"),
        ),
        ("precision", "roi_marketing_calc", lost.format("roi_marketing_calc", "profit", "budget")),
    ]


def check_rows(df: DataFrame, table: Table, tests: list[Test] | None = None) -> DataFrame:
    """K2 and K4 of a table, or the given tests, in one pass."""
    found = tally(df, table.key, declared_tests(table) if tests is None else tests)
    return found.withColumn("sample_key", F.col("sample_key").cast("string"))


def check_unique(df: DataFrame, key: str) -> DataFrame:
    """K1. Counts combine before the shuffle, so a hot key travels as one row per task."""
    return count_repeated(repeated_keys(df, key), key)


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").select(key)


def count_repeated(repeated: DataFrame, key: str) -> DataFrame:
    return repeated.agg(
        F.lit("primary_key").alias("constraint"),
        F.lit(key).alias("column"),
        F.count("*").alias("n_violations"),
        F.min(key).cast("string").alias("sample_key"),
    )


def orphans(fact: DataFrame, table: Table, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Foreign-key values without a dimension row, with the fact rows that carry them (K3).

    All keys are reduced to distinct (column, value) pairs in one pass before the anti join, so the
    join is between two key sets and neither size nor skew of the fact matters to it.
    """
    return unknown_values(referring_values(fact, table, dims), table, dims)


def references(table: Table, dims: Iterable[str]) -> dict[str, tuple[str, str]]:
    """Foreign keys of a table into the given ones."""
    return {c.name: c.references for c in table.columns if c.references and c.references[0] in dims}


def referring_values(fact: DataFrame, table: Table, dims: Iterable[str], by: Sequence[str] = ()) -> DataFrame:
    """Distinct (column, value) of the foreign keys and the rows that carry them, for each group."""
    refs = list(references(table, dims))
    used = fact.select(*by, *[F.col(c).cast("string") for c in refs]).unpivot(list(by), refs, "column", "value")
    return used.filter("value IS NOT NULL").groupBy(*by, "column", "value").agg(F.count("*").alias("n_rows"))


def unknown_values(used: DataFrame, table: Table, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Of (column, value, ...) those whose value no dimension row has."""
    known = [
        dims[dim].select(F.lit(column).alias("column"), F.col(key).cast("string").alias("value"))
        for column, (dim, key) in references(table, dims).items()
    ]
    return used.join(reduce(DataFrame.unionByName, known), ["column", "value"], "left_anti")


def check_references(fact: DataFrame, table: Table, dims: Mapping[str, DataFrame]) -> DataFrame:
    """K3, one row per foreign key, also for those without an orphan."""
    return count_references(orphans(fact, table, dims), list(references(table, dims)))


def count_references(orphaned: DataFrame, refs: Sequence[str]) -> DataFrame:
    found = orphaned.agg(
        *[F.expr(f"coalesce(sum(n_rows) FILTER (WHERE column = '{c}'), 0) AS n{i}") for i, c in enumerate(refs)],
        *[F.expr(f"min(value) FILTER (WHERE column = '{c}') AS k{i}") for i, c in enumerate(refs)],
    )
    rows = [f"struct('foreign_key' AS constraint, '{c}' AS column, n{i} AS n_violations, k{i} AS sample_key)" for i, c in enumerate(refs)]
    return found.select(F.expr(f"inline(array({', '.join(rows)}))"))


def require_none(*found: DataFrame) -> None:
    """Raise if any check counted a violation. One job; collects one row per violated constraint."""
    rows = reduce(DataFrame.unionByName, found).filter("n_violations > 0").collect()
    if rows:
        raise ContractViolation(rows)


def audit(fact: DataFrame, table: Table, dims: Mapping[str, DataFrame], dim_tables: tuple[Table, ...]) -> DataFrame:
    """K1-K4 over a published mart, a row for each constraint. K5 holds there by type: a number too
    large for its column never gets past ``overflow_tests`` of a load."""
    found = [check_unique(fact, table.key), check_rows(fact, table), check_references(fact, table, dims)]
    for dim in dim_tables:
        found += [check_unique(dims[dim.name], dim.key), check_rows(dims[dim.name], dim)]
    return reduce(DataFrame.unionByName, found)
