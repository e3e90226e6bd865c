import datetime
from decimal import Decimal

import pytest

from starmill import contracts
from starmill.contracts import FACT_SALES
from starmill.operators import checks

DAY = datetime.date(2024, 1, 1)


def fact(spark, *rows):
    base = {c.name: None for c in FACT_SALES.columns}
    base |= {"order_id": 1, "full_date": DAY, "region_name": "N", "revenue": Decimal("1.00")}
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], FACT_SALES.schema)


def counts(df):
    return {(r.constraint, r.column): (r.n_violations, r.sample_key) for r in df.collect() if r.n_violations}


def test_not_null_and_length(spark):
    df = fact(spark, {}, {"order_id": 2, "revenue": None}, {"order_id": 3, "region_name": "x" * 51})
    assert counts(checks.check_rows(df, FACT_SALES)) == {
        ("not_null", "revenue"): (1, "2"), ("max_length", "region_name"): (1, "3"),
    }


def test_length_counts_characters_not_bytes(spark):
    df = fact(spark, {"region_name": "ệ" * 50})
    assert counts(checks.check_rows(df, FACT_SALES)) == {}


def test_primary_key(spark):
    df = fact(spark, {}, {}, {"order_id": 2})
    assert counts(checks.check_unique(df, "order_id")) == {("primary_key", "order_id"): (1, "1")}


def test_foreign_keys_let_null_pass(spark):
    df = fact(spark, {"branch_name": "B1"}, {"order_id": 2, "branch_name": "B2"}, {"order_id": 3, "branch_name": "B2"})
    dims = {
        "dim_branch": spark.createDataFrame([("B1", "N")], "branch_name STRING, region_name STRING"),
        "dim_date": spark.createDataFrame([(DAY,)], "full_date DATE"),
    }
    assert [tuple(r) for r in checks.orphans(df, FACT_SALES, dims).collect()] == [("branch_name", "B2", 2)]
    assert counts(checks.check_references(df, FACT_SALES, dims)) == {("foreign_key", "branch_name"): (2, "B2")}


def test_violations_raise_and_name_the_columns(spark):
    df = fact(spark, {"revenue": None}, {"order_id": 2, "region_name": None})
    with pytest.raises(checks.ContractViolation, match="not_null region_name: 1 rows, e.g. 2") as e:
        checks.require_none(checks.check_rows(df, FACT_SALES), checks.check_unique(df, "order_id"))
    assert {r.column for r in e.value.found} == {"region_name", "revenue"}


def test_computed_column_that_does_not_fit_is_found(spark):
    table = contracts.FACT_MARKETING
    base = {c.name: None for c in table.columns}
    base |= {"order_id": 1, "revenue": Decimal("1"), "target": Decimal("2"), "target_gap": Decimal("-1")}
    df = spark.createDataFrame([tuple(base.values())], table.schema)
    found = counts(checks.check_rows(df, table, checks.generated_tests()))
    assert found == {("precision", "target_achievement_rate"): (1, "1")}
