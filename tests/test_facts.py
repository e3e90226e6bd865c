from decimal import Decimal

from starmill import contracts
from starmill.operators import cleaning, facts
from starmill.operators.cleaning import MARKETING
from starmill.sources.headers import ORDINAL

FIELDS = ["order_id", "date", "stage", "channel", "revenue", "target", "budget", "profit"]


def marketing(spark, rows):
    schema = f"{ORDINAL} LONG, " + ", ".join(f"{f} STRING" for f in FIELDS)
    data = [(i, str(i), "2024-01-01", "Click", "TV", *r) for i, r in enumerate(rows)]
    clean = cleaning.clean(MARKETING.canonicalize(spark.createDataFrame(data, schema)), MARKETING)
    return {r.order_id: r for r in facts.marketing_fact(clean).collect()}


def test_computed_columns(spark):
    out = marketing(spark, [
        ("100", "80", "50", "10"), ("100", "0", "0", "10"), ("100", None, None, "10"), ("100", "80", "50", None),
    ])
    gaps = [out[i].target_gap for i in range(4)]
    rates = [out[i].target_achievement_rate for i in range(4)]
    rois = [out[i].roi_marketing_calc for i in range(4)]
    assert gaps == [Decimal("20.00"), Decimal("100.00"), Decimal("100.00"), Decimal("20.00")]
    assert rates == [Decimal("1.250000"), None, None, Decimal("1.250000")]
    assert rois == [Decimal("0.200000"), None, None, None]


def test_computed_from_rounded_values(spark):
    out = marketing(spark, [("1.005", "1", None, None)])
    assert out[0].target_gap == Decimal("0.01")
    assert out[0].target_achievement_rate == Decimal("1.010000")


def test_fact_contracts_hold_the_declared_columns():
    assert len(contracts.FACT_SALES.columns) == 16
    assert len(contracts.FACT_MARKETING.columns) == 31 + 3 + 1
    assert len(contracts.REVENUE_DIMS) == 7
    assert len(contracts.MARKETING_DIMS) == 8
