import datetime

from pyspark.sql import functions as F

from starmill.operators import dimensions
from starmill.sources.headers import ORDINAL


def frame(spark, rows, columns):
    schema = f"{ORDINAL} LONG, " + ", ".join(f"{c} STRING" for c in columns)
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)


def test_branch_takes_its_last_region_and_reports_the_conflict(spark, rows):
    clean = frame(spark, [("B1", "North"), ("B2", "East"), ("B1", "South"), (None, "West")], ["branch", "region"])
    assert rows(dimensions.branch_dim(clean)) == [("B1", "South"), ("B2", "East")]
    assert rows(dimensions.key_conflicts(clean, "branch", "region")) == [("B1", 2, 2)]


def test_product_takes_its_first_category_even_if_missing(spark, rows):
    clean = frame(spark, [("P1", None), ("P1", "Milk"), ("P2", "Milk"), ("P2", "Juice")], ["product", "category"])
    assert rows(dimensions.product_dim(clean)) == [("P1", None), ("P2", "Milk")]


def test_dates(spark, rows):
    clean = spark.sql("SELECT explode(array(date'2024-02-29', date'2024-12-01', date'2024-02-29')) AS date")
    assert rows(dimensions.date_dim(clean)) == [
        (datetime.date(2024, 2, 29), 2024, 2, "February", 1, "2024-02"),
        (datetime.date(2024, 12, 1), 2024, 12, "December", 4, "2024-12"),
    ]


def test_month_names_are_english_in_any_locale(spark):
    names = [r[0] for r in spark.range(1, 13).select(
        F.date_format(F.make_date(F.lit(2024), F.col("id").cast("int"), F.lit(1)), "MMMM")).collect()]
    assert names == ["January", "February", "March", "April", "May", "June", "July", "August", "September",
                     "October", "November", "December"]


def test_stages_hold_all_seeds_and_unseen_ones(spark, rows):
    clean = frame(spark, [("Demo",), ("Click",), ("Demo",), (None,)], ["stage"])
    assert rows(dimensions.stage_dim(clean)) == sorted([
        ("Impression", 1, "Awareness"), ("Visit website", 2, "Consideration"), ("Click", 3, "Consideration"),
        ("Add to cart", 4, "Intent"), ("Purchase", 5, "Conversion"), ("Demo", 99, "Other")])


def test_channel_types_are_looked_up_exactly(spark, rows):
    clean = frame(spark, [("Facebook",), ("facebook",), ("TV",), ("Other",), (None,)], ["channel"])
    assert rows(dimensions.channel_dim(clean)) == [
        ("Facebook", "Social"), ("Other", "Other"), ("TV", "Broadcast"), ("facebook", "Other")]


def test_campaign_rules_in_order(spark):
    given = {
        "Tet 2024": "Seasonal", "Mid-Autumn Gift": "Seasonal", "Year-End Spring": "Seasonal",
        "Year-End Sale": "Year end", "Back-to-School": "Back to school", "spring sale": "Other",
    }
    clean = frame(spark, [(c,) for c in [*given, None]], ["campaign"])
    assert {r[0]: r[1] for r in dimensions.campaign_dim(clean).collect()} == given


def test_attribute_dim_hashes_on_a_plain_ordinal(spark):
    clean = frame(spark, [("P1", "Milk")], ["product", "category"])
    pairs = dimensions.product_dim(clean)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[product" in pairs
