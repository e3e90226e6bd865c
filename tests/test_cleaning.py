import datetime
import re
from decimal import Decimal

from pyspark.sql import functions as F

from starmill import registry, staging
from starmill.operators import cleaning
from starmill.operators.cleaning import MARKETING, OVERFLOW, REVENUE
from starmill.sources import shared, testdata
from starmill.sources.headers import ORDINAL

FIELDS = ["order_id", "date", "region", "revenue", "branch", "cost"]


def raw(spark, rows, fields=FIELDS):
    schema = f"{ORDINAL} LONG, " + ", ".join(f"{f} STRING" for f in fields)
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)


def test_typed_row(spark):
    df = raw(spark, [("12.7", "05/06/2024", "\xa0North ", " 1.005", "None", "12d")])
    row = cleaning.clean(REVENUE.canonicalize(df), REVENUE).first()
    assert (row.order_id, row.date, row.region, row.branch) == (12, datetime.date(2024, 6, 5), "North", None)
    assert (row.revenue, row.cost, row.year, row.month) == (Decimal("1.01"), None, 2024, 6)


def test_calendar_comes_from_the_date_not_from_the_raw_columns(spark):
    df = raw(spark, [("1", "2024-03-04", "N", "1", "1999", "7")], ["order_id", "date", "region", "revenue", "year", "month"])
    row = cleaning.clean(REVENUE.canonicalize(df), REVENUE).first()
    assert (row.year, row.month) == (2024, 3)


def test_incomplete_rows_go_and_say_why(spark):
    df = raw(spark, [
        ("1", "2024-01-01", "N", "1", None, None),
        ("x", "never", "N", "1", None, None),
        ("3", "2024-01-01", " nan", "1,0", None, None),
        ("4", "2024-01-01", "N", "inf", None, None),
    ])
    parsed = cleaning.parse(REVENUE.canonicalize(df), REVENUE)
    reasons = {r[ORDINAL]: r.reasons for r in cleaning.rejects(parsed).collect()}
    assert reasons == {1: ["order_id", "date"], 2: ["region", "revenue"], 3: ["revenue"]}
    counted = {r.reason: r.n_rows for r in cleaning.rejects_by_reason(parsed, REVENUE).collect()}
    assert counted == {"order_id": 1, "date": 1, "region": 1, "revenue": 2}


def test_last_complete_row_of_an_order_survives(spark):
    df = raw(spark, [
        ("7", "2024-01-01", "first", "1", None, None),
        ("7", "2024-01-02", "second", "2", None, None),
        ("7", "broken", "third", "3", None, None),
        ("8", "2024-01-01", "only", "4", None, None),
    ])
    out = cleaning.clean(REVENUE.canonicalize(df), REVENUE)
    assert {r.order_id: r.region for r in out.collect()} == {7: "second", 8: "only"}


def test_fraction_is_cut_before_deduplication(spark):
    df = raw(spark, [("12", "2024-01-01", "a", "1", None, None), ("12.7", "2024-01-01", "b", "1", None, None)])
    assert [r.region for r in cleaning.clean(REVENUE.canonicalize(df), REVENUE).collect()] == ["b"]


def test_too_large_number_is_kept_and_flagged(spark):
    df = raw(spark, [("1", "2024-01-01", "N", "1e17", None, "1e18"), ("2", "2024-01-01", "N", "5", None, "x")])
    out = {r.order_id: r for r in cleaning.clean(REVENUE.canonicalize(df), REVENUE).collect()}
    assert (out[1].revenue, out[1][OVERFLOW]) == (None, "revenue,cost")
    assert (out[2].cost, out[2][OVERFLOW]) == (None, None)


def test_counts_add_up(spark):
    df = raw(spark, [(str(i % 5), "2024-01-01" if i % 7 else "bad", "N", "1", None, None) for i in range(50)])
    parsed = cleaning.parse(REVENUE.canonicalize(df), REVENUE)
    row = cleaning.row_counts(parsed, cleaning.last_complete(parsed), REVENUE).first()
    assert (row.raw_rows, row.rejected_rows, row.clean_rows) == (50, 8, 5)
    assert row.superseded_rows == 50 - 8 - 5


def test_result_does_not_depend_on_partitioning(spark, rows):
    df = raw(spark, [(str(i % 13), "2024-01-01" if i % 3 else "bad", f"r{i}", "1", None, None) for i in range(200)])
    outs = [
        rows(cleaning.clean(REVENUE.canonicalize(df.repartition(n, F.rand(n))), REVENUE)) for n in (1, 3, 7)
    ]
    assert outs[0] == outs[1] == outs[2]
    last = {i % 13: f"r{i}" for i in range(200) if i % 3}
    assert {r[0]: r[4] for r in outs[0]} == last


def test_marketing_needs_stage_and_channel_but_not_region(spark):
    fields = ["order_id", "date", "stage", "channel", "revenue"]
    df = raw(spark, [
        ("1", "2024-01-01", "Click", "TV", "1"),
        ("2", "2024-01-01", "", "TV", "1"),
        ("3", "2024-13-05", "Click", "TV", "1"),
    ], fields)
    out = cleaning.clean(MARKETING.canonicalize(df), MARKETING)
    assert [r.order_id for r in out.collect()] == [1]
    assert len(out.columns) == 37 + 2


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_order_is_cut_to_one_row_per_task_before_the_shuffle(spark):
    """A third of all rows on one order, and another third with unreadable ids."""
    n = 3000
    df = spark.range(n).select(
        F.col("id").alias(ORDINAL),
        F.when(F.col("id") % 3 == 0, "1").when(F.col("id") % 3 == 1, "?").otherwise(F.col("id").cast("string")).alias("order_id"),
        F.lit("2024-01-01").alias("date"), F.lit("N").alias("region"), F.lit("1").alias("revenue"),
    )
    out = cleaning.clean(REVENUE.canonicalize(df), REVENUE)
    plan = plan_of(out)
    partial = plan.index("WindowGroupLimit", plan.index("Exchange hashpartitioning(order_id"))
    assert "Partial" in plan[partial : partial + 400]
    assert out.count() == 1 + n // 3
    assert out.filter("order_id = 1").first()[ORDINAL] == n - 3


def test_cleaning_parses_each_value_once_and_runs_no_python(spark):
    df = raw(spark, [("1", "2024-01-01", "N", "1", None, None)])
    plan = plan_of(cleaning.clean(REVENUE.canonicalize(df), REVENUE))
    assert plan.count("try_to_date") <= 1
    assert "Python" not in plan


def test_date_outside_the_span_has_a_reason_of_its_own(spark):
    df = raw(spark, [
        ("1", "9999-12-31", "N", "1", None, None),
        ("2", "1600-01-01", "N", "1", None, None),
        ("3", "never", "N", "1", None, None),
        ("4", "2262-04-11", "N", "1", None, None),
    ])
    parsed = cleaning.parse(REVENUE.canonicalize(df), REVENUE)
    assert {r[ORDINAL]: r.reasons for r in cleaning.rejects(parsed).collect()} == {0: ["date_span"], 1: ["date_span"], 2: ["date"]}
    counted = {r.reason: r.n_rows for r in cleaning.rejects_by_reason(parsed, REVENUE).collect()}
    assert counted == {"date": 1, "date_span": 2}


def test_rows_at_one_position_do_not_depend_on_task_order(spark):
    rows = [("7", "2024-01-01", r, "1", None, None) for r in ("a", "b", "c", "d")]
    df = raw(spark, rows).withColumn(ORDINAL, F.lit(1).cast("long"))
    kept = {cleaning.clean(REVENUE.canonicalize(df.repartition(n, F.rand(n))), REVENUE).first().region for n in (1, 2, 3, 4)}
    assert len(kept) == 1


def test_split_sides_come_from_one_pass_and_lose_nothing(spark, tmp_path):
    df = raw(spark, [(str(i % 5), "2024-01-01" if i % 7 else "bad", "N", "1", None, None) for i in range(50)])
    parsed = cleaning.parse(REVENUE.canonicalize(df), REVENUE)
    complete, incomplete = cleaning.split(parsed, str(tmp_path / "parsed"))
    assert (complete.count(), incomplete.count()) == (42, 8)
    plan = plan_of(cleaning.last_of(complete))
    assert "WindowGroupLimit" in plan and plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert cleaning.last_of(complete).count() == 5
    none, _ = cleaning.split(parsed.filter("false"), str(tmp_path / "none"))
    assert none.count() == 0 and none.schema == complete.schema


def test_whole_rows_are_neither_sorted_nor_sent_to_find_the_last_of_an_order(spark, tmp_path):
    """Several rows at one place, some of them alike, in several files and on both sides."""
    rows = [(str(i % 40), "2024-01-01" if i % 7 else "bad", "abc"[i % 3], "1", None, None) for i in range(400)]
    df = raw(spark, rows).withColumn(ORDINAL, (F.col(ORDINAL) % 90).cast("long"))
    parsed = cleaning.parse(REVENUE.canonicalize(df.repartition(5, F.col(ORDINAL))), REVENUE)
    complete, _ = cleaning.split(parsed, str(tmp_path / "parsed"))
    out = cleaning.last_of(complete)
    wide = cleaning._first_of(complete, "order_id", cleaning._latest_first(complete, ORDINAL)).drop(cleaning.LACKING)
    assert out.columns == wide.columns and sorted(map(str, out.collect())) == sorted(map(str, wide.collect()))
    plan = plan_of(out)
    assert re.search(r"Project \[order_id#\d+L?, _at#\d+L?, _tie#\d+L?, _rank#\d+, _row#\d+L?\]", plan)
    assert not list((tmp_path / "parsed").glob("_complete=*"))


def test_rows_of_a_source_with_a_file_for_every_core_stay_where_they_are(spark, tmp_path):
    rows = raw(spark, [(str(i), "2024-01-01", "N", "1", None, None) for i in range(100)])
    cores = spark.sparkContext.defaultParallelism
    for files, moved in ((cores, False), (1, True)):
        rows.repartition(files).write.parquet(str(tmp_path / str(files)))
        dealt = cleaning.spread(REVENUE.canonicalize(spark.read.parquet(str(tmp_path / str(files)))))
        assert ("Exchange" in plan_of(dealt)) == moved and dealt.count() == 100


def test_lines_of_the_raw_sales_move_twice(spark, sf_dir):
    """Orders meet customers before lines, and nations come last, so wide rows meet no exchange but that by part."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(testdata.raw_sales(spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    joins = re.findall(r"(?:SortMergeJoin|ShuffledHashJoin) \[(\w+?)#", plan)
    assert joins == ["n_regionkey", "c_nationkey", "l_partkey", "l_orderkey", "o_custkey"]


def test_clean_rows_are_not_written_a_second_time(spark, tmp_path):
    """Only the bitmaps of the rows that win are written; places across several words and bitmaps."""
    n = 70_000
    df = spark.range(n, numPartitions=1).select(
        F.col("id").alias(ORDINAL), (F.col("id") % 60_000).cast("string").alias("order_id"),
        F.lit("2024-01-01").alias("date"), F.col("id").cast("string").alias("region"), F.lit("1").alias("revenue"),
    )
    complete, _ = cleaning.split(cleaning.parse(REVENUE.canonicalize(df), REVENUE), str(tmp_path / "parsed"))
    out = cleaning.staged_last_of(complete, str(tmp_path / "last"))
    written = spark.read.parquet(str(tmp_path / "last"))
    assert set(written.columns) == {"_file", "_block", "_bits"} and written.count() == 3
    assert out.columns == cleaning.last_of(complete).columns
    assert out.count() == 60_000 and out.filter(F.col("region") != F.col(ORDINAL).cast("string")).isEmpty()
    assert out.agg(F.min(ORDINAL)).first()[0] == 10_000


def test_days_of_the_raw_sales_are_written_as_a_formatter_does(spark):
    days = spark.sql("SELECT explode(array('0999-03-04', '1998-12-31', '2024-02-09', null)) AS day UNION ALL SELECT '+10000-01-05'")
    days = days.select(F.col("day").cast("date").alias("day"))
    shapes = ("yyyy-MM-dd", "dd/MM/yyyy", "d/M/yyyy", "MM/dd/yyyy")
    pairs = [testdata._day_text(F.col("day"), s).eqNullSafe(F.date_format("day", s)) for s in shapes]
    plan = plan_of(days.select(testdata._day_text(F.col("day"), "yyyy-MM-dd")))
    assert days.filter(~(pairs[0] & pairs[1] & pairs[2] & pairs[3])).isEmpty() and "CASE WHEN" in plan


def test_deliveries_are_loaded_from_the_staged_files(spark, sf_dir):
    """The raw table is staged with a folder for each delivery; no query writes them again."""
    early, late = staging.sales_files(spark, sf_dir)
    whole = staging.all_sales_files(spark, sf_dir)
    assert early.startswith(whole) and late.startswith(whole) and early != late
    expected = testdata.sales_batches(testdata.raw_sales(spark, sf_dir))
    for path, frame, rows in zip((early, late), staging.sales_deliveries(spark, sf_dir), expected, strict=True):
        found = spark.read.parquet(path)
        assert found.columns == frame.columns == rows.columns and found.count() > 0
        assert found.exceptAll(rows).isEmpty() and rows.exceptAll(frame).isEmpty() and frame.exceptAll(found).isEmpty()
    staged = f"{shared.shared_folder(spark)}/starmill"
    before = [n for n in shared.children(spark, staged) if n.startswith("delivery-")]
    assert registry.revenue_load(spark, sf_dir).count() > 0
    assert [n for n in shared.children(spark, staged) if n.startswith("delivery-")] == before


def test_folders_are_written_side_by_side_without_a_sort(spark, tmp_path):
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    df = spark.range(100).select("id", F.when(F.col("id") % 10 > 0, F.col("id") % 3).cast("string").alias("side"))
    back = shared.materialize(df, str(tmp_path / "sides"), by="side")
    assert back.dtypes == df.dtypes and back.exceptAll(df).isEmpty() and back.count() == 100
    assert spark.conf.get(setting) == before
