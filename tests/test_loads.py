import datetime
import warnings
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmill import contracts
from starmill.config import MartConfig
from starmill.contracts import DIM_BRANCH, DIM_PRODUCT, DIM_STAGE, FACT_MARKETING, FACT_SALES
from starmill.operators import checks, cleaning
from starmill.operators.upsert import changed, upsert
from starmill.plans import loads
from starmill.sources import testdata
from starmill.sources.headers import ORDINAL, UnusableTable
from starmill.sources.reader import read_raw
from starmill.sources.warehouse import RunTaken, Warehouse

SALES = ["Order ID", "ngay", "Vung", "chi_nhanh", "San Pham", "Danh-Muc", "Doanh Thu"]
MARKETING = ["order_id", "date", "stage", "channel", "revenue", "campaign"]


def raw(spark, fields, rows, start=0):
    schema = f"{ORDINAL} LONG, " + ", ".join(f"`{f}` STRING" for f in fields)
    return spark.createDataFrame([(start + i, *r) for i, r in enumerate(rows)], schema)


FIRST = [
    ("1", "2024-01-05", "North", "B1", "P1", None, "10"),
    ("2", "13/01/2024", "North", "B1", "P2", "Milk", "20"),
    ("2", "13/01/2024", "South", "B1", "P2", "Milk", "25"),
    ("x", "2024-01-05", "North", "B1", "P1", None, "10"),
    ("900", "2024-01-05", "East", "B3", "P9", "Tea", "1"),
]
SECOND = [
    ("1", "2024-02-01", "North", "B2", "P1", "Milk", "11"),
    ("3", "2024-02-01", "South", None, "P2", "Juice", "30"),
]


@pytest.fixture
def config(tmp_path):
    return MartConfig(str(tmp_path), "revenue", rows_per_file=2)


def test_two_batches(spark, config, rows):
    report = loads.load(spark, config, loads.REVENUE, raw(spark, SALES, FIRST))
    assert (report.run, report.raw, report.rejected, report.superseded, report.clean) == (1, 5, 1, 1, 3)
    assert report.rejected_by_reason == {"order_id": 1, "date": 0, "region": 0, "revenue": 0}
    report = loads.load(spark, config, loads.REVENUE, raw(spark, SALES, SECOND, 100))
    assert (report.run, report.clean) == (2, 2)

    warehouse = Warehouse(spark, config)
    fact = {r.order_id: r for r in warehouse.read(FACT_SALES).collect()}
    assert set(fact) == {1, 2, 3, 900}
    assert (fact[1].revenue, fact[1].branch_name, fact[1].full_date) == (Decimal("11.00"), "B2", datetime.date(2024, 2, 1))
    assert (fact[2].region_name, fact[2].revenue) == ("South", Decimal("25.00"))
    assert rows(warehouse.read(DIM_PRODUCT)) == [("P1", "Milk"), ("P2", "Milk"), ("P9", "Tea")]
    assert rows(warehouse.read(DIM_BRANCH)) == [("B1", "South"), ("B2", "North"), ("B3", "East")]
    dims = {t.name: warehouse.read(t) for t in contracts.REVENUE_DIMS}
    found = checks.audit(warehouse.read(FACT_SALES), FACT_SALES, dims, contracts.REVENUE_DIMS)
    assert found.filter("n_violations > 0").count() == 0


def sales(ids, day="2024-01-05"):
    return [(str(i), day, "North", "B1", "P1", "Milk", "1") for i in ids]


def fact_files(spark, config):
    return set(Warehouse(spark, config).files(FACT_SALES))


IDS = {
    "dense": range(400),
    "hashed": [(i * 2862933555777941757) % 9223372036854775783 - 4611686018427387891 for i in range(1, 401)],
    "negative": range(-400, 0),
}


@pytest.mark.parametrize("kind", list(IDS))
def test_number_of_files_follows_rows_and_a_load_touches_only_files_it_meets(spark, tmp_path, kind):
    ids = list(IDS[kind])
    config = MartConfig(str(tmp_path), "revenue", rows_per_file=40)
    loads.load(spark, config, loads.REVENUE, raw(spark, SALES, sales(ids)))
    before = fact_files(spark, config)
    assert len(before) == 10 and sum(d.rows for d in before) == 400
    few = sorted(ids)[:3]
    loads.load(spark, config, loads.REVENUE, raw(spark, SALES, sales(few, "2024-02-01")))
    after = fact_files(spark, config)
    assert len(after) <= 12 and sum(d.live for d in after) == 400
    assert len(before & after) >= 8
    fact = Warehouse(spark, config).read(FACT_SALES)
    assert fact.count() == 400 and {r.order_id for r in fact.filter("month(full_date) = 2").collect()} == set(few)


def test_small_files_do_not_pile_up(spark, tmp_path):
    config = MartConfig(str(tmp_path), "revenue", rows_per_file=40)
    for i in range(4):
        loads.load(spark, config, loads.REVENUE, raw(spark, SALES, sales(range(10 * i, 10 * i + 10))))
    assert len(fact_files(spark, config)) <= 2  # each at least half full


def test_file_size_may_change_from_load_to_load(spark, config):
    loads.load(spark, config, loads.REVENUE, raw(spark, SALES, FIRST))
    other = replace(config, rows_per_file=100)
    assert Warehouse(spark, other).start(rebuild=True).number == 2
    loads.load(spark, other, loads.REVENUE, raw(spark, SALES, SECOND, 100))
    assert Warehouse(spark, other).read(FACT_SALES).count() == 4 and len(fact_files(spark, other)) == 1


def test_vacuum_deletes_old_runs_and_failed_ones_but_not_one_in_progress(spark, config, tmp_path):
    warehouse = Warehouse(spark, config)
    loads.load(spark, config, loads.REVENUE, raw(spark, SALES, FIRST))
    failed = warehouse.start()
    failed.write(DIM_BRANCH, warehouse.read(DIM_BRANCH))
    loads.load(spark, config, loads.REVENUE, raw(spark, SALES, SECOND, 100))
    waiting = warehouse.start()
    waiting.write(DIM_BRANCH, warehouse.read(DIM_BRANCH))
    rows = warehouse.read(FACT_SALES).count()
    dead = warehouse.vacuum(keep=1)
    assert any(failed.tag in p for p in dead) and not any(waiting.tag in p for p in dead)
    assert any(p.endswith("manifest/run=1") for p in dead)
    assert warehouse.read(FACT_SALES).count() == rows == 4
    assert (tmp_path / "revenue" / "dim_branch" / waiting.tag).exists()
    assert not (tmp_path / "revenue" / "dim_branch" / failed.tag).exists()
    assert warehouse.vacuum(keep=1) == []
    assert waiting.publish() == 3 and warehouse.read(FACT_SALES).count() == 4


def test_left_over_manifest_of_a_dead_run_blocks_nothing(spark, config, tmp_path):
    for n in (1, 3):
        (tmp_path / "revenue" / "manifest" / f"run={n}" / "_temporary" / "0").mkdir(parents=True)
        assert loads.load(spark, config, loads.REVENUE, raw(spark, SALES, FIRST)).run == n + 1
    assert Warehouse(spark, config).read(FACT_SALES).count() == 3


def test_of_two_writers_one_is_refused_and_nothing_is_mixed(spark, config):
    warehouse = Warehouse(spark, config)
    one, two = warehouse.start(), warehouse.start()
    for run, names in ((one, ["B1"]), (two, ["B1", "B2"])):
        run.write(DIM_BRANCH, spark.createDataFrame([(n, "North") for n in names], DIM_BRANCH.schema))
    assert two.publish() == 1
    with pytest.raises(RunTaken):
        one.publish()
    assert warehouse.read(DIM_BRANCH).count() == 2
    assert loads.load(spark, config, loads.REVENUE, raw(spark, SALES, FIRST)).run == 2


def test_rejected_rows_are_kept_with_reasons(spark, config):
    batch = [*FIRST, ("7", "9999-12-31", "North", "B1", "P1", None, "10"), ("8", "no", " ", "B1", "P1", None, "1")]
    report = loads.load(spark, config, loads.REVENUE, raw(spark, SALES, batch))
    assert report.rejected_by_reason == {"order_id": 1, "date": 1, "region": 1, "revenue": 0, "date_span": 1}
    assert (report.raw, report.rejected, report.superseded, report.clean) == (7, 3, 1, 3)
    kept = spark.read.parquet(Warehouse(spark, config).folder(loads.REJECTED))
    reasons = sorted(tuple(sorted(r.reasons)) for r in kept.collect())
    assert reasons == [("date", "region"), ("date_span",), ("order_id",)]


def test_source_is_read_once_per_load(spark, config, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    source = raw(spark, SALES, FIRST)

    def watch(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    loads.load(spark, config, loads.REVENUE, source.mapInArrow(watch, source.schema))
    assert seen.value == len(FIRST)


def test_staged_tables_with_headers_of_their_own(spark, config, rows):
    """Other spellings, another order, a column more and one less; the later table has the last word."""
    first = raw(spark, SALES, FIRST, start=1000)
    second = raw(spark, ["revenue", "REGION", "Ngay", "orderid", "kenh"], [("12", "South", "2024-02-01", "1", "Shop"), ("5", "West", "2024-02-01", "77", None)])
    report = loads.load(spark, config, loads.REVENUE, [first, second])
    assert (report.raw, report.rejected, report.superseded, report.clean) == (7, 1, 2, 4)
    fact = {r.order_id: r for r in Warehouse(spark, config).read(FACT_SALES).collect()}
    assert (fact[1].region_name, fact[1].channel_name, fact[1].product_name) == ("South", "Shop", None)
    assert set(fact) == {1, 2, 77, 900} and fact[900].region_name == "East"
    with pytest.raises(UnusableTable, match="region"):
        loads.load(spark, config, loads.REVENUE, [first, second.drop("REGION")])


def test_rows_of_one_row_group_are_parsed_in_many_tasks(spark, tmp_path):
    """However the source is cut into tasks, no task parses much more than its share."""
    path = str(tmp_path / "one")
    spark.range(20_000).select(F.col("id").cast("string").alias("order_id"), F.lit("5/1/2024").alias("date"),
                               F.lit("North").alias("region"), F.lit("1").alias("revenue")).coalesce(1).write.parquet(path)
    raw_rows = read_raw(spark, path)
    assert raw_rows.select(F.spark_partition_id()).distinct().count() == 1
    parsed = cleaning.parse(cleaning.spread(cleaning.REVENUE.canonicalize(raw_rows)), cleaning.REVENUE)
    sizes = [r["count"] for r in parsed.groupBy(F.spark_partition_id()).count().collect()]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(sizes) == tasks and max(sizes) < 1.2 * 20_000 / tasks


def test_create_leaves_the_seeded_stages(spark, tmp_path):
    config = MartConfig(str(tmp_path), "marketing")
    assert loads.create(spark, config, loads.MARKETING) == 1
    assert sorted(r.stage_order for r in Warehouse(spark, config).read(DIM_STAGE).collect()) == [1, 2, 3, 4, 5]
    assert loads.create(spark, config, loads.MARKETING) == 1
    loads.load(spark, config, loads.MARKETING, raw(spark, MARKETING, [("1", "2024-01-01", "Demo", "TV", "5", "Tet")]))
    assert Warehouse(spark, config).read(DIM_STAGE).count() == 6


def test_settings_to_finished_load(spark, tmp_path):
    raw(spark, SALES, FIRST).write.parquet(str(tmp_path / "sheet"))
    settings = {"DB_SCHEMA_DWH": str(tmp_path / "dw"), "RAW_PATH": str(tmp_path / "sheet"), "RAW_ORDINAL": ORDINAL}
    report = loads.run(spark, loads.REVENUE, settings)
    assert (report.raw, report.clean) == (5, 3)
    spark.sql("CREATE DATABASE IF NOT EXISTS staging_area")
    name = f"sheet_{tmp_path.name}".replace("-", "_")
    raw(spark, SALES, SECOND, 100).write.option("path", str(tmp_path / "table")).saveAsTable(f"staging_area.{name}")
    settings = {"DB_SCHEMA_DWH": str(tmp_path / "dw"), "DB_SCHEMA_STAGING": "staging_area", "RAW_TABLE": name, "RAW_ORDINAL": ORDINAL}
    assert loads.run(spark, loads.REVENUE, settings).clean == 2
    assert Warehouse(spark, MartConfig.from_settings("revenue", settings)).read(FACT_SALES).count() == 4


def test_rerun_changes_nothing(spark, config):
    batch = raw(spark, SALES, FIRST)
    loads.load(spark, config, loads.REVENUE, batch)
    warehouse = Warehouse(spark, config)
    tables = (FACT_SALES, *contracts.REVENUE_DIMS)
    before = {t.name: warehouse.read(t) for t in tables}
    loads.load(spark, config, loads.REVENUE, batch)
    for t in tables:
        if len(t.columns) > 1:
            assert changed(before[t.name], warehouse.read(t), t.key).count() == 0
        assert warehouse.read(t).count() == before[t.name].count()


def test_rebuild_forgets_earlier_batches(spark, config):
    loads.load(spark, config, loads.REVENUE, raw(spark, SALES, FIRST))
    loads.load(spark, config, loads.REVENUE, raw(spark, SALES, SECOND), mode="rebuild")
    warehouse = Warehouse(spark, config)
    assert {r.order_id for r in warehouse.read(FACT_SALES).collect()} == {1, 3}
    assert {r.product_name for r in warehouse.read(DIM_PRODUCT).collect()} == {"P1", "P2"}


def test_violation_publishes_nothing(spark, config):
    loads.load(spark, config, loads.REVENUE, raw(spark, SALES, FIRST))
    bad = [("5", "2024-01-05", "W" * 51, "B1", "P1", None, "1"), ("6", "2024-01-05", "North", "B1", "P1", None, "1e17")]
    for row, name in zip(bad, ("max_length", "precision revenue"), strict=True):
        with pytest.raises(checks.ContractViolation, match=name):
            loads.load(spark, config, loads.REVENUE, raw(spark, SALES, [row]))
    warehouse = Warehouse(spark, config)
    assert warehouse.published()[0] == 1
    assert {r.order_id for r in warehouse.read(FACT_SALES).collect()} == {1, 2, 900}


def test_empty_batch_is_a_no_op(spark, config):
    loads.load(spark, config, loads.REVENUE, raw(spark, SALES, FIRST))
    report = loads.load(spark, config, loads.REVENUE, raw(spark, SALES, FIRST).limit(0))
    assert (report.raw, report.clean) == (0, 0)
    assert Warehouse(spark, config).read(FACT_SALES).count() == 3


def test_unloaded_warehouse_is_empty_but_typed(spark, config):
    fact = Warehouse(spark, config).read(FACT_SALES)
    assert fact.count() == 0
    assert fact.schema.simpleString() == FACT_SALES.schema.simpleString()


def test_marketing_keeps_created_at_on_update(spark, tmp_path):
    config = MartConfig(str(tmp_path), "marketing")
    loads.load(spark, config, loads.MARKETING, raw(spark, MARKETING, [("1", "2024-01-01", "Demo", "TV", "5", "Tet")]))
    warehouse = Warehouse(spark, config)
    first = warehouse.read(FACT_MARKETING).first()
    batch = [("1", "2024-01-02", "Click", "TV", "6", None), ("2", "2024-01-02", "Click", "Radio", "7", "x")]
    loads.load(spark, config, loads.MARKETING, raw(spark, MARKETING, batch))
    after = {r.order_id: r for r in warehouse.read(FACT_MARKETING).collect()}
    assert after[1].created_at == first.created_at < after[2].created_at
    assert (after[1].revenue, after[1].campaign_name) == (Decimal("6.00"), None)
    assert warehouse.read(DIM_STAGE).count() == 6


def test_renamed_tables(spark, tmp_path):
    config = MartConfig.from_settings(
        "revenue", {"DB_SCHEMA_DWH": str(tmp_path), "FACT_SALES_TABLE": "sales", "RAW_TABLE": "sheet"}
    )
    assert (config.table("fact_sales"), config.table("dim_date"), config.raw_name) == ("sales", "dim_date", "staging.sheet")
    loads.load(spark, config, loads.REVENUE, raw(spark, SALES, FIRST))
    assert (tmp_path / "revenue" / "sales").exists()
    assert Warehouse(spark, config).read(FACT_SALES).count() == 3


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_file_order_decides_which_row_is_last(spark, tmp_path, config, fmt):
    path = str(tmp_path / f"raw-{fmt}")
    for i, region in enumerate(["a", "b", "c"]):
        df = spark.createDataFrame([("1", "2024-01-01", region, "1"), ("1", "2024-01-01", region * 2, "1")],
                                   ["order_id", "date", "region", "revenue"]).coalesce(1)
        df.write.option("header", True).format(fmt).save(f"{path}/part={i}")
    source = read_raw(spark, path, fmt)
    loads.load(spark, config, loads.REVENUE, source)
    assert [r.region_name for r in Warehouse(spark, config).read(FACT_SALES).collect()] == ["cc"]


def test_named_ordinal_and_database_source(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([("1", 5)], "order_id STRING, line INT").write.parquet(path)
    assert read_raw(spark, path, ordinal="line").first()[ORDINAL] == 5
    with pytest.raises(ValueError, match="name an ordinal column"):
        read_raw(spark, path, fmt="binaryFile")


def test_loading_in_two_deliveries_equals_loading_at_once(spark, sf_dir, tmp_path):
    source = testdata.raw_sales(spark, sf_dir)
    once, twice = (MartConfig(str(tmp_path / d), "revenue", rows_per_file=500) for d in ("once", "twice"))
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        loads.load(spark, once, loads.REVENUE, source)
    for batch in testdata.sales_batches(source):
        loads.load(spark, twice, loads.REVENUE, batch)
    a, b = Warehouse(spark, once).read(FACT_SALES), Warehouse(spark, twice).read(FACT_SALES)
    assert a.count() == b.count() > 0
    assert changed(a, b, "order_id").count() == 0


def test_small_batch_does_not_shuffle_the_existing_rows(spark):
    """The batch's keys are broadcast by their size, so untouched rows stay where they are."""
    current = spark.range(1000).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    batch = spark.range(5).select(F.col("id").alias("k"), F.lit("b").alias("v"))
    plan = upsert(current, batch, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
