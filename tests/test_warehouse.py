"""Files of the fact: deletes by position, key filters, the two-level manifest, loads at one time."""

from dataclasses import replace

import pytest
from test_loads import SALES, fact_files, raw, sales

from starmill.config import MartConfig
from starmill.contracts import FACT_SALES
from starmill.operators import cleaning
from starmill.plans import loads
from starmill.sources import shared
from starmill.sources.manifest import Data
from starmill.sources.warehouse import Change, Run, RunTaken, Warehouse


@pytest.fixture
def config(tmp_path):
    return MartConfig(str(tmp_path), "revenue", rows_per_file=2)


def loaded(spark, config, ids, day="2024-01-05", start=0):
    return loads.load(spark, config, loads.REVENUE, raw(spark, SALES, sales(ids, day), start))


def rows_written(spark, config, table="fact_sales"):
    """Rows of all files a table's folders hold, by run."""
    out = {}
    for tag in shared.children(spark, f"{config.root}/revenue/{table}"):
        out[int(tag[1:].split("-")[0])] = spark.read.parquet(f"{config.root}/revenue/{table}/{tag}").count()
    return out


SCATTERED = [(i * 2862933555777941757) % 9223372036854775783 - 4611686018427387891 for i in range(1, 4001)]


def test_scattered_batch_writes_about_its_own_rows(spark, tmp_path):
    """One id in a hundred, in every file: no file is written anew, replaced rows go by position."""
    config = MartConfig(str(tmp_path), "revenue", rows_per_file=400)
    loaded(spark, config, SCATTERED)
    before = {d.path for d in fact_files(spark, config)}
    batch = SCATTERED[::100]
    loaded(spark, config, batch, "2024-02-01")
    files = fact_files(spark, config)
    assert before <= {d.path for d in files} and len(files) == len(before) + 1
    assert sum(d.deleted for d in files) == 40 and rows_written(spark, config)[2] == 40
    fact = Warehouse(spark, config).read(FACT_SALES)
    assert fact.count() == 4000 and fact.select("order_id").distinct().count() == 4000
    assert {r.order_id for r in fact.filter("month(full_date) = 2").collect()} == set(batch)
    # the same ids again: what is dead already is not counted twice
    loaded(spark, config, batch, "2024-03-01")
    files = fact_files(spark, config)
    assert sum(d.live for d in files) == 4000 and sum(d.deleted for d in files) == 40
    assert Warehouse(spark, config).read(FACT_SALES).filter("month(full_date) = 3").count() == 40


def test_files_are_written_anew_when_half_or_too_much_is_deleted(spark, tmp_path):
    config = MartConfig(str(tmp_path), "revenue", rows_per_file=100)
    loaded(spark, config, range(400))
    loaded(spark, config, range(0, 60), "2024-02-01")  # most of the first file
    files = fact_files(spark, config)
    assert sum(d.deleted for d in files) == 0 and sum(d.live for d in files) == 400
    loaded(spark, config, range(100, 400, 10), "2024-03-01")
    assert sum(d.deleted for d in fact_files(spark, config)) == 30
    tight = replace(config, max_deletes=5)
    loaded(spark, tight, range(101, 400, 30), "2024-04-01")
    files = fact_files(spark, tight)
    assert sum(d.deleted for d in files) <= 5 and sum(d.live for d in files) == 400
    fact = Warehouse(spark, tight).read(FACT_SALES)
    assert [fact.filter(f"month(full_date) = {m}").count() for m in (2, 3, 4)] == [60, 30, 10]


def test_key_filters_spare_files_of_scattered_ids(spark, tmp_path, monkeypatch):
    """Ranges of scattered ids say nothing; filters leave only files that hold an id of the batch."""
    config = MartConfig(str(tmp_path), "revenue", rows_per_file=100)
    for part in range(5):  # files of one load share the whole range of ids with those of the others
        loaded(spark, config, SCATTERED[part::5])
    files = fact_files(spark, config)
    opened = []
    placed = Warehouse.placed
    monkeypatch.setattr(Warehouse, "placed", lambda self, table, data, columns: (opened.append([d.path for d in data]), placed(self, table, data, columns))[1])
    batch = SCATTERED[7:9]
    in_range = [d for d in files if d.first <= max(batch) and d.last >= min(batch)]
    loaded(spark, config, batch, "2024-02-01")
    assert len(in_range) >= 10 and len(opened[0]) <= 3
    opened.clear()
    loaded(spark, config, [min(SCATTERED) + 1, max(SCATTERED) - 1], "2024-02-01")  # new ids amid the others
    assert not opened or len(opened[0]) <= 1
    assert Warehouse(spark, config).read(FACT_SALES).count() == 4002


def entries(n):
    return [Data(f"/nowhere/part-{i:06}.parquet", i * 100, i * 100 + 99, 80, filter=None) for i in range(n)]


def test_publishing_follows_the_batch_and_not_the_number_of_files(spark, tmp_path):
    """A fact of 100,000 files: a batch of new ids reads and writes one part of the manifest."""
    config = MartConfig(str(tmp_path), "revenue", rows_per_file=100)
    warehouse = Warehouse(spark, config)
    run = warehouse.start()
    run.parts["fact_sales"] = run.manifest.write_parts(entries(100_000), f"{warehouse.base}/parts/{run.tag}")
    run.publish()
    _, before = warehouse.published()
    assert len(before.parts["fact_sales"]) == 100
    run = warehouse.start()
    ids = [50_000 * 100 + i for i in range(60)]
    batch = loads.facts.sales_fact(cleaning.clean(cleaning.REVENUE.canonicalize(raw(spark, SALES, sales(ids))), cleaning.REVENUE))
    run.earlier["fact_sales"] = Change(min(ids), max(ids), frozenset(d.path for d in entries(100_000)), added=(Data("/new.parquet", min(ids), max(ids), 60),))
    run.merge(FACT_SALES, batch, 60)
    run.publish()
    _, after = warehouse.published()
    shared_parts = set(before.parts["fact_sales"]) & set(after.parts["fact_sales"])
    assert len(shared_parts) >= 99 and sum(p.files for p in after.parts["fact_sales"]) == 100_001
    assert spark.read.parquet(f"{warehouse.base}/parts/{run.tag}").count() <= 1001


@pytest.mark.parametrize("commit", ["rename", "create"])
def test_two_loads_at_one_time_both_end(spark, tmp_path, monkeypatch, commit):
    """Another load is published between this one's start and its end; ids apart, then ids in common."""
    config = MartConfig(str(tmp_path), "revenue", rows_per_file=50, commit=commit)
    loaded(spark, config, range(200))
    publish, merged, between = Run.publish, Run._merged, []
    worked_out = []
    monkeypatch.setattr(Run, "_merged", lambda self, *a: (worked_out.append(self.number), merged(self, *a))[1])

    def late(self):
        if between:
            loaded(spark, config, between.pop(), "2024-05-01")
        return publish(self)

    monkeypatch.setattr(Run, "publish", late)
    between.append(range(1000, 1060))
    report = loaded(spark, config, range(100, 130), "2024-02-01")
    assert report.run == 3 and worked_out == [2, 2]  # once for each load: the first one's files stayed
    between.append(range(110, 140))
    report = loaded(spark, config, range(100, 120), "2024-03-01")
    assert report.run == 5 and len(worked_out) == 5  # ids in common are merged anew
    fact = {r.order_id: r.full_date.month for r in Warehouse(spark, config).read(FACT_SALES).collect()}
    assert len(fact) == 260 == Warehouse(spark, config).read(FACT_SALES).count()
    expected = {i: 3 if i < 120 else 5 if i < 140 else 1 for i in range(100, 200)}
    assert {i: fact[i] for i in range(100, 200)} == expected and all(fact[i] == 5 for i in range(1000, 1060))


def test_a_load_gives_up_after_its_attempts(spark, tmp_path, monkeypatch):
    config = MartConfig(str(tmp_path), "revenue", attempts=2)

    def refused(self):
        raise RunTaken("busy")

    monkeypatch.setattr(Run, "publish", refused)
    with pytest.raises(RunTaken):
        loaded(spark, config, range(3))


def test_a_list_that_was_not_written_to_its_end_is_no_run(spark, config):
    loaded(spark, config, range(3))
    warehouse = Warehouse(spark, config)
    shared.create_text(spark, f"{warehouse.base}/manifest/run=2/list.json", '{"run": 2, "folders": {"dim')
    assert warehouse.published()[0] == 1 and warehouse.read(FACT_SALES).count() == 3
    assert loaded(spark, config, range(3, 5)).run == 3


def test_vacuum_keeps_positions_filters_and_parts_in_use(spark, tmp_path):
    config = MartConfig(str(tmp_path), "revenue", rows_per_file=100)
    loaded(spark, config, range(300))
    loaded(spark, config, range(0, 300, 30), "2024-02-01")
    loaded(spark, config, range(5, 300, 30), "2024-03-01")
    warehouse = Warehouse(spark, config)
    assert warehouse.vacuum(keep=1)
    assert warehouse.vacuum(keep=1) == []
    loaded(spark, config, range(7, 300, 30), "2024-04-01")
    fact = warehouse.read(FACT_SALES)
    assert fact.count() == 300 and [fact.filter(f"month(full_date) = {m}").count() for m in (2, 3, 4)] == [10, 10, 10]


def test_live_rows_stay_in_their_tasks_however_many_are_deleted(spark, tmp_path):
    """Deleted positions too many to be broadcast by their size are looked up as bitmaps."""
    config = MartConfig(str(tmp_path), "revenue", rows_per_file=100)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        loaded(spark, config, range(300))
        loaded(spark, config, range(0, 300, 3), "2024-02-01")
        fact = Warehouse(spark, config).read(FACT_SALES)
        plan = fact._jdf.queryExecution().executedPlan().toString()
        months = [r.full_date.month for r in fact.orderBy("order_id").collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert any(d.deletes for d in fact_files(spark, config))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert months == [2 if i % 3 == 0 else 1 for i in range(300)]


def test_a_large_fact_is_not_written_anew_for_the_number_of_its_deleted_rows(spark, tmp_path):
    """Millions of deleted rows, as a large fact has them, in files that are more than half full."""
    config = MartConfig(str(tmp_path), "revenue", rows_per_file=100)
    loaded(spark, config, range(400))
    loaded(spark, config, range(0, 400, 40), "2024-02-01")
    run = Warehouse(spark, config).start()
    run.parts = {name: tuple(replace(p, deleted=p.deleted + (1 << 21)) for p in own) for name, own in run.parts.items()}
    run.publish()
    before = {d.path for d in fact_files(spark, config)}
    loaded(spark, config, range(1, 400, 40), "2024-03-01")
    files = fact_files(spark, config)
    kept = {d.path for d in files if d.rows == 100}
    assert len(kept & before) == 4 and sum(d.deleted for d in files if d.path in kept) == 20
    fact = Warehouse(spark, config).read(FACT_SALES)
    assert fact.count() == 400 and [fact.filter(f"month(full_date) = {m}").count() for m in (2, 3)] == [10, 10]
