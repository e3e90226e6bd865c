"""Audits that read only what earlier ones have not: the same counts as on all rows, and which files are read."""

import pytest
from test_loads import SALES, raw, sales

from starmill import contracts
from starmill.config import MartConfig
from starmill.contracts import FACT_SALES
from starmill.operators import checks
from starmill.plans import audit, loads
from starmill.sources import shared
from starmill.sources.warehouse import Warehouse

TIGHT = [("max_length", "region_name", "char_length(region_name) > 4"), ("not_null", "branch_name", "branch_name IS NULL")]


@pytest.fixture
def config(tmp_path):
    return MartConfig(str(tmp_path), "revenue", rows_per_file=100)


def loaded(spark, config, ids, day="2024-01-05", region=None):
    rows = sales(ids, day) if region is None else [(r[0], r[1], region, *r[3:]) for r in sales(ids, day)]
    loads.load(spark, config, loads.REVENUE, raw(spark, SALES, rows))


def auditor(spark, config, tests=None, dims=contracts.REVENUE_DIMS):
    warehouse = Warehouse(spark, config)
    return audit.Auditor(warehouse, FACT_SALES, {t.name: warehouse.read(t) for t in dims}, tests)


def on_all_rows(spark, config, tests=None):
    warehouse = Warehouse(spark, config)
    fact, dims = warehouse.read(FACT_SALES), {t.name: warehouse.read(t) for t in contracts.REVENUE_DIMS}
    found = [checks.check_unique(fact, "order_id"), checks.check_rows(fact, FACT_SALES, tests), checks.check_references(fact, FACT_SALES, dims)]
    return sorted((tuple(r) for df in found for r in df.select(*checks.COLUMNS).collect()), key=lambda r: [str(v) for v in r])


def collected(df):
    return sorted((tuple(r) for r in df.select(*checks.COLUMNS).collect()), key=lambda r: [str(v) for v in r])


@pytest.fixture
def opened(monkeypatch):
    """Names of the files each reading of rows opened: of whole tests, and of keys alone."""
    seen = {"rows": [], "keys": []}
    placed = Warehouse.placed

    def watched(self, table, files, columns):
        seen["keys" if list(columns) == [table.key] else "rows"] += [d.name for d in files]
        return placed(self, table, files, columns)

    monkeypatch.setattr(Warehouse, "placed", watched)
    return seen


def watch(opened):
    opened["rows"].clear()
    opened["keys"].clear()


def test_an_audit_reads_new_files_only(spark, config, opened):
    loaded(spark, config, range(400))
    first = {d.name for d in Warehouse(spark, config).files(FACT_SALES)}
    watch(opened)
    assert collected(auditor(spark, config).audit()) == on_all_rows(spark, config)
    assert set(opened["rows"]) == first
    watch(opened)
    assert collected(auditor(spark, config).audit()) == on_all_rows(spark, config)
    assert opened == {"rows": [], "keys": []}  # nothing was loaded since
    loaded(spark, config, range(1000, 1050))
    new = {d.name for d in Warehouse(spark, config).files(FACT_SALES)} - first
    watch(opened)
    assert collected(auditor(spark, config).audit()) == on_all_rows(spark, config)
    assert new and set(opened["rows"]) == new and set(opened["keys"]) == new


def test_files_with_deleted_rows_are_read_again_only_for_violations(spark, config, opened):
    loaded(spark, config, range(200), region="Far away")  # two files, all rows too long
    loaded(spark, config, range(300, 500), region="East")
    auditor(spark, config, TIGHT).audit()
    files = {d.name: d for d in Warehouse(spark, config).files(FACT_SALES)}
    loaded(spark, config, [*range(0, 200, 20), *range(300, 500, 20)], region="West")
    watch(opened)
    found = auditor(spark, config, TIGHT).audit()
    reread = set(opened["rows"]) & set(files)
    assert collected(found) == on_all_rows(spark, config, TIGHT)
    assert {r.column: (r.n_violations, r.sample_key) for r in found.filter("constraint = 'max_length'").collect()} == {"region_name": (190, "1")}
    assert len(reread) == 2 and all(files[name].last < 200 for name in reread)


def test_values_that_a_dimension_lost_are_found_without_reading_the_fact(spark, config, opened):
    loaded(spark, config, range(100))
    auditor(spark, config).audit()
    watch(opened)
    late = auditor(spark, config)
    late.dims["dim_region"] = late.dims["dim_region"].filter("false")
    found = {(r.constraint, r.column): r.n_violations for r in late.audit().collect() if r.n_violations}
    assert found == {("foreign_key", "region_name"): 100} and opened["rows"] == []


def test_repeated_keys_across_files(spark, config):
    """Two files with keys in common, as no load leaves them; a later load replaces some of these."""
    loaded(spark, config, range(100))
    auditor(spark, config).audit()
    warehouse = Warehouse(spark, config)
    run = warehouse.start()
    again = warehouse.read(FACT_SALES).filter("order_id < 30")
    files = run._write_files(FACT_SALES, again, 30)
    run.parts["fact_sales"] = (*run.parts["fact_sales"], *run.manifest.write_parts(files, f"{warehouse.base}/parts/{run.tag}"))
    run.publish()

    def repeated():
        return [tuple(r) for r in auditor(spark, config).audit().filter("constraint = 'primary_key'").select("n_violations", "sample_key").collect()]

    assert repeated() == [(30, "0")]
    assert repeated() == [(30, "0")]
    loaded(spark, config, range(10), "2024-02-01")
    assert repeated() == [(20, "10")]


def test_a_mart_without_rows_and_an_audit_cut_short(spark, config):
    loads.create(spark, config, loads.REVENUE)
    assert collected(auditor(spark, config).audit()) == on_all_rows(spark, config)
    loaded(spark, config, range(10))
    own = auditor(spark, config)
    shared.create_text(spark, f"{own.base}/7", "/nowhe")  # a name that was not written to its end
    assert collected(own.audit()) == on_all_rows(spark, config)
    own.audit()
    assert all(int(n) >= 7 for n in shared.children(spark, own.base) if n.isdigit())


def test_states_follow_their_contract_and_vacuum_leaves_them(spark, config):
    loaded(spark, config, range(50))
    auditor(spark, config).audit()
    assert auditor(spark, config, TIGHT).base != auditor(spark, config).base
    loaded(spark, config, range(50, 90))
    warehouse = Warehouse(spark, config)
    warehouse.vacuum(keep=1)
    assert collected(audit.audit(warehouse, loads.REVENUE)) == collected(
        checks.audit(warehouse.read(FACT_SALES), FACT_SALES, {t.name: warehouse.read(t) for t in contracts.REVENUE_DIMS}, contracts.REVENUE_DIMS)
    )
