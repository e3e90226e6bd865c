"""The two loads: clean, check, merge, publish."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill import contracts
from starmill.config import MartConfig
from starmill.contracts import Table
from starmill.operators import checks, cleaning, dimensions, facts, summaries
from starmill.operators.cleaning import CleanSpec
from starmill.operators.upsert import upsert
from starmill.sources import seeds, shared
from starmill.sources.reader import read_raw
from starmill.sources.warehouse import Change, Run, RunTaken, Warehouse


@dataclass(frozen=True)
class Mart:
    name: str
    spec: CleanSpec
    fact: Table
    dims: tuple[Table, ...]
    build_dims: Callable[[DataFrame], dict[str, DataFrame]]
    build_fact: Callable[[DataFrame], DataFrame]


REVENUE = Mart(
    "revenue",
    cleaning.REVENUE,
    contracts.FACT_SALES,
    contracts.REVENUE_DIMS,
    dimensions.revenue_dims,
    facts.sales_fact,
)
MARKETING = Mart(
    "marketing",
    cleaning.MARKETING,
    contracts.FACT_MARKETING,
    contracts.MARKETING_DIMS,
    dimensions.marketing_dims,
    facts.marketing_fact,
)


REJECTED = "rejected_rows"


@dataclass(frozen=True)
class LoadReport:
    """What a load did with its rows."""

    run: int
    raw: int
    rejected: int
    superseded: int
    clean: int
    rejected_by_reason: dict[str, int]


def load(
    spark: SparkSession, config: MartConfig, mart: Mart, raw: DataFrame | Sequence[DataFrame], mode: str = "upsert"
) -> LoadReport:
    """Load one batch. ``mode="rebuild"`` starts from empty tables instead of the published ones.
    A batch may be several staged tables with headers of their own, the latest last.

    The source is read and parsed once, into a table of complete rows and one of rejected rows with
    reasons, which becomes part of the run. Of the clean batch only the places are written, as bitmaps:
    every dimension and the fact read only their own columns of the parsed rows there. All counts come from these tables. All tables appear
    together when the run is published; a violated contract raises before. If another load was published
    meanwhile, this one merges its batch into the newer tables and follows as the later delivery; nothing
    is parsed again, and the files of the fact it wrote stay unless the other load met the same orders.
    """
    raws = [raw] if isinstance(raw, DataFrame) else list(raw)
    parsed = cleaning.parse(cleaning.spread(mart.spec.canonicalize_each(raws)), mart.spec)
    path = shared.new_path(spark, f"load-{mart.name}")
    run = Warehouse(spark, config).start(rebuild=mode == "rebuild")
    try:
        complete, incomplete = cleaning.split(parsed, f"{path}/parsed")
        clean = cleaning.staged_last_of(complete, f"{path}/last")
        kept = clean.count()
        lacking = [F.count_if(cond).alias(c) for c, cond in cleaning.missing(mart.spec).items()]
        seen = incomplete.agg(F.count("*").alias("rows"), *lacking).first()
        usable = complete.count()
        for attempt in range(config.attempts):
            dims = _load_dims(run, mart, clean)
            _load_fact(run, mart, clean, dims, kept, first=attempt == 0)
            run.write_side(REJECTED, cleaning.rejects(incomplete).drop(cleaning.LACKING))
            try:
                number = run.publish()
                break
            except RunTaken:
                if attempt + 1 == config.attempts:
                    raise
                run = run.again()
        reasons = {c: seen[c] for c in cleaning.missing(mart.spec) if c in mart.spec.required or seen[c]}
        return LoadReport(
            run=number,
            raw=usable + seen["rows"],
            rejected=seen["rows"],
            superseded=usable - kept,
            clean=kept,
            rejected_by_reason=reasons,
        )
    finally:
        shared.discard(spark, path)


def create(spark: SparkSession, config: MartConfig, mart: Mart) -> int:
    """Publish the rows that tables have before any load: the five stages. Does nothing to a mart
    that has been published. Returns the number of the newest run."""
    warehouse = Warehouse(spark, config)
    newest, _ = warehouse.published()
    if newest:
        return newest
    run = warehouse.start()
    for table in mart.dims:
        seeded = table is contracts.DIM_STAGE
        run.write(table, seeds.stage_seed(spark).select(*table.names) if seeded else warehouse.nothing(table))
    return run.publish()


def run(
    spark: SparkSession,
    mart: Mart,
    settings: Mapping[str, str] | None = None,
    mode: str = "upsert",
    **overrides,
) -> LoadReport:
    """From settings to a finished load: create the mart if need be, read the raw table that the
    settings name (a catalog table, or files with ``RAW_PATH``, several paths after one another with
    commas between, each with headers of its own), load it, and report."""
    config = MartConfig.from_settings(mart.name, settings, **overrides)
    create(spark, config, mart)
    if config.raw_path:
        raw = [read_raw(spark, path.strip(), config.raw_format, config.raw_ordinal) for path in config.raw_path.split(",")]
    else:
        raw = read_raw(spark, table=config.raw_name, ordinal=config.raw_ordinal)
    return load(spark, config, mart, raw, mode)


def _load_dims(run: Run, mart: Mart, clean: DataFrame) -> dict[str, DataFrame]:
    """Merge and write every dimension. They do not depend on each other, so their jobs overlap."""
    batches = mart.build_dims(clean)

    def write(table: Table) -> DataFrame:
        current, rows = run.current(table), batches[table.name]
        return run.write(table, rows if current is None else upsert(current, rows, table.key, table.policy))

    with ThreadPoolExecutor(len(mart.dims)) as pool:
        written = dict(zip([t.name for t in mart.dims], pool.map(write, mart.dims), strict=True))
    checks.require_none(*[checks.check_rows(written[t.name], t) for t in mart.dims])
    return written


def _load_fact(run: Run, mart: Mart, clean: DataFrame, dims: dict[str, DataFrame], rows: int, first: bool) -> None:
    """Merge the batch of ``rows`` rows into the files that it meets. Its own rows are tested once."""
    table = mart.fact
    batch = mart.build_fact(clean)
    if first:
        tests = checks.not_null_tests(table) + checks.length_tests(table)
        if mart is MARKETING:
            tests += checks.generated_tests()
        checks.require_none(
            checks.check_rows(batch, table, tests),
            checks.check_rows(clean, table, checks.overflow_tests(list(mart.spec.numbers))),
            checks.check_references(batch, table, dims),
        )
    if table.insert_only:
        batch = batch.select("*", *[F.localtimestamp().alias(c) for c in table.insert_only])
    spec = summaries.SPECS[table.name]
    change = run.merge(table, batch, rows, spec.columns, dims)
    _load_summary(run, table, spec, batch, change)


def _load_summary(run: Run, table: Table, spec: summaries.Spec, batch: DataFrame, change: Change) -> None:
    """Add the batch to the report state and take away what it replaces. A fact that was loaded before
    there was a state is summed up once."""
    name, warehouse = summaries.name_of(table), run.warehouse
    folder, parts = run.before.folders.get(run.config.table(name)), run.before.parts.get(run.config.table(table.name), ())
    states = [summaries.summarize(batch, spec)]
    if folder:
        states.append(run.warehouse.spark.read.parquet(folder))
    elif parts:
        states.append(summaries.summarize(warehouse.scan(table, run.manifest.entries(parts)), spec))
    replaced = [] if change.replaced is None else [summaries.summarize(warehouse.spark.read.parquet(change.replaced), spec)]
    run.write_side(name, summaries.combine(spec, states, replaced))


def summary(warehouse: Warehouse, table: Table) -> summaries.Summary:
    """The published report state of a fact."""
    spec, folder = summaries.SPECS[table.name], warehouse.folder(summaries.name_of(table))
    state = warehouse.spark.read.parquet(folder) if folder else summaries.summarize(warehouse.nothing(table), spec)
    return summaries.Summary(spec, state)
