"""Every query by name. Each takes (spark, sf_dir) and works on the whole tables there."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from itertools import zip_longest

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starmill import contracts, staging
from starmill.config import MartConfig
from starmill.contracts import FACT_MARKETING, FACT_SALES
from starmill.functions import numbers
from starmill.operators import checks, cleaning, dimensions, facts
from starmill.operators.upsert import upsert
from starmill.plans import audit, loads, marketing_marts, revenue_marts
from starmill.sources import headers, shared, testdata
from starmill.sources.headers import ORDINAL
from starmill.sources.warehouse import Warehouse
from starmill.staging import clean_marketing, clean_sales

Query = Callable[[SparkSession, str], DataFrame]

# A tighter contract than the declared one, so that the checks have something to find.
TIGHT_LENGTH = 8
TIGHT_MONEY = T.DecimalType(7, 2)


def _raw_sales(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.REVENUE.canonicalize(staging.raw_sales(spark, sf))


def _raw_marketing(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.MARKETING.canonicalize(staging.raw_marketing(spark, sf))


def _sales_fact(spark: SparkSession, sf: str, part: str = "all") -> DataFrame:
    return facts.sales_fact(clean_sales(spark, sf, part))


def _marketing_fact(spark: SparkSession, sf: str) -> DataFrame:
    return facts.marketing_fact(clean_marketing(spark, sf))


# -- headers, cleaning, counts -------------------------------------------------------------------


def sales_canonical(spark: SparkSession, sf: str) -> DataFrame:
    return _raw_sales(spark, sf).drop(ORDINAL)


def marketing_canonical(spark: SparkSession, sf: str) -> DataFrame:
    return _raw_marketing(spark, sf).drop(ORDINAL)


def sales_clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean_sales(spark, sf).drop(ORDINAL, cleaning.OVERFLOW)


def marketing_clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean_marketing(spark, sf).drop(ORDINAL, cleaning.OVERFLOW)


def sales_rejects_by_reason(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.rejects_by_reason(cleaning.parse(_raw_sales(spark, sf), cleaning.REVENUE), cleaning.REVENUE)


def marketing_rejects_by_reason(spark: SparkSession, sf: str) -> DataFrame:
    parsed = cleaning.parse(_raw_marketing(spark, sf), cleaning.MARKETING)
    return cleaning.rejects_by_reason(parsed, cleaning.MARKETING)


def sales_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Every incomplete raw row with what could be read of it and why it was rejected."""
    rejected = cleaning.rejects(cleaning.parse(_raw_sales(spark, sf), cleaning.REVENUE))
    return rejected.select("order_id", "date", "region", "revenue", F.array_join("reasons", ",").alias("reasons"))


def sales_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    parsed = cleaning.parse(_raw_sales(spark, sf), cleaning.REVENUE)
    return cleaning.row_counts(parsed, clean_sales(spark, sf), cleaning.REVENUE)


def marketing_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    parsed = cleaning.parse(_raw_marketing(spark, sf), cleaning.MARKETING)
    return cleaning.row_counts(parsed, clean_marketing(spark, sf), cleaning.MARKETING)


# -- dimensions and facts ------------------------------------------------------------------------


def _revenue_dim(name: str) -> Query:
    return lambda spark, sf: dimensions.revenue_dims(clean_sales(spark, sf))[name]


def _marketing_dim(name: str) -> Query:
    return lambda spark, sf: dimensions.marketing_dims(clean_marketing(spark, sf))[name]


def branch_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.key_conflicts(clean_sales(spark, sf), "branch", "region")


def product_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.key_conflicts(clean_sales(spark, sf), "product", "category")


# -- merging two deliveries ----------------------------------------------------------------------


def upsert_update(spark: SparkSession, sf: str) -> DataFrame:
    return upsert(_sales_fact(spark, sf, "early"), _sales_fact(spark, sf, "late"), "order_id", "update")


def upsert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    return upsert(_sales_fact(spark, sf, "early"), _sales_fact(spark, sf, "late"), "order_id", "ignore")


def upsert_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    return upsert(_sales_fact(spark, sf, "early"), _sales_fact(spark, sf, "late"), "order_id", "keep_first")


def upsert_products(spark: SparkSession, sf: str) -> DataFrame:
    first, second = (dimensions.product_dim(clean_sales(spark, sf, part)) for part in ("early", "late"))
    return upsert(first, second, "product_name", "keep_first")


def _warehouse(spark: SparkSession, mart: str) -> MartConfig:
    return MartConfig(shared.new_path(spark, "warehouse"), mart)


def _deliver(spark: SparkSession, batches: Sequence[DataFrame | str], modes: Sequence[str] = ()) -> Warehouse:
    """Load each batch from settings that name its staged files; a batch that has no files yet is written."""
    root = shared.new_path(spark, "warehouse")
    settings = {"DB_SCHEMA_DWH": root, "RAW_ORDINAL": ORDINAL}
    for batch, mode in zip_longest(batches, modes, fillvalue="upsert"):
        path = batch if isinstance(batch, str) else shared.new_path(spark, "delivery")
        if not isinstance(batch, str):
            batch.write.option("compression", shared.COMPRESSION).parquet(path)
        loads.run(spark, loads.REVENUE, {**settings, "RAW_PATH": path}, mode)
    return Warehouse(spark, MartConfig.from_settings("revenue", settings))


def revenue_load(spark: SparkSession, sf: str) -> DataFrame:
    """Both sales deliveries loaded one after the other, from settings; the published fact."""
    return _deliver(spark, staging.sales_files(spark, sf)).read(FACT_SALES)


def revenue_two_spellings(spark: SparkSession, sf: str) -> DataFrame:
    """Both sales deliveries in one load, the second under other headers in another order."""
    early, late = staging.sales_deliveries(spark, sf)
    paths = []
    for raw in (early, testdata.respelled(late)):
        paths.append(shared.new_path(spark, "delivery"))
        raw.write.option("compression", shared.COMPRESSION).parquet(paths[-1])
    root = shared.new_path(spark, "warehouse")
    settings = {"DB_SCHEMA_DWH": root, "RAW_ORDINAL": ORDINAL, "RAW_PATH": ",".join(paths)}
    loads.run(spark, loads.REVENUE, settings)
    return Warehouse(spark, MartConfig.from_settings("revenue", settings)).read(FACT_SALES)


def missing_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Required columns that staged tables have no header for: the sales table read by the rules of
    either mart, as it is and without two of its columns."""
    whole = staging.raw_sales(spark, sf)
    found = []
    for name, raw in (("raw_sales", whole), ("cut_sales", whole.drop("ngay", "Vung"))):
        for mart in (loads.REVENUE, loads.MARKETING):
            lacking = headers.refused(raw, mart.spec.aliases, mart.spec.required)
            found.append(lacking.select(F.lit(name).alias("staged"), F.lit(mart.name).alias("mart"), "column", "n_rows"))
    return reduce(DataFrame.unionByName, found)


def revenue_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    """The second delivery loaded into a mart that starts anew; the first one is forgotten."""
    return _deliver(spark, staging.sales_files(spark, sf), ("upsert", "rebuild")).read(FACT_SALES)


def revenue_empty_batch(spark: SparkSession, sf: str) -> DataFrame:
    """All sales, then a batch without a row."""
    none = staging.raw_sales(spark, sf).filter(F.lit(False))
    return _deliver(spark, (staging.all_sales_files(spark, sf), none)).read(FACT_SALES)


def upsert_sparse_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Both deliveries with ids scattered over 64 bits, half of them negative."""
    number = numbers.to_order_id(F.col("`Order ID`")).cast("decimal(20,0)")
    spread = F.lit(2862933555777941757).cast("decimal(19,0)")
    prime = F.lit(9223372036854775783).cast("decimal(19,0)")
    sparse = F.pmod(number * spread, prime).cast("long") - F.lit(4611686018427387891)
    batches = [
        raw.withColumn("Order ID", F.coalesce(sparse.cast("string"), "`Order ID`"))
        for raw in staging.sales_deliveries(spark, sf)
    ]
    return _deliver(spark, batches).read(FACT_SALES)


def _loaded_dim(table: contracts.Table) -> Query:
    """A dimension as two loads leave it."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        if table in contracts.REVENUE_DIMS:
            return _deliver(spark, staging.sales_files(spark, sf)).read(table)
        config = _warehouse(spark, "marketing")
        for batch in _event_halves(spark, sf):
            loads.load(spark, config, loads.MARKETING, batch)
        return Warehouse(spark, config).read(table)

    return query


def _event_halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    raw = staging.raw_marketing(spark, sf)
    first = F.col(ORDINAL) % 20 < 10
    return raw.filter(first), raw.filter(~first)


def marketing_load(spark: SparkSession, sf: str) -> DataFrame:
    """The marketing table loaded twice, which must change nothing; the published fact."""
    config = _warehouse(spark, "marketing")
    for _ in range(2):
        loads.load(spark, config, loads.MARKETING, staging.raw_marketing(spark, sf))
    return Warehouse(spark, config).read(FACT_MARKETING).drop("created_at")


def marketing_created_at(spark: SparkSession, sf: str) -> DataFrame:
    """How many orders keep the time they were inserted at when they are loaded again."""
    config = _warehouse(spark, "marketing")
    states = []
    for name in ("created_at", "created_again"):
        loads.load(spark, config, loads.MARKETING, staging.raw_marketing(spark, sf))
        states.append(Warehouse(spark, config).read(FACT_MARKETING).select("order_id", F.col("created_at").alias(name)))
    return states[0].join(states[1], "order_id", "full_outer").agg(
        F.count("*").alias("n_orders"),
        F.count_if(F.col("created_at") == F.col("created_again")).alias("n_unchanged"),
        F.count_if(F.col("created_at").isNull() | F.col("created_again").isNull()).alias("n_missing"),
    )


# -- constraints ---------------------------------------------------------------------------------


def pk_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Order ids that complete raw rows carry more than once, before deduplication."""
    parsed = cleaning.parse(_raw_sales(spark, sf), cleaning.REVENUE).filter(cleaning.COMPLETE)
    return checks.check_unique(parsed, "order_id")


def not_null_violations(spark: SparkSession, sf: str) -> DataFrame:
    """NOT NULL of the fact, on parsed rows before incomplete ones are dropped."""
    parsed = cleaning.parse(_raw_sales(spark, sf), cleaning.REVENUE)
    rows = facts.to_fact(parsed, FACT_SALES)
    return checks.check_rows(rows, FACT_SALES, checks.not_null_tests(FACT_SALES))


def length_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Texts over a tightened length limit."""
    texts = [c.name for c in FACT_SALES.columns if c.max_length]
    tight = [("max_length", c, f"char_length({c}) > {TIGHT_LENGTH}") for c in texts]
    return checks.check_rows(_sales_fact(spark, sf), FACT_SALES, tight)


def numeric_overflow(spark: SparkSession, sf: str) -> DataFrame:
    """Raw numbers over a tightened precision."""
    raw = _raw_sales(spark, sf)
    flags = [
        numbers.overflows(F.col(c), numbers.to_num(F.col(c), TIGHT_MONEY)).alias(c) for c in cleaning.REVENUE.numbers
    ]
    rows = raw.select(numbers.to_order_id(F.col("order_id")).alias("order_id"), *flags)
    return checks.check_rows(rows, FACT_SALES, [("precision", c, c) for c in cleaning.REVENUE.numbers])


def declared_contract(spark: SparkSession, sf: str) -> DataFrame:
    """The whole contract of the revenue mart over its published tables."""
    mart = _deliver(spark, (staging.all_sales_files(spark, sf),))
    dims = {t.name: mart.read(t) for t in contracts.REVENUE_DIMS}
    return checks.audit(mart.read(FACT_SALES), FACT_SALES, dims, contracts.REVENUE_DIMS)


def kept_contract(spark: SparkSession, sf: str) -> DataFrame:
    """The same contract audited after each of two loads; the second audit reads what the second load wrote."""
    mart = _audited_between(spark, sf, lambda mart: audit.audit(mart, loads.REVENUE))
    return audit.audit(mart, loads.REVENUE)


def kept_length_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Texts over a tightened limit, counted file by file as two loads add and replace rows."""
    texts = [c.name for c in FACT_SALES.columns if c.max_length]
    tight = [("max_length", c, f"char_length({c}) > {TIGHT_LENGTH}") for c in texts]

    def found(mart: Warehouse) -> DataFrame:
        dims = {t.name: mart.read(t) for t in contracts.REVENUE_DIMS}
        return audit.Auditor(mart, FACT_SALES, dims, tight).audit().filter("constraint = 'max_length'")

    return found(_audited_between(spark, sf, found))


def _audited_between(spark: SparkSession, sf: str, check: Callable[[Warehouse], DataFrame]) -> Warehouse:
    """Both sales deliveries loaded, with an audit after the first."""
    config = _warehouse(spark, "revenue")
    early, late = staging.sales_deliveries(spark, sf)
    loads.load(spark, config, loads.REVENUE, early)
    check(Warehouse(spark, config))
    loads.load(spark, config, loads.REVENUE, late)
    return Warehouse(spark, config)


def fk_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of all orders that the dimensions of the early delivery do not know."""
    dims = dimensions.revenue_dims(clean_sales(spark, sf, "early"))
    return checks.orphans(_sales_fact(spark, sf), FACT_SALES, dims)


# -- marts ---------------------------------------------------------------------------------------


def _revenue(mart: Callable, *dims: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        clean = clean_sales(spark, sf)
        built = dimensions.revenue_dims(clean)
        return mart(facts.sales_fact(clean), *[built[d] for d in dims])

    return query


def _marketing(mart: Callable, *dims: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        clean = clean_marketing(spark, sf)
        built = dimensions.marketing_dims(clean)
        return mart(facts.marketing_fact(clean), *[built[d] for d in dims])

    return query


REVENUE_MARTS: dict[str, Query] = {
    "revenue_by_region": _revenue(revenue_marts.revenue_by_region),
    "region_branch_rollup": _revenue(revenue_marts.region_branch_rollup),
    "revenue_by_category_product": _revenue(revenue_marts.revenue_by_category_product, "dim_product"),
    "top_products_per_category": _revenue(revenue_marts.top_products_per_category, "dim_product"),
    "revenue_by_channel": _revenue(revenue_marts.revenue_by_channel),
    "revenue_by_segment": _revenue(revenue_marts.revenue_by_segment),
    "revenue_by_promotion": _revenue(revenue_marts.revenue_by_promotion),
    "monthly_trend": _revenue(revenue_marts.monthly_trend, "dim_date"),
    "calendar_rollup": _revenue(revenue_marts.calendar_rollup, "dim_date"),
    "kpi_totals": _revenue(revenue_marts.kpi_totals),
}

MARKETING_MARTS: dict[str, Query] = {
    "stage_funnel": _marketing(marketing_marts.stage_funnel, "dim_stage"),
    "channel_effectiveness": _marketing(marketing_marts.channel_effectiveness, "dim_channel"),
    "channel_type_effectiveness": _marketing(marketing_marts.channel_type_effectiveness, "dim_channel"),
    "campaign_performance": _marketing(marketing_marts.campaign_performance, "dim_campaign"),
    "campaign_type_performance": _marketing(marketing_marts.campaign_type_performance, "dim_campaign"),
    "target_vs_actual": _marketing(marketing_marts.target_vs_actual, "dim_date"),
    "campaign_roi": _marketing(marketing_marts.campaign_roi),
    "cost_breakdown": _marketing(marketing_marts.cost_breakdown),
    "operations_summary": _marketing(marketing_marts.operations_summary),
    "market_metrics": _marketing(marketing_marts.market_metrics, "dim_date"),
}

def _kept(mart: loads.Mart, report: Callable, *dims: contracts.Table) -> Query:
    """A report from the state that two loads keep, without a row of the fact."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        if mart is loads.REVENUE:
            warehouse = _deliver(spark, staging.sales_files(spark, sf))
        else:
            config = _warehouse(spark, mart.name)
            for batch in _event_halves(spark, sf):
                loads.load(spark, config, mart, batch)
            warehouse = Warehouse(spark, config)
        return report(loads.summary(warehouse, mart.fact), *[warehouse.read(d) for d in dims])

    return query


KEPT_MARTS: dict[str, Query] = {
    "kept_revenue_by_region": _kept(loads.REVENUE, revenue_marts.revenue_by_region),
    "kept_top_products_per_category": _kept(loads.REVENUE, revenue_marts.top_products_per_category, contracts.DIM_PRODUCT),
    "kept_calendar_rollup": _kept(loads.REVENUE, revenue_marts.calendar_rollup, contracts.DIM_DATE),
    "kept_kpi_totals": _kept(loads.REVENUE, revenue_marts.kpi_totals),
    "kept_stage_funnel": _kept(loads.MARKETING, marketing_marts.stage_funnel, contracts.DIM_STAGE),
    "kept_target_vs_actual": _kept(loads.MARKETING, marketing_marts.target_vs_actual, contracts.DIM_DATE),
    "kept_cost_breakdown": _kept(loads.MARKETING, marketing_marts.cost_breakdown),
    "kept_operations_summary": _kept(loads.MARKETING, marketing_marts.operations_summary),
}

QUERIES: dict[str, Query] = {
    "sales_canonical": sales_canonical,
    "marketing_canonical": marketing_canonical,
    "clean_sales": sales_clean,
    "clean_marketing": marketing_clean,
    "sales_rejects_by_reason": sales_rejects_by_reason,
    "marketing_rejects_by_reason": marketing_rejects_by_reason,
    "sales_rejects": sales_rejects,
    "sales_row_counts": sales_row_counts,
    "marketing_row_counts": marketing_row_counts,
    "dim_date": _revenue_dim("dim_date"),
    "dim_region": _revenue_dim("dim_region"),
    "dim_branch": _revenue_dim("dim_branch"),
    "dim_product": _revenue_dim("dim_product"),
    "dim_channel": _revenue_dim("dim_channel"),
    "dim_segment": _revenue_dim("dim_customer_segment"),
    "dim_promotion": _revenue_dim("dim_promotion"),
    "marketing_dim_date": _marketing_dim("dim_date"),
    "marketing_dim_segment": _marketing_dim("dim_customer_segment"),
    "dim_stage": _marketing_dim("dim_stage"),
    "dim_channel_typed": _marketing_dim("dim_channel"),
    "dim_campaign": _marketing_dim("dim_campaign"),
    "dim_department": _marketing_dim("dim_department"),
    "dim_machine": _marketing_dim("dim_machine"),
    "dim_information": _marketing_dim("dim_information"),
    "branch_conflicts": branch_conflicts,
    "product_conflicts": product_conflicts,
    "fact_sales": _sales_fact,
    "fact_marketing": _marketing_fact,
    "upsert_update": upsert_update,
    "upsert_ignore": upsert_ignore,
    "upsert_keep_first": upsert_keep_first,
    "upsert_products": upsert_products,
    "upsert_sparse_ids": upsert_sparse_ids,
    "revenue_load": revenue_load,
    "revenue_two_spellings": revenue_two_spellings,
    "missing_headers": missing_headers,
    "revenue_rebuild": revenue_rebuild,
    "revenue_empty_batch": revenue_empty_batch,
    "loaded_dim_branch": _loaded_dim(contracts.DIM_BRANCH),
    "loaded_dim_product": _loaded_dim(contracts.DIM_PRODUCT),
    "loaded_dim_stage": _loaded_dim(contracts.DIM_STAGE),
    "loaded_dim_campaign": _loaded_dim(contracts.DIM_CAMPAIGN),
    "marketing_created_at": marketing_created_at,
    "marketing_load": marketing_load,
    "pk_duplicates": pk_duplicates,
    "not_null_violations": not_null_violations,
    "length_violations": length_violations,
    "numeric_overflow": numeric_overflow,
    "declared_contract": declared_contract,
    "kept_contract": kept_contract,
    "kept_length_violations": kept_length_violations,
    "fk_orphans": fk_orphans,
    **REVENUE_MARTS,
    **MARKETING_MARTS,
    **KEPT_MARTS,
}
