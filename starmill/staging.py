"""Tables the registered queries share, written once per session and state of the input files.

The wide raw tables stand for the staging area a load starts from. The clean frames are what a load
makes before it builds dimensions and facts: parsed rows, and bitmaps of those that are clean. Both live in the shared folder, so losing an executor
loses nothing, and every query reads only its own columns of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill.operators import cleaning
from starmill.sources import shared, testdata

SALES_TABLES = ("lineitem", "orders", "customer", "nation", "region", "part")
MARKETING_TABLES = ("events",)
DELIVERY = "_delivery"

_written: dict[tuple, DataFrame] = {}


def _once(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    tables: tuple[str, ...],
    build: Callable[[str], DataFrame],
) -> DataFrame:
    state = tuple(shared.state_of(spark, f"{sf_dir}/{t}.parquet") for t in tables)
    key = (spark.conf.get("spark.app.id"), sf_dir, name, state)
    if key not in _written:
        _written[key] = build(shared.new_path(spark, name))
    return _written[key]


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales_by_delivery(spark, sf_dir).drop(DELIVERY)


def raw_marketing(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(path: str) -> DataFrame:
        return shared.materialize(testdata.raw_marketing(spark, sf_dir), path)

    return _once(spark, sf_dir, "raw-marketing", MARKETING_TABLES, build)


def sales_deliveries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both deliveries, each a folder of the staged raw table."""
    staged = _sales_by_delivery(spark, sf_dir)
    return tuple(staged.filter(F.col(DELIVERY) == name).drop(DELIVERY) for name in testdata.DELIVERIES)


def sales_files(spark: SparkSession, sf_dir: str) -> tuple[str | DataFrame, ...]:
    """Folders of the staged files of both deliveries; a delivery without a row has none and is given as rows."""
    files = _sales_by_delivery(spark, sf_dir).inputFiles()
    folders = {f.rsplit("=", 1)[-1].split("/")[0]: f.rsplit("/", 1)[0] for f in files}
    rows = sales_deliveries(spark, sf_dir)
    return tuple(folders.get(name, own) for name, own in zip(testdata.DELIVERIES, rows, strict=True))


def all_sales_files(spark: SparkSession, sf_dir: str) -> str | DataFrame:
    """Folder of the staged files of all raw rows; a table without a row is given as rows."""
    files = _sales_by_delivery(spark, sf_dir).inputFiles()
    return files[0].rsplit("/", 2)[0] if files else raw_sales(spark, sf_dir)


def _sales_by_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw sales table, staged once, with a folder of files for each delivery."""

    def build(path: str) -> DataFrame:
        raw = testdata.raw_sales(spark, sf_dir).withColumn(DELIVERY, testdata.delivery())
        return shared.materialize(raw, path, by=DELIVERY)

    return _once(spark, sf_dir, "raw-sales", SALES_TABLES, build)


def _clean(spark: SparkSession, raw: DataFrame, spec: cleaning.CleanSpec, path: str) -> DataFrame:
    """As a load does it: parse into a table, then keep the last complete row of each order."""
    parsed = cleaning.parse(cleaning.spread(spec.canonicalize(raw)), spec)
    complete, _ = cleaning.split(parsed, f"{path}/parsed")
    return cleaning.staged_last_of(complete, f"{path}/last")


def clean_sales(spark: SparkSession, sf_dir: str, part: str = "all") -> DataFrame:
    """Clean sales rows of all raw rows, or of the ``early`` or ``late`` delivery."""

    def build(path: str) -> DataFrame:
        if part == "all":
            raw = raw_sales(spark, sf_dir)
        else:
            raw = sales_deliveries(spark, sf_dir)[part == "late"]
        return _clean(spark, raw, cleaning.REVENUE, path)

    return _once(spark, sf_dir, f"clean-sales-{part}", SALES_TABLES, build)


def clean_marketing(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(path: str) -> DataFrame:
        return _clean(spark, raw_marketing(spark, sf_dir), cleaning.MARKETING, path)

    return _once(spark, sf_dir, "clean-marketing", MARKETING_TABLES, build)
