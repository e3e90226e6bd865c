"""Row ids, intermediate tables and bucketed copies that the operators of this package share."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill.sources import shared

ROW = "row_id"
REST = "rest"
TEXT = "text"


# Folders of intermediate tables, and their names in the catalog if they have one, by application: those
# that the running stage makes, and those the stage before it left.
_making: dict[str, list[tuple[str, str | None]]] = {}
_left: dict[str, list[tuple[str, str | None]]] = {}


@contextmanager
def stage(spark: SparkSession):
    """One stage of a chain in which every result is written before the next stage begins.

    What the stage before needed for its result is deleted first; what is made inside is remembered
    for the next. Tables made outside of stages are never touched.
    """
    app = spark.sparkContext.applicationId
    for path, table in _left.pop(app, []):
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        shared.discard(spark, path)
    _making[app] = []
    try:
        yield
    finally:
        _left[app] = _making.pop(app)


def _new_path(spark: SparkSession, name: str, table: str | None = None) -> str:
    path = shared.new_path(spark, name)
    if (made := _making.get(spark.sparkContext.applicationId)) is not None:
        made.append((path, table))
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = _new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, text: str) -> DataFrame:
    """``row_id``, the text, and all other columns inside one struct, so that no name can clash.

    Row ids are unique per row of one evaluation; stage the result before using them twice.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c != text]
    rest = F.struct(*others) if others else F.struct(F.lit(True).alias("none"))
    return df.select(F.monotonically_increasing_id().alias(ROW), F.col(f"`{text}`").alias(TEXT), rest.alias(REST))


def restored(df: DataFrame, columns: list[str], text: str, value=None) -> list:
    """Select list that gives back the original columns, with ``value`` as the text if given."""
    new = F.col(TEXT) if value is None else value
    return [new.alias(c) if c == text else F.col(REST).getField(c).alias(c) for c in columns]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """A copy bucketed by ``key``: any number of later joins on it move only their other side."""
    spark = df.sparkSession
    table, buckets = f"starmill_{name}_{uuid.uuid4().hex}", partitions(spark)
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).option("compression", "zstd")
    writer.option("path", _new_path(spark, name, table)).format("parquet").saveAsTable(table)
    return spark.table(table)


def spread_join(many: DataFrame, once: DataFrame, key: list[str]) -> DataFrame:
    """Left join of a staged table with one that holds every key once, however frequent a key is.

    Keys with more than a ``1 / (4 * partitions)`` of the rows are joined from a broadcast table,
    which therefore holds at most ``4 * partitions`` rows; all others meet in an exchange.
    """
    spark = many.sparkSession
    most = many.count() // (4 * partitions(spark)) + 1
    counts = many.groupBy(*key).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > most)
    frequent = staged(counts.drop("_rows").join(once, key, "left").withColumn("_frequent", F.lit(True)), "frequent")
    if frequent.isEmpty():
        return many.join(once, key, "left")
    met = many.join(F.broadcast(frequent), key, "left")
    rest = met.filter("_frequent IS NULL").select(*many.columns).join(once, key, "left")
    return met.filter("_frequent").drop("_frequent").unionByName(rest)
