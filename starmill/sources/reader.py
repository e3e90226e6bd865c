"""Scan of the staged wide table."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill.sources.headers import ORDINAL


def read_raw(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    ordinal: str | None = None,
    table: str | None = None,
    **options: str,
) -> DataFrame:
    """Read a staged table without inferring types and attach the row order later steps rely on.

    ``table`` names a table of the catalog instead of a path. "The last row of an order wins" needs
    an order that survives any split or retry. ``ordinal`` names a column that has it, preferably a
    number or timestamp. Without one, a row's position becomes one number: rank of the file by path,
    then row in the file (Parquet), or place of the block and row in it (text files). A database
    table has no order of its own, so ``fmt="jdbc"`` must name the column; pass ``partitionColumn``,
    ``lowerBound``, ``upperBound`` and ``numPartitions`` in ``options`` to read it in parallel.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if fmt == "json":
        reader = reader.option("primitivesAsString", True)
    reader = reader.options(**options)
    raw = spark.read.table(table) if table else reader.load(path) if path else reader.load()
    if ordinal == ORDINAL:
        return raw
    if ordinal:
        return raw.select("*", F.col(ordinal).alias(ORDINAL))
    return _with_position(raw, "parquet" if table else fmt)


# Bits of a position below the file's rank: rows of a file; bytes before a block, and rows in it.
ROW_BITS, BLOCK_BITS = 40, 44
_FILE = "_file_of_row"


def _with_position(raw: DataFrame, fmt: str) -> DataFrame:
    """One number per row, in order of file and row. The ranks of the files are joined to the rows;
    Spark broadcasts them by their size."""
    if fmt == "parquet":
        within = F.col("_metadata.row_index")
        rank = F.shiftleft("_rank", ROW_BITS)
    elif fmt in ("csv", "json", "text", "orc"):
        wide = "decimal(38,0)"
        row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # rows of this task so far
        within = F.col("_metadata.file_block_start").cast(wide) * F.lit(1 << 33).cast("decimal(11,0)") + row.cast(wide)
        rank = F.col("_rank").cast("decimal(15,0)") * F.lit(str(1 << (33 + BLOCK_BITS))).cast("decimal(24,0)")
    else:
        raise ValueError(f"{fmt} rows have no position of their own; name an ordinal column")
    # the listing and the rows write the local file system's prefix differently
    path = F.regexp_replace("_metadata.file_path", "^file:/+", "/")
    placed = raw.select("*", path.alias(_FILE), within.alias("_within"))
    names = sorted(re.sub("^file:/+", "/", f) for f in raw.inputFiles())
    files = raw.sparkSession.createDataFrame(list(enumerate(names)), f"_rank long, {_FILE} string")
    position = (rank + F.col("_within")).alias(ORDINAL)
    return placed.join(files, _FILE).select(*[f"`{c}`" for c in raw.columns], position)
