"""Key filters of fact files: which files may hold a key, without reading one key of them.

A filter is a Bloom filter cut into bitmaps of ``BITS`` bits. A key belongs to one bitmap, by its hash,
and sets ``PROBES`` bits there. Filters of a run are one table (file, bucket, bits) sorted by bucket, so
that a lookup reads only the buckets its keys belong to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmill.sources.manifest import Data

BITS = 1 << 15  # what Spark's bitmap functions hold
KEYS = 1 << 11  # keys of a full bitmap, at 16 bits each
PROBES = 6  # about one key in a thousand that a file does not hold passes
FILE, ROW = "_file", "_row"
_BLOCK = "_block"
# Beyond so many keys of a batch some would pass by chance in every file, and nothing is looked up.
LOOKED_UP = 1 << 12


def buckets(rows_per_file: int) -> int:
    return -(-rows_per_file // KEYS)


def _bucket(key: str, n: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(n)).cast("int")


def _bits(key: str) -> list[Column]:
    return [F.pmod(F.xxhash64(F.col(key), F.lit(i)), F.lit(BITS)) for i in range(PROBES)]


def build(keys: DataFrame, key: str, n: int) -> DataFrame:
    """(_file, bucket, bits, first, last, rows) of a table (_file, key): bitmaps, and what a manifest
    needs to know of every bucket's keys."""
    rows = keys.select(FILE, key, _bucket(key, n).alias("bucket"), *[p.alias(f"_bit{i}") for i, p in enumerate(_bits(key))])
    bits = [F.call_function("bitmap_construct_agg", F.col(f"_bit{i}")).alias(f"_bits{i}") for i in range(PROBES)]
    stats = [F.min(key).alias("first"), F.max(key).alias("last"), F.count("*").alias("rows")]
    made = rows.groupBy(FILE, "bucket").agg(*bits, *stats)
    each = made.select(FILE, "bucket", "first", "last", "rows", F.explode(F.array(*[f"_bits{i}" for i in range(PROBES)])).alias("bits"))
    whole = each.groupBy(FILE, "bucket").agg(
        F.call_function("bitmap_or_agg", F.col("bits")).alias("bits"), *[F.first(c).alias(c) for c in ("first", "last", "rows")]
    )
    return whole


def is_set(bits: Column, place: Column) -> Column:
    """Whether a bitmap has the bit at a place."""
    byte = F.conv(F.hex(F.substring(bits, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("getbit", byte, (place % 8).cast("int")) == 1


def may_hold(spark: SparkSession, files: Sequence[Data], keys: DataFrame, key: str, n: int) -> list[Data]:
    """Those files whose filter passes some key; files without a filter stay. At most one name per
    file comes to the driver."""
    tables = sorted({d.filter for d in files if d.filter})
    if not tables:
        return list(files)
    asked = keys.select(_bucket(key, n).alias("bucket"), F.array(*_bits(key)).alias("places"))
    asked = asked.groupBy("bucket").agg(F.collect_list("places").alias("asked"))  # at most LOOKED_UP in all
    wanted = [r.bucket for r in asked.select("bucket").collect()]
    found = spark.read.parquet(*tables).filter(F.col("bucket").isin(wanted)).join(asked, "bucket")
    passes = F.exists("asked", lambda places: F.forall(places, lambda place: is_set(F.col("bits"), place)))
    passed = {r[FILE] for r in found.filter(passes).select(FILE).distinct().collect()}
    return [d for d in files if d.filter is None or d.name in passed]


def mark(places: DataFrame, file: str = FILE) -> DataFrame:
    """Places of rows, a file and a row in it, as bitmaps of ``BITS`` rows of a file. Places are dealt by
    bitmap first, so that each is made once. A bitmap is cut into 64-bit numbers, which are quick to look up."""
    bits = places.select(file, _block(), F.pmod(ROW, F.lit(BITS)).alias("_bit")).repartition(file, _BLOCK)
    made = bits.groupBy(file, _BLOCK).agg(F.call_function("bitmap_construct_agg", F.col("_bit")).alias("_bits"))
    return made.select(file, _BLOCK, F.transform(F.sequence(F.lit(0), F.lit(BITS // 64 - 1)), _word).alias("_bits"))


def _word(i: Column) -> Column:
    """The 64 bits of a bitmap that start at bit ``64 * i``, its first byte the highest."""
    return F.conv(F.hex(F.substring(F.col("_bits"), i * 8 + 1, F.lit(8))), 16, -10).cast("long")


def marked(rows: DataFrame, bitmaps: DataFrame, inside: bool = True) -> DataFrame:
    """Rows with a file and row whose place is marked, or those whose place is not. The rows stay in their
    tasks: the bitmaps are broadcast, at most a bit for each row of the files."""
    joined = rows.withColumn(_BLOCK, _block()).join(F.broadcast(bitmaps), [FILE, _BLOCK], "inner" if inside else "left")
    bit = F.pmod(ROW, F.lit(BITS)).cast("int")
    word = F.get("_bits", F.shiftright(bit, 6))
    # of a word the first byte is the highest: the three upper bits of the place are turned round
    found = F.coalesce(F.call_function("getbit", word, bit.bitwiseAND(63).bitwiseXOR(56)) == 1, F.lit(False))
    return joined.filter(found if inside else ~found).select(*rows.columns)


def _block() -> Column:
    return F.floor(F.col(ROW) / BITS).cast("int").alias(_BLOCK)
