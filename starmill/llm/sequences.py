"""Places and running totals of the rows of groups of any size, without a task that sees a group.

Rows are sorted by range, so that a group may lie in any number of neighbouring partitions. Each
partition counts its own rows; what a group's earlier partitions hold is one row per partition, which
is added up on the driver and handed back.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starmill.llm.tables import partitions, staged

AT = "at"
_GROUP, _PART, _SEQ = "_group", "_part", "_seq"


def _own(sums: Sequence[str], xors: Sequence[str]):
    """Adds ``at`` and turns the columns into running ones, counted from where the group's rows of
    this partition begin. A group is known by a 64-bit hash, compared between neighbours only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rows, seen, totals = None, 0, 0, dict.fromkeys([*sums, *xors], np.int64(0))
        for batch in batches:
            if not len(batch):
                continue
            group = batch.column(batch.schema.get_field_index(_GROUP)).to_numpy()
            new = np.r_[last is None or group[0] != last, group[1:] != group[:-1]]
            # row of the batch at which each row's group begins; -1 if before the batch
            begin = np.maximum.accumulate(np.where(new, np.arange(len(group)), -1))
            at = np.where(begin < 0, rows + np.arange(len(group)), np.arange(len(group)) - begin)
            columns = {_SEQ: seen + np.arange(len(group)), AT: at}
            for name in [*sums, *xors]:
                value = batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
                step, undo = (np.add, np.subtract) if name in sums else (np.bitwise_xor, np.bitwise_xor)
                upto = step.accumulate(value)
                before = undo(upto, value)
                columns[name] = np.where(begin < 0, step(upto, totals[name]), undo(upto, before[begin]))
            last, rows, seen = group[-1], int(at[-1]) + 1, seen + len(group)
            totals = {name: columns[name][-1] for name in totals}
            kept = [n for n in batch.schema.names if n not in columns]
            arrays = [batch.column(batch.schema.get_field_index(n)) for n in kept]
            yield pa.RecordBatch.from_arrays([*arrays, *map(pa.array, columns.values())], names=[*kept, *columns])

    return run


def running(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], sums: Sequence[str] = (), xors: Sequence[str] = ()) -> DataFrame:
    """A staged ``df`` with ``at``, the place (from 0) of each row in its group, and with the running
    total, or running exclusive or, of the given long columns (not null), itself included.

    Rows that ``order`` does not tell apart get some order among each other, the same in every use of
    the result, which is a written table. A group or a row that holds a third of all rows is spread
    over partitions like any other rows.
    """
    spark = df.sparkSession
    tied = df.withColumn("_tie", F.monotonically_increasing_id()).withColumn(_GROUP, F.xxhash64(*group))
    keys = [*group, *order, "_tie"]
    dealt = tied.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys).withColumn(_PART, F.spark_partition_id())
    types = {f.name: f.dataType.simpleString() for f in dealt.drop("_tie").schema} | {AT: "bigint", _SEQ: "bigint"}
    names = [n for n in types if n not in (_SEQ, AT, *sums, *xors)] + [_SEQ, AT, *sums, *xors]
    schema = ", ".join(f"`{n}` {types[n]}" for n in names)
    placed = staged(dealt.drop("_tie").mapInArrow(_own(sums, xors), schema), "placed")

    # One row per partition: its first group, and how far its last one got.
    counted = F.struct(_GROUP, AT, *sums, *xors)
    ends = placed.groupBy(_PART).agg(F.min_by(_GROUP, _SEQ).alias("first"), F.max_by(counted, F.col(_SEQ)).alias("last"))
    carried, before = [], None
    for part in sorted(ends.collect(), key=lambda r: r[_PART]):
        total = dict.fromkeys([AT, *sums, *xors], 0)
        if before is not None and before[0] == part["first"]:
            total = before[1]
            carried.append((part[_PART], part["first"], *total.values()))
        own = {AT: part["last"][AT] + 1} | {n: part["last"][n] for n in [*sums, *xors]}
        if part["first"] == part["last"][_GROUP]:
            own = {n: (total[n] ^ v) if n in xors else total[n] + v for n, v in own.items()}
        before = (part["last"][_GROUP], own)
    fields = ", ".join(f"`_more_{n}` long" for n in [AT, *sums, *xors])
    more = spark.createDataFrame(carried, f"`{_PART}` int, `{_GROUP}` long, {fields}")
    added = {n: F.col(n) + F.coalesce(f"_more_{n}", F.lit(0)) for n in [AT, *sums]}
    added |= {n: F.col(n).bitwiseXOR(F.coalesce(f"_more_{n}", F.lit(0).cast("long"))) for n in xors}
    # one row per partition at most
    return placed.join(F.broadcast(more), [_PART, _GROUP], "left").select(*[added.get(n, F.col(f"`{n}`")).alias(n) for n in names if n not in (_PART, _GROUP, _SEQ)])
