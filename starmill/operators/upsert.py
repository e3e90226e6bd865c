"""Merge of a batch into existing rows.

Both sides hold each key at most once, so no join here can multiply rows or meet a hot key. No
side is broadcast by hint: Spark broadcasts the batch's keys where their size allows, and then the
existing rows are not shuffled at all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def upsert(
    current: DataFrame,
    incoming: DataFrame,
    key: str,
    policy: str = "update",
    insert_only: tuple[str, ...] = (),
) -> DataFrame:
    """Existing rows after a batch.

    ``update``: a key in the batch takes all its columns from the batch, NULLs included, but for
    ``insert_only`` columns, which keep the value they were inserted with.
    ``ignore``: existing rows stay as they are.
    ``keep_first``: existing values stay, their NULLs are filled from the batch.
    """
    if policy == "update":
        return _update(current, incoming, key, insert_only)
    if policy == "ignore":
        return current.unionByName(incoming.join(current.select(key), key, "left_anti"))
    if policy == "keep_first":
        return _keep_first(current, incoming, key)
    raise ValueError(f"unknown policy: {policy}")


def _update(current: DataFrame, incoming: DataFrame, key: str, insert_only: tuple[str, ...]) -> DataFrame:
    untouched = current.join(incoming.select(key), key, "left_anti")
    if insert_only:
        kept = current.select(key, *[F.col(c).alias(f"_kept_{c}") for c in insert_only])
        columns = [
            F.coalesce(f"_kept_{c}", c).alias(c) if c in insert_only else F.col(c) for c in incoming.columns
        ]
        incoming = incoming.join(kept, key, "left").select(*columns)
    return untouched.unionByName(incoming)


def _keep_first(current: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    columns = [c for c in current.columns if c != key]
    new = incoming.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    merged = current.join(new, key, "full_outer")
    return merged.select(key, *[F.coalesce(c, f"_new_{c}").alias(c) for c in columns])


def changed(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Keys whose row differs between two states, NULL-safe; used to show a rerun changes nothing."""
    columns = [c for c in before.columns if c != key]
    new = after.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_after"))
    old = before.withColumn("_before", F.lit(True))
    differs = [~F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in columns]
    one_sided = F.col("_before").isNull() | F.col("_after").isNull()
    return old.join(new, key, "full_outer").filter(reduce(Column.__or__, differs, one_sided)).select(key)
