"""Mixing sources to target weights by fitting a word budget exactly.

The size of a document is its number of words. Documents are counted by exact size; per source, a
bounded knapsack over those counts says how many documents of each size the mix takes, and which
ones is decided by a seeded hash. So only counts are ever gathered. A large budget is first met in
proportion to the counts, up to the last ``DP_BUDGET`` words; these are met to the word wherever some
subset of the documents that are left can.

Documents of one size are dealt into ``SLOTS`` slots by hash, and the slots are counted too: whole
slots are taken in order, and only one slot per source and size needs ranking. A source, or a size
of one source, that holds a third of all rows is therefore never sorted in one task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from starmill.llm.tables import staged

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3  # times a document may be taken
SLOTS = 256
DP_BUDGET = 1 << 16  # the knapsack fits the last so many words; all before them go by proportion


def word_count(text: Column) -> Column:
    r"""Number of ``[^\x20\x09-\x0D]+`` in a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, source: str, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Target of every source: (source, source_size, target).

    Sources in code point order, null last, get the weights in turn. All words are shared out by
    weight; no target exceeds ``most`` times the words of its source, and what is above goes to the
    others by weight until none is above. That ends where every target is the smaller of its limit
    and its weight times one common level, which two running sums give directly. The windows see
    one row per source.
    """
    rank = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank - 1) % len(weights) + 1)
    limit = F.col("source_size") * float(most)
    ranked = sizes.withColumn("weight", weight).withColumn("limit", limit)
    ranked = ranked.withColumn("first", F.row_number().over(Window.orderBy(F.col("limit") / F.col("weight"), F.col(source).asc_nulls_last())))
    before = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    spent = F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (F.sum("source_size").over(everything) - spent) / left
    levels = ranked.withColumn("level", level)
    above = F.col("limit") <= F.col("weight") * F.col("level")
    common = F.min(F.when(~above, F.struct("first", "level"))).over(everything)["level"]
    return levels.withColumn("common", common).select(
        source, "source_size", F.when(above, F.col("limit")).otherwise(F.col("weight") * F.col("common")).alias("target")
    )


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int, dp_budget: int = DP_BUDGET) -> np.ndarray:
    """How many documents of each size to take so that their words come to ``budget``, or next to it.

    First the same share of every size, rounded down, then further documents from long to short
    while more than ``dp_budget`` words are missing; a bounded knapsack fits the rest exactly.
    """
    sizes, counts = sizes.astype(np.int64), counts.astype(np.int64)
    taken = np.zeros(len(sizes), np.int64)
    total = int((sizes * counts).sum())
    if budget <= 0 or not total:
        return taken
    if budget >= total:
        return counts.copy()
    taken = np.array([int(c) * budget // total for c in counts], np.int64)
    missing = budget - int((sizes * taken).sum())
    long_first = np.argsort(-sizes, kind="stable")
    for i in long_first:
        if missing <= dp_budget:
            break
        if sizes[i]:
            more = min(int(counts[i] - taken[i]), (missing - dp_budget // 2) // int(sizes[i]))
            taken[i] += max(more, 0)
            missing -= max(more, 0) * int(sizes[i])
    return taken + _knapsack(sizes, counts - taken, missing)


def _knapsack(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded subset sum nearest to ``budget``: reachable sums, and by which bundle each was first reached."""
    used = np.zeros(len(sizes), np.int64)
    if budget <= 0:
        return used
    span = budget + int(min(sizes.max(initial=0), budget))
    by = np.full(span + 1, -1, np.int32)
    by[0] = 0
    bundles = [(0, 0)]
    for i in np.argsort(-sizes, kind="stable"):
        size, free, bundle = int(sizes[i]), int(counts[i]), 1
        free = min(free, span // size) if size else 0
        while free and by[budget] < 0:
            bundle = min(bundle, free)
            weight = bundle * size
            if weight > span:
                break
            new = (by[: span + 1 - weight] >= 0) & (by[weight:] < 0)
            by[weight:][new] = len(bundles)
            bundles.append((int(i), bundle))
            free, bundle = free - bundle, bundle * 2
        if by[budget] >= 0:
            break
    reached = np.flatnonzero(by >= 0)
    at = int(reached[np.argmin(np.abs(reached - budget))])
    while at:
        i, bundle = bundles[by[at]]
        used[i] += bundle
        at -= bundle * int(sizes[i])
    return used


def _plan(frame: pd.DataFrame) -> pd.DataFrame:
    """Copies of every document and number of documents with one more, for the sizes of one source."""
    source_size, target = int(frame["source_size"].iloc[0]), float(frame["target"].iloc[0])
    copies = int(target // source_size) if source_size else 0
    rest = round(target - copies * source_size)
    more = fit(frame["size"].to_numpy(), frame["docs"].to_numpy(), rest)
    return frame[["source", "size"]].assign(copies=copies, more=more)


def mix(
    docs: DataFrame,
    carry: list[str],
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    seed: int = 7,
    weights: tuple[float, ...] = WEIGHTS,
) -> DataFrame:
    """For every document ``row``, a struct of the ``carry`` columns, and ``_mix``, a struct of
    size, source_size, target and copies (0 to ``MOST``).

    Null text has no words and is never needed to meet a target, but counts as taken with its
    source's whole copies. Which documents of a size get one more copy depends on the seed, the id
    and the text alone; rows equal in all three may stand for each other. Without documents, or
    without words, all targets are 0.
    """
    key = F.xxhash64(F.lit(seed), F.col(f"`{doc_id}`"), F.col(f"`{text}`"))
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
        F.col(f"`{source}`").cast("string").alias("source"),
        word_count(F.col(f"`{text}`")).alias("size"),
        key.alias("key"),
    )
    packed = packed.withColumn("slot", F.shiftrightunsigned("key", 56).cast("int"))
    slots = staged(packed.groupBy("source", "size", "slot").agg(F.count("*").alias("docs")), "slots")
    by_size = slots.groupBy("source", "size").agg(F.sum("docs").alias("docs"))
    by_source = by_size.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"))
    goals = staged(targets(by_source, "source", weights), "targets")
    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    wanted = by_size.alias("a").join(goals.alias("b"), same).select("a.*", "source_size", "target")
    plan = wanted.groupBy("source").applyInPandas(_plan, "source string, size long, copies int, more long")
    plan = staged(plan.join(goals.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s"), "plan")
    same = F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.size") == F.col("b.size"))
    filled = F.coalesce(F.sum("docs").over(Window.partitionBy("a.source", "a.size").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edges = slots.alias("a").join(plan.alias("b"), same).select("a.source", "a.size", "slot", "copies", "source_size", "target", (F.col("more") - filled).alias("open"))
    # one text for the source, null or not: the window below then needs no exchange beside the join's
    named = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    group = ["named", "size", "slot"]
    joined = packed.withColumn("named", named).drop("source").join(edges.withColumn("named", named).drop("source"), group)
    place = F.row_number().over(Window.partitionBy(*group).orderBy("key"))
    copies = F.col("copies") + F.when(place <= F.col("open"), 1).otherwise(0)
    return joined.select("row", F.struct("size", "source_size", "target", copies.alias("copies")).alias("_mix"))


def mixed(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", seed: int = 7) -> DataFrame:
    """The documents the mix takes, with a column ``copies`` (how often; 1 to ``MOST``)."""
    out = mix(docs, docs.columns, text, source, doc_id, seed).filter("_mix.copies > 0")
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c != "copies"]
    return out.select(*kept, F.col("_mix.copies").alias("copies"))


def digest(docs: DataFrame, seed: int = 7) -> DataFrame:
    """One row per document: its size, its source's size and target, and the words taken of it."""
    out = mix(docs, ["doc_id"], seed=seed)
    taken = (F.col("_mix.size") * F.col("_mix.copies")).cast("long").alias("taken")
    return out.select("row.doc_id", "_mix.size", "_mix.source_size", "_mix.target", taken)
