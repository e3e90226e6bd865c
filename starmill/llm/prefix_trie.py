"""Prefix trie of conversations by burst tries.

A conversation is a string whose letters are turns; a turn's id is the SHA-256 of its role and text.
``running`` gives every turn its place, the hash of all turns up to it (which names its node of the
trie) and the code points up to it, so no later step has to see a conversation as a whole.

1. Conversations with the same turns become one entry with a weight. Their ids are joined in pieces
   where they lie and hashed as a stream.
2. Entries are suffixes in containers under trie heads. A container is burst by the next turn id while
   it has more than ``CAPACITY`` turns and more than one entry: its head becomes a node and every
   next turn gets a container of its own. A round bursts 1, 2, 4, ... levels, so that long common
   beginnings take few rounds.
3. A container of several entries, ``CAPACITY`` turns at most, is sorted and swept into nodes by the
   common prefixes of neighbours. A container with one entry is a plain path of nodes, however long,
   and needs no sweep.
4. Sums over the subtree of a head come from the entries that pass it, in one aggregation: what a
   container adds is carried by its smallest entry, and a head's text is carried by the smallest
   entry through that head, whose such heads are the lowest ones on its way.

A turn, conversation or first turn that a third of all rows share is one head or one entry; joins on
it go by ``spread_join``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from starmill.llm.sequences import AT, running
from starmill.llm.tables import partitions, spread_join, staged

CAPACITY = 4096  # turns of a container that is swept in one go
LEVELS = 64  # most levels burst in one round
SHARED = 6  # a conversation takes less than this many turns from another one
PIECE = 4096  # ids joined at once
NODE = ["a", "b"]  # the two halves of a node's name
NOBODY = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """Every turn with its place in its conversation: by turn, nulls first, ties by SHA-256 of role and
    text. A null role or text is empty. Rows without a conv_id belong to no conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    name = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.filter("conv_id IS NOT NULL").select("conv_id", "turn", name.alias("name"), F.char_length(text).cast("long").alias("chars"))
    return running(staged(rows, "turns"), ["conv_id"], ["turn", "name"])


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they go into the trie: the first h turns of conversation c - c % 100, then the
    own turns after the first h, with h = crc32(c) % 6.

    Returns (conv_id) and (conv_id, pos, name, chars); a conversation may have no turn left.
    """
    own = staged(turns(conversations), "own")
    shared = F.crc32(F.col("conv_id").cast("string")) % SHARED
    base = F.col("conv_id") - F.col("conv_id") % 100
    found = staged(own.groupBy("conv_id").agg(F.count("*").alias("size"), shared.alias("h"), base.alias("base")), "found")
    sizes = found.select(F.col("conv_id").alias("base"), F.col("size").alias("base_size"))
    taken = F.least("h", F.coalesce("base_size", F.lit(0))).alias("taken")
    plan = staged(found.join(sizes, "base", "left").select("conv_id", "h", "base", taken), "plan")
    after = spread_join(own, plan.select("conv_id", "h", "taken"), ["conv_id"]).filter(F.col(AT) >= F.col("h"))
    after = after.select("conv_id", (F.col("taken") + F.col(AT) - F.col("h")).alias("pos"), "name", "chars")
    # a base has fewer than 200 conversations, and gives each fewer than SHARED turns
    first = own.filter(F.col(AT) < SHARED - 1).select(F.col("conv_id").alias("base"), F.col(AT).alias("pos"), "name", "chars")
    first = first.join(plan, "base").filter("pos < h").select("conv_id", "pos", "name", "chars")
    return plan.select("conv_id"), first.unionByName(after)


def _half(name: str, which: int) -> Column:
    return F.conv(F.substring(name, 1 + 16 * which, 16), 16, -10).cast("long")


def _named(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, a, b, up_a, up_b, chars, upto): the node of every turn, the node above, and the
    code points up to the turn, its own included."""
    own = [F.xxhash64("pos", _half("name", 0), _half("name", 1)), F.xxhash64(_half("name", 2), _half("name", 3), "pos")]
    steps = rows.select("conv_id", "pos", "chars", F.col("chars").alias("upto"), *[x.alias(c) for c, x in zip(("step_a", "step_b"), own)])
    steps = staged(steps.select("*", F.col("step_a").alias("a"), F.col("step_b").alias("b")), "steps")
    named = running(steps, ["conv_id"], ["pos"], ["upto"], NODE)
    up = [F.col(c).bitwiseXOR(F.col(f"step_{c}")).alias(f"up_{c}") for c in NODE]
    return staged(named.select("conv_id", "pos", *NODE, *up, "chars", "upto"), "named")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one sequence's conversations in order, ids joined by commas."""
    for batch in batches:
        if not len(batch):
            continue
        a, b, ids = (batch.column(i).to_numpy() for i in (0, 1, 2))
        texts = pc.cast(batch.column(2), pa.string()).to_pylist()
        new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
        cuts = sorted({*np.flatnonzero(new).tolist(), *range(0, len(a), PIECE)})
        ends = [*cuts[1:], len(a)]
        joined = [",".join(texts[i:j]) for i, j in zip(cuts, ends)]
        first = np.array(cuts)
        columns = [pa.array(x[first]) for x in (a, b, ids)]
        columns += [batch.column(i).take(pa.array(first)) for i in (3, 4)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(np.array(ends) - first), pa.array(joined)], names=["a", "b", "first", "len", "total", "n", "ids"])


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per sequence from its pieces in order; what is kept of them is a running hash."""
    names = ["a", "b", "conv_id", "len", "total", "n", "ends"]
    open_, rows = None, []

    def flush(done: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64()] * 6 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)

    for batch in batches:
        for a, b, first, length, total, n, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if open_ and open_[:2] == [a, b]:
                open_[5] += n
                open_[6].update(b",")
            else:
                if open_:
                    rows.append((*open_[:6], open_[6].hexdigest()))
                open_ = [a, b, first, length, total, n, hashlib.sha256()]
            open_[6].update(ids.encode("ascii"))
        if rows:
            yield flush(rows)
            rows = []
    if open_:
        yield flush([(*open_[:6], open_[6].hexdigest())])


def _entries(ids: DataFrame, named: DataFrame) -> DataFrame:
    """(a, b, conv_id, len, total, n, ends): one row per distinct sequence of turns, with its smallest
    conversation, how many there are, and the SHA-256 of their ids."""
    last = named.groupBy("conv_id").agg(F.max(F.struct("pos", *NODE, "upto")).alias("end"))
    zero = F.lit(0).cast("long")
    whole = ids.join(last, "conv_id", "left").select(
        *[F.coalesce(f"end.{c}", zero).alias(c) for c in NODE],
        "conv_id",
        (F.coalesce("end.pos", F.lit(-1)) + 1).cast("long").alias("len"),
        F.coalesce("end.upto", zero).alias("total"),
    )
    whole, parts = staged(whole, "whole"), partitions(ids.sparkSession)
    dealt = whole.repartitionByRange(parts, *NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    pieces = dealt.mapInArrow(_pieces, "a long, b long, first long, len long, total long, n long, ids string")
    streams = pieces.repartition(parts, *NODE).sortWithinPartitions(*NODE, "first")
    return staged(streams.mapInArrow(_streamed, "a long, b long, conv_id long, len long, total long, n long, ends string"), "entries")


def _burst(paths: DataFrame, capacity: int) -> DataFrame:
    """(conv_id, pos, a, b): the heads that each entry passes, the root left out."""
    heads, depth, levels, open_ = None, 0, 1, None
    while True:
        rows = paths.filter((F.col("pos") >= depth) & (F.col("pos") < depth + levels))
        if open_ is not None:
            rows = rows.join(open_, "conv_id", "left_semi")
        rows = staged(rows.select("conv_id", "pos", *NODE, "len"), "level")
        sizes = rows.groupBy(*NODE).agg(F.sum(F.col("len") - F.col("pos")).alias("turns"), F.count("*").alias("members"))
        large = sizes.filter((F.col("turns") > capacity) & (F.col("members") > 1)).select(*NODE, F.lit(True).alias("large"))
        passed = staged(spread_join(rows, staged(large, "large"), NODE).filter("large").drop("large"), "passed")
        heads = passed.drop("len") if heads is None else heads.unionByName(passed.drop("len"))
        # entries all of whose levels were burst go on below
        open_ = staged(passed.filter((F.col("pos") == depth + levels - 1) & (F.col("len") > F.col("pos") + 1)).select("conv_id"), "open")
        if open_.isEmpty():
            return staged(heads, "heads")
        depth, levels = depth + levels, min(2 * levels, LEVELS)


SWEPT = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, up_a long, up_b long, own_chars long"
)
SWEPT_SCHEMA = pa.schema(
    [(n, pa.int64()) for n in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("ends_sha256", pa.string())]
    + [(n, pa.int64()) for n in ("up_a", "up_b", "own_chars")]
)


class _Node:
    __slots__ = ("chars", "children", "conv", "depth", "ends", "leaves", "n", "parent", "saved", "total")

    def __init__(self, depth: int, chars: int, conv: int, parent: _Node | None):
        self.depth, self.chars, self.conv, self.parent = depth, chars, conv, parent
        self.n = self.children = self.leaves = self.saved = 0
        self.total, self.ends = chars, NOBODY  # code points of the texts of the subtree's nodes


def _close(node: _Node) -> None:
    """All below the node is known: hand its sums to its parent."""
    node.leaves = node.leaves or 1
    node.saved += (node.n - 1) * node.chars
    if above := node.parent:
        above.n += node.n
        above.conv = min(above.conv, node.conv)
        above.children += 1
        above.leaves += node.leaves
        above.saved += node.saved
        above.total += node.total


def _sweep(table: pa.Table) -> pa.Table:
    """Nodes of one container; the top one also has the node above it and the texts below it."""
    columns = {n: table.column(n).to_pylist() for n in table.column_names}
    order = sorted(range(table.num_rows), key=lambda i: (columns["conv_id"][i], columns["pos"][i]))
    entries: dict[int, list[int]] = {}
    for i in order:
        entries.setdefault(columns["conv_id"][i], []).append(i)
    names = {c: [(columns["a"][i], columns["b"][i]) for i in own] for c, own in entries.items()}
    nodes, stack, before = [], [], []
    for conv in sorted(entries, key=names.__getitem__):
        own, rows = names[conv], entries[conv]
        common = 0
        while common < len(before) and common < len(own) and before[common] == own[common]:
            common += 1
        while len(stack) > common:
            _close(stack.pop())
        for i in rows[common:]:
            node = _Node(columns["pos"][i] + 1, columns["chars"][i], conv, stack[-1] if stack else None)
            nodes.append(node)
            stack.append(node)
        end = stack[-1]
        end.n += columns["n"][rows[-1]]
        end.conv = min(end.conv, conv)
        end.ends = columns["ends"][rows[-1]]
        before = own
    while stack:
        _close(stack.pop())
    top = order[0]  # every entry begins with the container's first turn
    out = [
        (x.conv, x.depth, x.parent.conv if x.parent else None, x.n, x.children, x.leaves, x.saved, x.ends)
        + ((None, None, None) if x.parent else (columns["up_a"][top], columns["up_b"][top], x.total))
        for x in nodes
    ]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), SWEPT_SCHEMA)], schema=SWEPT_SCHEMA)


def trie(ids: DataFrame, rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Nodes of the trie of conversations ``ids`` (conv_id) with turns ``rows`` (conv_id, pos from 0
    without gaps, name, chars).

    Per node: ``conv_id`` smallest member, ``depth``, ``parent_conv_id`` (null for the root),
    ``n_convs`` members, ``n_children``, ``n_leaves`` in its subtree, ``saved_tokens`` (over its
    subtree, each node's members but one times the code points of its last text) and ``ends_sha256``
    of the members that end there. Without conversations there is no node, not even a root.
    """
    named = _named(rows)
    entries = _entries(ids, named)
    spread = spread_join(named, entries.select("conv_id", "len", "n", "total"), ["conv_id"])
    paths = staged(spread.filter("n IS NOT NULL"), "paths")
    passed = _burst(paths, capacity)

    # Containers: each entry's turns below its last head.
    below = passed.groupBy("conv_id").agg(F.count("*").alias("heads"))
    placed = staged(entries.join(below, "conv_id", "left").withColumn("heads", F.coalesce("heads", F.lit(0))), "placed")
    rest = spread_join(paths, placed.select("conv_id", "heads", "ends"), ["conv_id"]).filter("pos >= heads")
    rest = staged(rest.withColumn("ends", F.when(F.col("pos") + 1 == F.col("len"), F.col("ends"))), "rest")
    tops = staged(rest.filter("pos = heads").select("conv_id", F.col("a").alias("top_a"), F.col("b").alias("top_b")), "tops")
    several = tops.groupBy("top_a", "top_b").agg(F.count("*").alias("members")).filter("members > 1")
    several = staged(tops.join(several, ["top_a", "top_b"]).drop("members"), "several")
    shared = spread_join(rest, several, ["conv_id"])
    swept = shared.filter("top_a IS NOT NULL").select("top_a", "top_b", "conv_id", "pos", *NODE, "up_a", "up_b", "chars", "n", "ends")
    swept = staged(swept.groupBy("top_a", "top_b").applyInArrow(_sweep, SWEPT), "swept")
    first, last = F.col("pos") == F.col("heads"), F.col("pos") + 1 == F.col("len")
    alone = shared.filter("top_a IS NULL").select(
        "conv_id",
        (F.col("pos") + 1).alias("depth"),
        F.when(~first, F.col("conv_id")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("n") - 1) * (F.col("total") - F.col("upto") + F.col("chars"))).alias("saved_tokens"),
        F.coalesce("ends", F.lit(NOBODY)).alias("ends_sha256"),
        *[F.when(first, F.col(c)).alias(c) for c in ("up_a", "up_b")],
        F.when(first, F.col("total") - F.col("upto") + F.col("chars")).alias("own_chars"),
    )
    low = staged(swept.unionByName(alone), "low")

    # Heads, the root among them, whose name is 0, 0 and which every entry passes.
    zero = F.lit(0).cast("long")
    root = entries.select("conv_id", F.lit(-1).cast("long").alias("pos"), *[zero.alias(c) for c in NODE])
    fields = ["conv_id", "pos", *NODE, "up_a", "up_b", "chars", "upto", "n", "total"]
    inside = paths.select(*fields).join(passed.select("conv_id", "pos"), ["conv_id", "pos"])
    at_root = root.join(entries.select("conv_id", "n", "total"), "conv_id").select(
        "conv_id", "pos", *NODE, F.lit(None).cast("long").alias("up_a"), F.lit(None).cast("long").alias("up_b"), zero.alias("chars"), zero.alias("upto"), "n", "total"
    )
    inside = staged(inside.unionByName(at_root), "inside")
    heads = inside.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.max("pos").alias("pos"), F.max("up_a").alias("up_a"), F.max("up_b").alias("up_b"), F.sum("n").alias("n_convs")
    )
    heads = staged(heads, "head")
    owned = heads.groupBy("conv_id").agg(F.count("*").alias("owned"))
    carried = low.filter("up_a IS NOT NULL").select("conv_id", F.col("n_leaves").alias("leaves"), F.col("own_chars").alias("texts"))
    # the smallest entry of a container is the conversation of its top node
    carriers = placed.select("conv_id", "heads").join(owned, "conv_id", "left").join(carried, "conv_id", "left")
    carriers = staged(carriers.select("conv_id", "heads", *[F.coalesce(c, zero).alias(c) for c in ("owned", "leaves", "texts")]), "carriers")
    loaded = staged(spread_join(inside, carriers, ["conv_id"]), "loaded")
    start = F.col("upto") - F.col("chars")
    borders = loaded.groupBy("conv_id").agg(
        F.max("upto").alias("to"), F.max(F.when(F.col("pos") == F.col("heads") - F.col("owned"), start)).alias("from")
    )
    loaded = spread_join(loaded, staged(borders, "borders"), ["conv_id"])
    own_heads = F.when(F.col("owned") > 0, F.col("to") - F.greatest("from", start)).otherwise(zero)
    sums = loaded.groupBy(*NODE).agg(
        F.sum(F.col("n") * (F.col("total") - start) - F.col("texts") - own_heads).alias("saved_tokens"), F.sum("leaves").alias("leaves")
    )
    children = low.filter("up_a IS NOT NULL").select("up_a", "up_b").unionByName(heads.filter("up_a IS NOT NULL").select("up_a", "up_b"))
    children = children.groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(F.count("*").alias("n_children"))
    ends = placed.filter("len = heads").select(*NODE, "ends")
    above = staged(heads.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("above")), "above")
    high = heads.join(sums, NODE).join(children, NODE, "left").join(ends, NODE, "left").join(above, ["up_a", "up_b"], "left")
    high = high.select(
        "conv_id",
        (F.col("pos") + 1).alias("depth"),
        F.col("above").alias("parent_conv_id"),
        "n_convs",
        F.coalesce("n_children", zero).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(F.col("leaves")).cast("long").alias("n_leaves"),
        "saved_tokens",
        F.coalesce("ends", F.lit(NOBODY)).alias("ends_sha256"),
    )
    top_rows = staged(low.filter("up_a IS NOT NULL").drop("parent_conv_id"), "top_rows")
    under = spread_join(top_rows, above.withColumnRenamed("above", "parent_conv_id"), ["up_a", "up_b"])
    return high.unionByName(under.select(*high.columns)).unionByName(low.filter("up_a IS NULL").select(*high.columns))


def digest(conversations: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The trie of all conversations as ``rebuilt`` makes them."""
    ids, rows = rebuilt(conversations)
    return trie(ids, rows, capacity)
