"""Merkle manifest of a table, with proofs by a butterfly exchange.

Rows are leaves of one tree per group (a language, say), ordered by key; the roots of the groups are
the leaves of one more tree. Every ``FANOUT`` neighbouring nodes become their hash, the last run of a
level too if it is shorter.

1. Leaves get their place in their group by a range sort (``sequences``), and every ``BLOCK`` of them
   become one packed row, aligned to the fanout. A task reduces a block to its root.
2. Block roots go on by a butterfly: in round r the blocks that differ in digit r of their number
   alone (base ``FANOUT``) meet, and each takes the roots of all, which are its next siblings, and
   hashes their parent itself. After as many rounds as there are digits every block has the whole
   way up to its group's root, and nothing has to come down again. Where the last subtree of a run
   lacks a block with the same lower digits, its blocks serve the others in turn.
3. Each block reads its own way up once and gives the proofs of its leaves.

A message is one digest; a block gets at most ``FANOUT`` of them in a round, however large its group
is. Rows moved in a round are ``FANOUT`` times the blocks, that is a sixty-fourth of the leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starmill.llm.sequences import AT, running
from starmill.llm.tables import spread_join, staged

FANOUT = 8
HEIGHT = 3  # levels of a tree inside a block
BLOCK = FANOUT**HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HEX = 64
PATH = "array<struct<left:string,right:string>>"


def leaf_of(values: Sequence[Column]) -> Column:
    """SHA-256 over the values, each ``-`` if null, else its UTF-8 length, ``:`` and itself."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to; how a reader checks a row against the manifest."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def _levels(leaves: list[str], alone: bool) -> list[list[str]]:
    """Nodes of a block level by level: up to a single one, or all levels of a block among others."""
    levels = [leaves]
    while len(levels[-1]) > 1 if alone else len(levels) <= HEIGHT:
        nodes = levels[-1]
        levels.append([_sha("".join(nodes[i : i + FANOUT])) for i in range(0, len(nodes), FANOUT)])
    return levels


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The root of each block, as the only one of its tree and as one of several."""
    for batch in batches:
        found = batch.column(2).to_pylist()
        tops = [[_levels(leaves, alone)[-1][0] for leaves in found] for alone in (True, False)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, tops)], names=["tree", "block", "short", "full"])


def _butterfly(state: DataFrame, most: int) -> DataFrame:
    """Blocks ``(tree, block, n, digest)`` of trees with at most ``most`` blocks; ``digest`` becomes
    the tree's root, and ``path`` has the siblings on the way there."""
    state, width = state.withColumn("path", F.array().cast(PATH)), 1
    while width < most:
        number = F.floor(F.col("block") / width).cast("long")  # of the subtree of this round
        digit, low = number % FANOUT, F.col("block") % width
        size = F.least(F.lit(width).cast("long"), F.col("n") - number * width)
        # a first subtree that is not full is the only one of its run, and has nobody else to serve
        served = F.when(digit == 0, F.array(low)).otherwise(F.sequence(low, F.lit(width - 1).cast("long"), size))
        sent = state.filter(F.col("n") > width).withColumn("meet", F.explode(served))
        own = F.struct("block", "path")
        message = F.struct(digit.alias("digit"), "digest", F.when(F.col("meet") == low, own).alias("own"))
        run = F.floor(number / FANOUT).alias("run")
        met = sent.select("tree", "n", run, "meet", message.alias("sent")).groupBy("tree", "n", "run", "meet")
        met = met.agg(F.sort_array(F.collect_list("sent")).alias("nodes"))  # at most FANOUT
        met = met.withColumn("digest", F.sha2(F.array_join(F.col("nodes.digest"), ""), 256)).withColumn("me", F.explode("nodes"))
        before = F.filter("nodes", lambda x: x["digit"] < F.col("me.digit"))["digest"]
        after = F.filter("nodes", lambda x: x["digit"] > F.col("me.digit"))["digest"]
        step = F.struct(F.array_join(before, "").alias("left"), F.array_join(after, "").alias("right"))
        up = met.filter("me.own IS NOT NULL").select(
            "tree", F.col("me.own.block").alias("block"), "n", "digest", F.concat("me.own.path", F.array(step)).cast(PATH).alias("path")
        )
        state = staged(state.filter(F.col("n") <= width).select(*up.columns).unionByName(up), "round")
        width *= FANOUT
    return state


def _trees(leaves: DataFrame, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Packed blocks of leaves ``(tree, key, leaf, shown)``, and the ways from their roots up."""
    placed = running(leaves, ["tree"], order)
    block = F.floor(F.col(AT) / BLOCK).cast("long").alias("block")
    rows = F.sort_array(F.collect_list(F.struct(AT, "key", "leaf", "shown")))  # at most BLOCK
    packed = placed.groupBy("tree", block).agg(rows.alias("rows"))
    blocks = staged(packed.select("tree", "block", *[F.col(f"rows.{c}").alias(c) for c in ("leaf", "shown", "key")]), "blocks")
    tops = blocks.select("tree", "block", "leaf").mapInArrow(_tops, "tree string, block long, short string, full string")
    tops = staged(tops, "tops")
    sizes = staged(tops.groupBy("tree").agg((F.max("block") + 1).alias("n")), "sizes")
    most = sizes.agg(F.max("n")).first()[0] or 0
    digest = F.when(F.col("n") == 1, F.col("short")).otherwise(F.col("full")).alias("digest")
    state = spread_join(tops, sizes, ["tree"]).select("tree", "block", "n", digest)
    return blocks, staged(_butterfly(state, most), "ways")


def _expand(with_path: bool):
    """Each leaf of a block with its proof, and what the shown leaf leads to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                one = batch.slice(i, 1)
                leaves, shown = (one.column(c)[0].as_py() for c in (0, 1))
                n, root, subroot = (one.column(c)[0].as_py() for c in (3, 4, 5))
                above = [(s["left"], s["right"]) for s in one.column(6)[0].as_py()]
                levels = _levels(leaves, n == 1)
                runs = [["".join(nodes[j : j + FANOUT]) for j in range(0, len(nodes), FANOUT)] for nodes in levels[:-1]]
                rest = "".join(left + right for left, right in above)
                folded: dict[str, str] = {}  # by what the block's own levels lead to
                proofs, roots, paths = [], [], []
                for j, node in enumerate(shown):
                    path, place = [], j
                    for level in runs:
                        siblings, at = level[place // FANOUT], place % FANOUT * HEX
                        path.append((siblings[:at], siblings[at + HEX :]))
                        place //= FANOUT
                    for left, right in path:
                        node = _sha(left + node + right)
                    if node not in folded:
                        up = node
                        for left, right in above:
                            up = _sha(left + up + right)
                        folded[node] = up
                    roots.append(folded[node])
                    proofs.append(_sha("".join(left + right for left, right in path) + rest))
                    if with_path:
                        paths.append([{"left": left, "right": right} for left, right in path + above])
                count = len(leaves)
                columns = [one.column(2).flatten(), pa.array(leaves, pa.string())]
                columns += [pa.array([text] * count, pa.string()) for text in (subroot, root)]
                columns += [pa.array(proofs, pa.string()), pa.array(roots, pa.string()), pa.array([r == root for r in roots])]
                names = ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
                if with_path:
                    columns.append(pa.array(paths, pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))))
                    names.append("path")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _expanded(blocks: DataFrame, ways: DataFrame, with_path: bool) -> DataFrame:
    """``ways``: (tree, block, n, root, subroot, path)."""
    key = blocks.schema["key"].dataType.elementType.simpleString()
    schema = f"key {key}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    columns = ["leaf", "shown", "key", "n", "root", "subroot", "path"]
    return blocks.join(ways, ["tree", "block"]).select(*columns).mapInArrow(_expand(with_path), schema + f", path {PATH}" * with_path)


def proofs(docs: DataFrame, key: str, group: str, leaf: Column, shown: Column | None = None, with_path: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``key, leaf, subroot`` (its group's), ``root``, ``proof_sha256``,
    ``folded_root`` (what the leaf ``shown``, the leaf itself where that is null, leads to with the
    leaf's siblings), ``verified`` (whether that is the root) and, if asked for, ``path`` (the siblings on
    each level, for ``fold``).

    ``leaf`` and ``shown`` are lower-case hex digests over columns of ``docs``. Leaves of a group
    ascend by key, nulls first, equal keys by leaf. A null group comes before all others, which are
    ordered by their bytes; an empty one is a group of its own. Rows that are repeated in every
    respect are leaves of their own and interchangeable. A single leaf is its group's root; a single
    group's root is the root; an empty table gives no row.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))
    other = F.lit(None).cast("string") if shown is None else shown
    leaves = staged(docs.select(tree.alias("tree"), F.col(f"`{key}`").alias("key"), leaf.alias("leaf"), other.alias("shown")), "leaves")
    blocks, ways = _trees(leaves.withColumn("shown", F.coalesce("shown", "leaf")), ["key", "leaf"])
    roots = ways.filter("block = 0").select(F.lit("").alias("tree"), F.col("tree").alias("key"), F.col("digest").alias("leaf"), F.col("digest").alias("shown"))
    top_blocks, top_ways = _trees(staged(roots, "roots"), ["key"])
    top_ways = top_ways.select("tree", "block", "n", F.col("digest").alias("root"), F.col("digest").alias("subroot"), "path")
    top = _expanded(top_blocks, top_ways, True).select(F.col("key").alias("tree"), "root", F.col("path").alias("further"))
    ways = spread_join(ways, staged(top, "top"), ["tree"])
    whole = ways.select("tree", "block", "n", "root", F.col("digest").alias("subroot"), F.concat("path", "further").alias("path"))
    return _expanded(blocks, whole, with_path)


def digest(docs: DataFrame) -> DataFrame:
    """Proofs of all documents, some of them shown with their text changed.

    A row whose doc_id has a CRC-32 that 3 divides is shown with A-Z of its text in lower case; a null
    text stays null. Without a doc_id a row has none and is shown as it is.
    """
    lowered = F.translate("text", UPPER, LOWER)
    values = [F.col(c) for c in FIELDS]
    changed = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    shown = F.when(changed, leaf_of([*values[:-1], lowered]))
    out = proofs(docs, "doc_id", "lang", leaf_of(values), shown)
    return out.withColumnRenamed("key", "doc_id")
