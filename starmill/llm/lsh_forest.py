"""Near duplicates by an LSH forest over MinHash signatures.

A text is the set of its distinct word shingles. Its signature has ``HASHES`` minima; two sets of
Jaccard similarity s agree in each with probability s. A tree of the forest is an order of texts by
the signature, read from another place in each tree; texts with a common prefix of some depth are a
region.

1. Texts with equal sets become one node.
2. Every tree is one range sort by the first ``FIRST`` minima and the next few. Neighbours in a region
   are the ones with the longest common prefix: each node's best of them are confirmed on the full
   sets, and links are joined into components.
3. A region all of whose nodes are in one component has nothing left to tell. In the others nodes are
   tried with the region's best-linked one, the likely origin of many copies, for a few rounds.
4. Of regions that are still open those of up to ``CROWD`` nodes give all pairs across components;
   larger ones give their neighbours and are sorted again to the next depth. So depth adapts to each
   region, and what a region costs does not grow with the square of its size.
5. Every depth lowers the chance that a linked pair meets in that tree: with similarity s it is
   s ** depth. All trees together give the chance that a node in crowded regions misses a link; nodes
   for which it rises above ``DOUBT`` are the exception (sets that are close to very many others, but
   not linked), and are compared in blocks, pair by pair, with all nodes outside their component that
   share a region of the first depth with them.

Pairs pass a test on their signatures, which a linked pair fails with less than ``MISS``, before
their texts meet. Without step 5's last part the chance to miss a link is at most 6e-11 for a pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starmill.llm import kernel as K
from starmill.llm.components import components
from starmill.llm.tables import REST, ROW, TEXT, bucketed, numbered, partitions, restored, spread_join, staged

PERCENT = 85
TREES, FIRST = 32, 4
HASHES = TREES * FIRST
DEPTHS = (4, 8, 16)
CROWD = 12  # nodes of a region up to which all its pairs are tried
ROUNDS, WORTH = 4, 20  # rounds with best-linked nodes, while one pair in so many is linked
BEST = 2  # neighbours of a node that are confirmed before the others
BLOCK, TOKENS = 1024, 1 << 20  # nodes, or tokens, compared with each other in one go, in the last step
MISS = 1e-9  # chance that a linked pair fails the test on signatures
DOUBT = 1e-6  # largest chance to miss a link that needs no comparison in blocks
U32 = np.uint32


def _least_matches(percent: int, miss: float) -> int:
    """Smallest number of equal minima that sets of this similarity have but with chance ``miss``."""
    s, below = percent / 100, 0.0
    for k in range(HASHES + 1):
        below += math.comb(HASHES, k) * s**k * (1 - s) ** (HASHES - k)
        if below > miss:
            return k
    return HASHES


def _least_size(percent: int) -> int:
    """Sets below this size are linked with equal ones only."""
    return -(-percent // (100 - percent))


def _factors(seed: int) -> np.ndarray:
    return (K.mix(np.arange(1, HASHES + 1, dtype=np.uint64) * K.U(2 * seed + 1)) >> K.U(32)).astype(U32) | U32(1)


SALTS, FACTORS, AGAIN = (_factors(seed) for seed in (101, 211, 307))


def _shingles(piece: K.Texts, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted in it, and where each text's begin: windows of n
    words, or all words of a text with fewer."""
    found = K.words(piece, K.SOLID)
    hashes, text, left = K.word_hashes(piece, found), found.text_of(), found.remaining()
    whole = np.flatnonzero(left >= n)
    values, owners = [K.grams(hashes, n)[whole]], [text[whole]]
    for size in range(1, n):
        short = np.flatnonzero(found.counts() == size)
        values.append(K.grams(hashes, size)[found.bounds[short]])
        owners.append(short)
    value, owner = np.concatenate(values), np.concatenate(owners)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    if len(value):
        new = np.r_[True, (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])]
        value, owner = value[new], owner[new]
    return value, np.searchsorted(owner, np.arange(len(piece) + 1))


def _signatures(value: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """16 bits of each minimum, one row per non-empty set."""
    out = np.zeros((len(starts), HASHES), np.uint16)
    if len(starts):
        short = (K.mix(value) >> K.U(32)).astype(U32)
        for k in range(HASHES):
            h = (short ^ SALTS[k]) * FACTORS[k]
            h ^= h >> U32(15)
            h *= AGAIN[k]
            out[:, k] = ((np.minimum.reduceat(h, starts) * FACTORS[k]) >> U32(16)).astype(np.uint16)
    return out


SETS = "row_id long, n long, set_a long, set_b long, signature binary"
SETS_SCHEMA = pa.schema([("row_id", pa.int64()), ("n", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()), ("signature", pa.binary())])


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in K.texts(batch.column(1)):
                value, bounds = _shingles(piece, n)
                sizes = np.diff(bounds)
                some = np.flatnonzero(sizes)
                signatures = [b""] * len(piece)
                for i, signature in zip(some.tolist(), _signatures(value, bounds[some])):
                    signatures[i] = signature.tobytes()
                sums = []
                for spread in (K.mix(value), K.mix(value ^ K.U(0x5851F42D4C957F2D))):
                    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread, dtype=np.uint64)])
                    sums.append(pa.array(K.signed(total[bounds[1:]] - total[bounds[:-1]])))
                rows = batch.column(0).slice(piece.first, len(piece))
                yield pa.RecordBatch.from_arrays([rows, pa.array(sizes), *sums, pa.array(signatures, pa.binary())], schema=SETS_SCHEMA)

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), HASHES)


ENTRY = "region long, tail long, tree int, row_id long"


def _entries(depth: int):
    """Of each node (row_id, signature, trees) its regions at a depth, and the next four minima."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.slice(at, 4096)
                rows, minima = part.column(0).to_numpy(), _matrix(part.column(1)).astype(np.uint64)
                counts = np.asarray(part.column(2).value_lengths())
                which, tree = np.repeat(np.arange(len(rows)), counts), np.asarray(part.column(2).flatten())
                key = K.mix(tree.astype(np.uint64) + K.U(1 + (depth << 8)))
                for i in range(depth):
                    key = K.mix(key ^ minima[which, (tree * FIRST + i) % HASHES])
                tail = np.zeros(len(tree), np.uint64)
                for i in range(depth, depth + 4):
                    tail = (tail << K.U(16)) | minima[which, (tree * FIRST + i) % HASHES]
                columns = [pa.array(K.signed(key)), pa.array(K.signed(tail)), pa.array(tree, pa.int32()), pa.array(rows[which])]
                yield pa.RecordBatch.from_arrays(columns, names=["region", "tail", "tree", "row_id"])

    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted entries those that share their region, each with the next one in it. The first and the
    last of a partition may share theirs with a neighbouring partition and are kept."""
    held, began = None, True

    def kept(region, tree, row, shares, to) -> pa.RecordBatch:
        new = region[1:] == region[:-1]
        after = np.r_[new, False]
        keep = (shares | after)[:to]
        following = pa.array(np.r_[row[1:], 0][:to][keep], mask=~after[:to][keep])
        return pa.RecordBatch.from_arrays([*(pa.array(a[:to][keep]) for a in (region, tree, row)), following], names=["region", "tree", "row_id", "next"])

    for batch in batches:
        if not len(batch):
            continue
        region, tree, row = (batch.column(i).to_numpy() for i in (0, 2, 3))
        if held is not None:
            region, tree, row = (np.r_[h, a] for h, a in zip(held[:3], (region, tree, row)))
        shares = np.r_[held[3] if held is not None else began, region[1:] == region[:-1]]
        began = False
        if len(region) > 1:
            yield kept(region, tree, row, shares, len(region) - 1)
        held = (region[-1:], tree[-1:], row[-1:], shares[-1])
    if held is not None:
        yield kept(*held[:3], np.array([True]), 1)


def _level(nodes: DataFrame, depth: int) -> DataFrame:
    """(region, tree, row_id, next) of nodes (row_id, signature, trees) that share a region."""
    keys = ["region", "tail", "row_id"]
    entries = nodes.select(ROW, "signature", "trees").mapInArrow(_entries(depth), ENTRY)
    order = entries.repartitionByRange(partitions(nodes.sparkSession), *keys).sortWithinPartitions(*keys)
    return staged(order.mapInArrow(_runs, "region long, tree int, row_id long, next long"), "level")


def _alike(percent: int):
    """Pairs whose sizes and signatures leave a link possible, with the number of equal minima."""
    least = _least_matches(percent, MISS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            equal = (_matrix(batch.column(2)) == _matrix(batch.column(3))).sum(axis=1)
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(equal.astype(np.int32))], names=["x", "y", "equal"])
            yield out.filter(pa.array(equal >= least))

    return run


def _linked(percent: int, n: int):
    """Pairs of texts whose full sets are linked."""

    def sets(column: pa.Array) -> list[np.ndarray]:
        out = []
        for piece in K.texts(column):
            value, bounds = _shingles(piece, n)
            out += [value[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.slice(at, 256)
                keep = []
                for a, b in zip(sets(batch.column(2)), sets(batch.column(3))):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    keep.append(100 * both >= percent * (len(a) + len(b) - both))
                yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


class _Forest:
    """Nodes, their components so far, and how pairs of them are tried."""

    def __init__(self, table: DataFrame, nodes: DataFrame, percent: int, n: int):
        self.table, self.nodes, self.percent, self.n = table, nodes, percent, n
        self.labels = table.sparkSession.createDataFrame([], "node long, label long")
        self.links: list[DataFrame] = []

    def labelled(self, df: DataFrame, row: str, label: str) -> DataFrame:
        own = self.labels.select(F.col("node").alias(row), F.col("label").alias("_label"))
        return df.join(own, row, "left").withColumn(label, F.coalesce("_label", row)).drop("_label")

    def across(self, pairs: DataFrame) -> DataFrame:
        """Pairs (x, y, ...) in different components."""
        named = self.labelled(self.labelled(pairs, "x", "label_x"), "y", "label_y")
        return named.filter("label_x <> label_y").drop("label_x", "label_y")

    def alike(self, pairs: DataFrame) -> DataFrame:
        """Distinct pairs across components that pass the test on signatures, as (x, y, equal)."""
        at_x = self.nodes.select(F.col(ROW).alias("x"), F.col("n").alias("n_x"), F.col("signature").alias("s_x"))
        at_y = self.nodes.select(F.col(ROW).alias("y"), F.col("n").alias("n_y"), F.col("signature").alias("s_y"))
        both = self.across(pairs.distinct()).join(at_x, "x").join(at_y, "y")
        sized = both.filter(F.least("n_x", "n_y") * 100 >= F.greatest("n_x", "n_y") * self.percent)
        return staged(sized.select("x", "y", "s_x", "s_y").mapInArrow(_alike(self.percent), "x long, y long, equal int"), "alike")

    def confirm(self, pairs: DataFrame) -> int:
        """Link the pairs (x, y) whose full sets are alike, and join components; how many were linked."""
        if pairs.isEmpty():
            return 0
        at_x = self.table.select(F.col(ROW).alias("x"), F.col(TEXT).alias("text_x"))
        at_y = self.table.select(F.col(ROW).alias("y"), F.col(TEXT).alias("text_y"))
        met = pairs.select("x", "y").join(at_y, "y").join(at_x, "x").select("x", "y", "text_x", "text_y")
        links = staged(met.mapInArrow(_linked(self.percent, self.n), "x long, y long"), "linked")
        return self.join(links)

    def join(self, links: DataFrame) -> int:
        """Join components by written links (x, y); how many they are."""
        if not (linked := links.count()):
            return 0
        self.links.append(links)
        named = self.labelled(self.labelled(links, "x", "label_x"), "y", "label_y")
        joined = components(named.select(F.col("label_x").alias("x"), F.col("label_y").alias("y")).filter("x <> y"))
        onto = joined.select(F.col("node").alias("label"), F.col("label").alias("onto"))
        moved = spread_join(self.labels, staged(onto, "onto"), ["label"]).select("node", F.coalesce("onto", "label").alias("label"))
        self.labels = staged(moved.unionByName(joined.join(self.labels.select("node"), "node", "left_anti")), "labels")
        return linked

    def best_first(self, pairs: DataFrame) -> None:
        """Confirm each node's best neighbours. What is still across components afterwards is tried with
        the regions."""
        alike = self.alike(pairs)
        sides = alike.select("x", "y", "equal", F.explode(F.array("x", "y")).alias("node"))
        best = F.slice(F.sort_array(F.collect_list(F.struct("equal", F.xxhash64("x", "y"), "x", "y")), asc=False), 1, BEST)
        # a node has two neighbours in a tree
        top = sides.groupBy("node").agg(best.alias("best")).select(F.explode("best").alias("p")).select("p.x", "p.y").distinct()
        self.confirm(staged(top, "best"))

    def open_regions(self, level: DataFrame) -> DataFrame:
        """Members of regions that lie in several components, with label and size of the region. Regions
        with more than a ``1 / (4 * partitions)`` of all rows are joined from a broadcast table, which
        holds at most as many rows as that; the others by an exchange."""
        named = staged(self.labelled(level, ROW, "label"), "named")
        sizes = named.groupBy("region").agg(F.count("*").alias("members"), F.min("label").alias("a"), F.max("label").alias("b"))
        several = staged(sizes.filter("a <> b").select("region", "members"), "several")
        most = named.count() // (4 * partitions(level.sparkSession)) + 1
        large, others = several.filter(F.col("members") > most), several.filter(F.col("members") <= most)
        return staged(named.join(F.broadcast(large), "region").unionByName(named.join(others, "region")), "open")

    def stars(self, level: DataFrame) -> None:
        """Try the nodes of open regions with the best-linked node of each that has not been tried."""
        used = self.table.sparkSession.createDataFrame([], "row_id long, used boolean")
        for _ in range(ROUNDS):
            members = self.open_regions(level)
            if members.isEmpty() or not self.links:
                return
            ends = reduce(DataFrame.union, [links.select(F.explode(F.array("x", "y")).alias(ROW)) for links in self.links])
            degrees = staged(ends.groupBy(ROW).agg(F.count("*").alias("degree")).join(used, ROW, "left").filter("used IS NULL"), "degrees")
            scored = members.join(degrees, ROW)
            lead = scored.groupBy("region").agg(F.max(F.struct("degree", F.xxhash64(ROW), ROW, "label")).alias("lead"))
            lead = staged(lead.select("region", F.col("lead.row_id").alias("lead"), F.col("lead.label").alias("lead_label")), "lead")
            met = spread_join(members.select("region", ROW, "label"), lead, ["region"]).filter("lead_label <> label")
            pairs = staged(met.select(*_pair(ROW, "lead")).distinct(), "stars")
            used = staged(used.unionByName(lead.select(F.col("lead").alias(ROW), F.lit(True).alias("used")).distinct()), "used")
            alike = self.alike(pairs)
            if self.confirm(alike) * WORTH < alike.count():
                return


def _pair(x: str, y: str) -> list:
    return [F.least(x, y).alias("x"), F.greatest(x, y).alias("y")]


def _neighbours(level: DataFrame) -> DataFrame:
    return level.filter("next IS NOT NULL AND next <> row_id").select(*_pair(ROW, "next"))


def _crowded(members: DataFrame) -> DataFrame:
    """All pairs across components of small regions."""
    grouped = members.groupBy("region").agg(F.collect_list(F.struct("row_id", "label")).alias("m"))  # at most CROWD
    one = grouped.select(F.explode("m").alias("p"), "m")
    two = one.select("p", F.explode(F.filter("m", lambda q: (q["row_id"] > F.col("p.row_id")) & (q["label"] != F.col("p.label")))).alias("q"))
    return two.select(F.col("p.row_id").alias("x"), F.col("q.row_id").alias("y"))


def _tokens(n: int):
    """The full set of each text, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in K.texts(batch.column(1)):
                value, bounds = _shingles(piece, n)
                sets = [value[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                rows = batch.column(0).slice(piece.first, len(piece))
                yield pa.RecordBatch.from_arrays([rows, pa.array(sets, pa.binary())], names=["row_id", "tokens"])

    return run


def _blocks(percent: int):
    """Linked pairs across components of two blocks of one region, with a node in doubt at least: those
    that pass the test on signatures are compared on their full sets. A pair that shares a region in
    several trees is left to the first of them."""
    least = _least_matches(percent, MISS)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        tree = table.column("tree")[0].as_py()
        rows, labels = (table.column(c).to_numpy() for c in ("row_id", "label"))
        minima, side = _matrix(table.column("signature").combine_chunks()), table.column("side").to_numpy()
        sets = [np.frombuffer(t, np.uint64) for t in table.column("tokens").to_pylist()]
        sizes, doubtful = np.array([len(t) for t in sets]), np.asarray(table.column("doubtful"))
        left, right = np.flatnonzero(side <= 0), np.flatnonzero(side >= 0)
        x, y = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in left.tolist():
            other = right[(labels[right] != labels[i]) & (doubtful[right] | doubtful[i])]
            equal = minima[other] == minima[i]
            common = equal.reshape(-1, TREES, FIRST).all(axis=2)
            other = other[(equal.sum(axis=1) >= least) & (common.argmax(axis=1) == tree)]
            if not len(other):
                continue
            theirs, own = np.concatenate([sets[j] for j in other.tolist()]), sets[i]
            hit = own[np.minimum(np.searchsorted(own, theirs), len(own) - 1)] == theirs
            both = np.add.reduceat(hit.astype(np.int64), np.cumsum(sizes[other]) - sizes[other])
            other = other[100 * both >= percent * (sizes[i] + sizes[other] - both)]
            x.append(np.minimum(rows[i], rows[other]))
            y.append(np.maximum(rows[i], rows[other]))
        return pa.table({"x": np.concatenate(x), "y": np.concatenate(y)})

    return run


def _all_across(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All linked pairs across components in regions: a task sees two blocks of one region, each of
    about ``BLOCK`` nodes or ``TOKENS`` tokens. ``sets``: (row_id, signature, tokens)."""
    filled = members.join(sets, ROW)
    weights = filled.groupBy("region").agg((F.sum(F.octet_length("tokens")) / (8 * TOKENS)).alias("weight"))
    dealt = filled.join(weights, "region").withColumn("blocks", F.ceil(F.greatest(F.col("members") / BLOCK, "weight")).cast("int"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64(ROW), F.col("blocks")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sides = met.select(
        "region", "tree", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), ROW, "label", "signature", "tokens", "doubtful",
        F.signum(F.col("block") - F.col("other")).cast("int").alias("side"),
    )
    return sides.groupBy("region", "i", "j").applyInArrow(_blocks(percent), "x long, y long").distinct()


def _doubt(depth: float, percent: int) -> float:
    """Logarithm of the chance that a linked pair does not meet in one tree at this depth."""
    return math.log1p(-((percent / 100) ** depth))


def forest_links(table: DataFrame, sets: DataFrame, classes: DataFrame, percent: int, n: int, crowd: int = CROWD, doubt: float = DOUBT) -> DataFrame:
    """(node, label) of nodes that are linked with another one."""
    chosen = sets.filter(F.col("n") >= _least_size(percent)).join(classes.select(F.col("node").alias(ROW)), ROW)
    nodes = staged(chosen.select(ROW, "n", "signature"), "nodes")
    forest = _Forest(table, nodes, percent, n)
    every_tree = F.array([F.lit(t) for t in range(TREES)]).alias("trees")
    first, doubts = _level(nodes.select("*", every_tree), DEPTHS[0]), []
    forest.best_first(_neighbours(first))
    forest.stars(first)
    level = first
    for depth, deeper in zip(DEPTHS, [*DEPTHS[1:], math.inf]):
        members = forest.open_regions(level)
        if members.isEmpty():
            break
        large = members.filter(F.col("members") > crowd)
        pairs = _crowded(members.filter(F.col("members") <= crowd)).unionByName(_neighbours(large))
        forest.confirm(forest.alike(pairs))
        more = _doubt(deeper, percent) - _doubt(depth, percent)
        doubts.append(large.groupBy(ROW).agg((F.count("*") * F.lit(more)).alias("doubt")))
        if deeper < math.inf:
            trees = large.groupBy(ROW).agg(F.collect_list("tree").alias("trees"))
            level = _level(nodes.join(trees, ROW), deeper)
    if doubts:
        bound = math.log(doubt) - TREES * _doubt(DEPTHS[0], percent)
        doubtful = doubts[0]
        for more in doubts[1:]:
            doubtful = doubtful.unionByName(more)
        doubtful = staged(doubtful.groupBy(ROW).agg(F.sum("doubt").alias("doubt")).filter(F.col("doubt") > bound).select(ROW), "doubtful")
        if not doubtful.isEmpty():
            members = forest.open_regions(first).join(doubtful.withColumn("doubtful", F.lit(True)), ROW, "left")
            members = staged(members.withColumn("doubtful", F.coalesce("doubtful", F.lit(False))), "members")
            members = members.join(members.filter("doubtful").select("region").distinct(), "region", "left_semi")
            texts = table.select(ROW, TEXT).join(members.select(ROW).distinct(), ROW)
            full = texts.mapInArrow(_tokens(n), "row_id long, tokens binary").join(nodes.select(ROW, "signature"), ROW)
            forest.join(staged(_all_across(members, staged(full, "full"), percent), "across"))
    return forest.labels


def near_duplicates(docs: DataFrame, text: str = "text", n: int = 5, percent: int = PERCENT, crowd: int = CROWD, doubt: float = DOUBT) -> tuple[DataFrame, DataFrame]:
    """Groups of texts connected by links of their shingle sets (Jaccard of ``percent`` or more).

    Words are runs of other than ASCII white space, A-Z in lower case; the set of a text has its
    distinct windows of ``n`` words, or all its words as one if it has fewer. A text without words, or
    null, has the empty set and is alone. Repeated rows and equal texts are linked.

    Returns the numbered texts (``tables.numbered``) and one row per text: ``row_id``, ``n`` (size of
    its set) and ``label`` (the same in a group and nowhere else).
    """
    table = bucketed(numbered(docs, text), ROW, "texts")
    sets = staged(table.select(ROW, TEXT).mapInArrow(_sets(n), SETS), "sets")
    classes = staged(sets.filter("n > 0").groupBy("set_a", "set_b").agg(F.min(ROW).alias("node")), "classes")
    labels = forest_links(table, sets, classes, percent, n, crowd, doubt)
    named = classes.join(labels, "node", "left").select("set_a", "set_b", F.coalesce("label", "node").alias("label"))
    placed = spread_join(sets, staged(named, "named"), ["set_a", "set_b"])
    return table, staged(placed.select(ROW, "n", F.when(F.col("n") > 0, F.col("label")).otherwise(F.col(ROW)).alias("label")), "groups")


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", n: int = 5, percent: int = PERCENT) -> DataFrame:
    """One document of each group: that with the smallest id, or smallest row among equal ids."""
    table, groups = near_duplicates(docs, text, n, percent)
    ids = table.select(ROW, F.col(REST)[doc_id].alias("id"))
    first = F.min(F.struct(F.col("id").isNull().alias("without"), "id", ROW))[ROW].alias(ROW)
    kept = groups.join(ids, ROW).groupBy("label").agg(first).select(ROW)
    return table.join(kept, ROW).select(*restored(table, docs.columns, text))


def digest(docs: DataFrame, n: int = 5, percent: int = PERCENT, crowd: int = CROWD, doubt: float = DOUBT) -> DataFrame:
    """One row per document: size of its set, smallest doc_id of its group, and whether that is its own.
    A group without any doc_id has a null one, which then counts as its own."""
    table, groups = near_duplicates(docs, "text", n, percent, crowd, doubt)
    rows = staged(groups.join(table.select(ROW, F.col(REST)["doc_id"].alias("doc_id")), ROW).drop(ROW), "rows")
    smallest = staged(rows.groupBy("label").agg(F.min("doc_id").alias("component_id")), "smallest")
    out = spread_join(rows, smallest, ["label"])
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
