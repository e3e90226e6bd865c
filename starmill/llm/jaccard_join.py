"""Exact Jaccard join of word n-gram sets by parity sketches.

Two sets of sizes a and b with Jaccard similarity of at least s differ in at most
``(1 - s) / (1 + s) * (a + b)`` tokens. Tokens are dealt by hash into segments, and a segment's
signature is the XOR of its tokens: equal token sets give equal signatures, and the number of
segments that differ is a lower bound of the symmetric difference, as is the Hamming distance of
one-bit signatures.

1. Texts with equal sets become one class; only class representatives go on.
2. Per size band, each set is cut into more segments than may differ, so linked sets agree in some
   non-empty segment. Of its non-empty segments in a common order (most tokens first) each set
   needs to post only as many as may differ and one more: linked sets share a posted one. If too
   many segments are empty for that, all are posted and the set is dealt again with another seed.
3. Posted signatures are exchanged in sorted, packed blocks. A signature that few sets share gives
   all its pairs; one that many share gives pairs with one of them only, and its members are kept.
4. Pairs pass a Hamming test on bit sketches and are then verified on the texts.
5. Members kept in 3 are joined further until each signature's sets are in one component, first by
   pairs with well-linked members, at last by all pairs across components, in blocks of bit
   sketches. So no link is lost, and equal or star-like groups never become all their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starmill.llm import kernel as K
from starmill.llm.components import components
from starmill.llm.tables import REST, ROW, TEXT, bucketed, numbered, partitions, restored, staged

PERCENT = 75
FEW = 8  # sets of one signature up to which all pairs are made at once
BLOCK = 2048  # bit sketches compared with each other in one go, in the last step
SEEDS = 40
SIG_BITS = 48
LISTED = 16  # signatures of a set by which the last step tells that a pair meets elsewhere too
STAR_ROUNDS = 6
WORTH = 50  # go on with rounds while at least one pair in so many is linked
ODD_SET = 0xA24BAED4963EE407


def differing(a, b):
    """Largest symmetric difference of sets of these sizes that are still linked."""
    return (100 - PERCENT) * (a + b) // (100 + PERCENT)


def _edges(top: int) -> np.ndarray:
    """Band limits: sizes linked with one in band i lie in bands i - 1 to i + 1."""
    out = [0, 1]
    while out[-1] < top:
        out.append(max(out[-1] + 1, out[-1] * 100 // PERCENT))
    return np.array(out)


EDGES = _edges(1 << 31)


def _tokens(piece: K.Texts, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, ordered within it, and the bounds of each text's."""
    found = K.words(piece, K.SOLID)
    hashes, counts, left = K.word_hashes(piece, found), found.counts(), found.remaining()
    text = found.text_of()
    full = np.flatnonzero(left >= n)
    parts, owners = [K.grams(hashes, n)[full]], [text[full]]
    for short in range(1, n):
        first = found.bounds[:-1][counts == short]
        parts.append(K.grams(hashes, short)[first])
        owners.append(np.flatnonzero(counts == short))
    tokens, owner = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((tokens, owner))
    tokens, owner = tokens[order], owner[order]
    new = np.r_[True, (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])][: len(tokens)]
    tokens, owner = tokens[new], owner[new]
    return tokens, np.searchsorted(owner, np.arange(len(piece) + 1))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _bits(size: int) -> int:
    """Four to eight bits a token: few tokens then share a bit, and the bound on what differs is tight."""
    return max(64, 4 << int(size).bit_length())


def _sketch(tokens: np.ndarray) -> bytes:
    """One parity bit for each hash value modulo a power of two; halves fold onto each other."""
    bits = _bits(len(tokens))
    parity = np.bincount((tokens & K.U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


SETS = pa.schema([("row_id", pa.int64()), ("n", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()), ("sketch", pa.binary())])


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in K.texts(batch.column(1)):
                tokens, bounds = _tokens(piece, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(piece.first, len(piece)),
                        pa.array(np.diff(bounds)),
                        pa.array(K.signed(_sums(K.mix(tokens), bounds))),
                        pa.array(K.signed(_sums(K.mix(tokens ^ K.U(ODD_SET)), bounds))),
                        pa.array([_sketch(tokens[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
                    ],
                    schema=SETS,
                )

    return run


def _posted(tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures that the sets of a piece post, and the set each belongs to."""
    sizes = np.diff(bounds)
    own = np.searchsorted(EDGES, sizes, "left") - 1
    out, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for step in (0, 1):
        band = own + step
        top = EDGES[np.minimum(band + 1, len(EDGES) - 1)]
        most = differing(sizes, np.minimum(top, sizes * 100 // PERCENT))
        segments = np.maximum(1, -(-2 * top // 5))
        # sets that nothing but an equal set can be linked with post nothing
        todo = np.flatnonzero((sizes > 0) & (most > 0))
        for seed in range(SEEDS + 1):
            if not len(todo):
                break
            counts = sizes[todo]
            at = K.ranges(bounds[:-1][todo], counts)
            token, place = tokens[at], np.repeat(np.arange(len(todo)), counts)
            salt = K.U((2 * seed + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
            spread = K.mix(token ^ salt)
            if seed < SEEDS:
                segment = ((spread >> K.U(32)) * segments[todo].astype(np.uint64)[place]) >> K.U(32)
            else:  # every token alone: sharing one is then enough, whatever the seed
                segment = spread >> K.U(24)
            order = np.lexsort((segment, place))
            place, segment, spread = place[order], segment[order], spread[order]
            first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (segment[1:] != segment[:-1])])
            load = np.diff(np.r_[first, len(place)])
            value = np.bitwise_xor.reduceat(spread, first)
            place, segment = place[first], segment[first]
            key = (band[todo][place].astype(np.uint64) << K.U(40)) ^ (segment << K.U(8)) ^ K.U(seed)
            signature = K.mix(value ^ K.mix(key ^ (load.astype(np.uint64) << K.U(56))))
            order = np.lexsort((segment, -load, place))
            place, signature = place[order], signature[order]
            begin = np.searchsorted(place, np.arange(len(todo) + 1))
            rank = np.arange(len(place)) - begin[place]
            posts = rank <= most[todo][place]
            out.append(signature[posts])
            owners.append(todo[place[posts]])
            todo = todo[np.diff(begin) <= most[todo]]
    return np.concatenate(out) >> K.U(64 - SIG_BITS), np.concatenate(owners)


def _grouped(signatures: np.ndarray, rows: np.ndarray, marked: np.ndarray, few: int):
    """Pairs and kept members of signatures in sorted order, see step 3.

    ``marked`` entries stand for many sets of their own block, whose pairs and members are known.
    Returns (x, y) pairs, (signature, row) members, and a mask of one entry per signature of many.
    """
    none = np.zeros(0, np.int64)
    if not len(signatures):
        return (none, none), (none, none), np.zeros(0, bool)
    first = np.flatnonzero(np.r_[True, signatures[1:] != signatures[:-1]])
    counts = np.diff(np.r_[first, len(signatures)])
    many = (counts > few) | (np.add.reduceat(marked.astype(np.int64), first) > 0)
    pairs = []
    for size in range(2, few + 1):
        at = first[(counts == size) & ~many]
        for i in range(size):
            for j in range(i):
                pairs.append((rows[at + j], rows[at + i]))
    at, sizes = first[many], counts[many]
    members = K.ranges(at, sizes)
    leads = np.repeat(at, sizes)
    pairs.append((rows[leads], rows[members]))
    x, y = (np.concatenate([p[i] for p in pairs]) for i in (0, 1))
    lead = np.zeros(len(signatures), bool)
    lead[at] = True
    return (x, y), (signatures[members].astype(np.int64), rows[members]), lead


def _distinct_pairs(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x, y = np.minimum(x, y), np.maximum(x, y)
    keep = x != y
    pairs = np.unique(np.stack([x[keep], y[keep]], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


PACKED = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("first", pa.binary()), ("second", pa.binary()), ("rows", pa.binary())])
SIGNATURES, PAIRS, MEMBERS = 0, 1, 2


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PACKED, strict=True)], schema=PACKED)


def _blocks(n: int, buckets: int, few: int):
    """Posted signatures of each batch in one packed block per bucket: gaps of sorted signatures, and
    for each which set of the block posted it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found, owners = batch.column(0).to_numpy(), [], []
            for piece in K.texts(batch.column(1)):
                signature, owner = _posted(*_tokens(piece, n))
                found.append(signature)
                owners.append(owner + piece.first)
            if not found:
                continue
            signature, owner = np.concatenate(found), np.concatenate(owners)
            order = np.argsort(signature, kind="stable")
            signature, owner = signature[order], owner[order]
            first = np.flatnonzero(np.r_[True, signature[1:] != signature[:-1]][: len(signature)])
            counts = np.diff(np.r_[first, len(signature)])
            many = np.repeat(counts > few, counts)
            pairs, members, lead = _grouped(signature[many], rows[owner[many]], np.zeros(int(many.sum()), bool), few)
            marked = np.zeros(len(signature), bool)
            marked[np.flatnonzero(many)[lead]] = True
            kept = ~many | marked
            signature, owner, marked = signature[kept], owner[kept], marked[kept]
            width = -(-(1 << SIG_BITS) // buckets)
            cuts = np.searchsorted(signature, np.arange(buckets + 1, dtype=np.uint64) * K.U(width))
            out = []
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                own = slice(cuts[b], cuts[b + 1])
                used, local = np.unique(owner[own], return_inverse=True)
                gaps = np.diff(signature[own], prepend=K.U(b * width))
                gaps = gaps.astype(np.uint32) if gaps.max() < 1 << 32 else gaps
                local = (local.astype(np.uint32) << np.uint32(1)) | marked[own]
                local = local.astype(np.uint16) if len(used) < 1 << 15 else local
                head = np.array([gaps.itemsize, local.itemsize], np.uint8).tobytes()
                out.append((b, SIGNATURES, head + gaps.tobytes(), local.tobytes(), rows[used].tobytes()))
            x, y = _distinct_pairs(*pairs)
            if len(x):
                out.append((int(x[0]) % buckets, PAIRS, x.tobytes(), y.tobytes(), b""))
            if len(members[0]):
                out.append((int(x[0]) % buckets, MEMBERS, members[0].tobytes(), members[1].tobytes(), b""))
            if out:
                yield _packed(out)

    return run


MET = pa.schema([("kind", pa.int32()), ("x", pa.int64()), ("y", pa.int64())])


def _met(buckets: int, few: int):
    """All blocks of one bucket: pairs (x, y), and kept members (signature, row)."""
    width = -(-(1 << SIG_BITS) // buckets)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        pairs, members, signatures, rows, marks = [], [], [], [], []
        for kind, first, second, third in zip(*(table.column(c).to_pylist() for c in ("kind", "first", "second", "rows")), strict=True):
            if kind == SIGNATURES:
                gaps = np.frombuffer(first, np.uint32 if first[0] == 4 else np.uint64, offset=2)
                local = np.frombuffer(second, np.uint16 if first[1] == 2 else np.uint32)
                signatures.append(np.cumsum(gaps, dtype=np.uint64) + K.U(bucket * width))
                rows.append(np.frombuffer(third, np.int64)[local >> 1])
                marks.append((local & 1).astype(bool))
            else:
                (pairs if kind == PAIRS else members).append((np.frombuffer(first, np.int64), np.frombuffer(second, np.int64)))
        if signatures:
            signature, row, mark = (np.concatenate(a) for a in (signatures, rows, marks))
            order = np.argsort(signature, kind="stable")
            more, kept, _ = _grouped(signature[order], row[order], mark[order], few)
            pairs.append(more)
            members.append(kept)
        x, y = _distinct_pairs(*(np.concatenate([p[i] for p in pairs] or [np.zeros(0, np.int64)]) for i in (0, 1)))
        s, r = (np.concatenate([m[i] for m in members] or [np.zeros(0, np.int64)]) for i in (0, 1))
        kind = np.repeat(np.array([PAIRS, MEMBERS], np.int32), [len(x), len(s)])
        return pa.Table.from_arrays([pa.array(kind), pa.array(np.r_[x, s]), pa.array(np.r_[y, r])], schema=MET)

    return run


def _fold(sketch: bytes, size: int) -> int:
    value, bits = int.from_bytes(sketch, "little"), len(sketch) * 8
    while bits > size:
        bits //= 2
        value = (value >> bits) ^ (value & ((1 << bits) - 1))
    return value


def _words(sketches: list[bytes], size: int) -> np.ndarray:
    """Sketches folded to ``size`` bits, as rows of 64-bit words."""
    folded = b"".join(_fold(s, size).to_bytes(size // 8, "little") for s in sketches)
    return np.frombuffer(folded, np.uint64).reshape(len(sketches), -1)


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose Hamming distance leaves a link possible."""
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        keep = []
        for _, _, n_x, n_y, a, b in zip(*columns, strict=True):
            size = min(len(a), len(b)) * 8
            keep.append((_fold(a, size) ^ _fold(b, size)).bit_count() <= differing(n_x, n_y))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _linked(n: int):
    """Pairs of texts whose sets are linked."""

    def sets(column) -> list[np.ndarray]:
        out = []
        for piece in K.texts(column):
            tokens, bounds = _tokens(piece, n)
            out += [tokens[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.slice(at, 256)
                one, two = sets(batch.column(2)), sets(batch.column(3))
                keep = []
                for a, b in zip(one, two, strict=True):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    keep.append(100 * both >= PERCENT * (len(a) + len(b) - both))
                yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _links(table: DataFrame, sets: DataFrame, pairs: DataFrame, n: int) -> DataFrame:
    """The linked ones of candidate pairs ``(x, y)``."""
    at_x = sets.select(F.col(ROW).alias("x"), F.col("n").alias("n_x"), F.col("sketch").alias("sketch_x"))
    at_y = sets.select(F.col(ROW).alias("y"), F.col("n").alias("n_y"), F.col("sketch").alias("sketch_y"))
    sized = pairs.join(at_x, "x").join(at_y, "y").filter(F.least("n_x", "n_y") * 100 >= F.greatest("n_x", "n_y") * PERCENT)
    near = sized.select("x", "y", "n_x", "n_y", "sketch_x", "sketch_y").mapInArrow(_near, "x long, y long")
    near = staged(near, "near")
    texts = table.select(F.col(ROW).alias("y"), F.col(TEXT).alias("text_y"))
    # one side's texts go to the other's; x is the node that many pairs may share, so it is joined
    # last, between two exchanges, where adaptive execution can split it
    with_y = near.join(texts, "y")
    texts = table.select(F.col(ROW).alias("x"), F.col(TEXT).alias("text_x")).join(near.select("x").distinct(), "x")
    both = with_y.join(texts.repartition(partitions(table.sparkSession), "x"), "x")
    return staged(both.select("x", "y", "text_x", "text_y").mapInArrow(_linked(n), "x long, y long"), "verified")


def _unsettled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of signatures whose sets are still in several components, with their component."""
    named = members.join(labels.withColumnRenamed("node", "row"), "row", "left").withColumn("label", F.coalesce("label", "row"))
    several = named.groupBy("signature").agg(F.min("label").alias("a"), F.max("label").alias("b")).filter("a <> b")
    return named.join(several.select("signature"), "signature", "left_semi")


def _last_pairs(key: tuple, table: pa.Table) -> pa.Table:
    """Pairs across components of two blocks of one signature that pass the Hamming test.

    Sets that share many signatures meet under each. ``least`` are the ``LISTED`` smallest ones of a
    set; a pair that has a smaller one in common is left to that one, where it is met as well.
    """
    signature = key[0].as_py()
    rows, labels, sizes = (table.column(c).to_numpy() for c in ("row", "label", "n"))
    least = table.column("least").combine_chunks()
    smaller = np.full((len(rows), LISTED), -1, np.int64)  # no signature is negative
    counts = np.asarray(least.value_lengths())
    smaller[np.repeat(np.arange(len(rows)), counts), K.ranges(np.zeros(len(rows), np.int64), counts)] = np.asarray(least.flatten())
    smaller[smaller >= signature] = -1
    sides = table.column("side").to_numpy()
    sketches = table.column("sketch").to_pylist()
    bits = min((len(s) * 8 for s in sketches), default=64)
    fine, coarse = (_words(sketches, size) for size in (bits, max(64, bits // 4)))
    left, right = np.flatnonzero(sides <= 0), np.flatnonzero(sides >= 0)
    x, y = [], []
    for i in left.tolist():
        other = right[labels[right] != labels[i]]
        for sketch in (coarse, fine):  # folded sketches differ in no more bits, and are shorter
            far = np.bitwise_count(sketch[other] ^ sketch[i]).sum(axis=1, dtype=np.int64)
            other = other[far <= differing(sizes[other], sizes[i])]
        other = other[~np.isin(smaller[other], smaller[i][smaller[i] >= 0]).any(axis=1)]
        x.append(np.full(len(other), rows[i]))
        y.append(rows[other])
    empty = [np.zeros(0, np.int64)]
    a, b = _distinct_pairs(np.concatenate(x or empty), np.concatenate(y or empty))
    return pa.table({"x": a, "y": b})


def _all_across(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Candidate pairs across components among the members of each signature, exactly and in blocks.

    Members of a signature are dealt into blocks of about ``BLOCK``; a task sees two blocks.
    """
    sized = members.groupBy("signature").agg(F.count("*").alias("members"))
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    dealt = members.join(sized, "signature").withColumn("blocks", blocks)
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    least = members.groupBy("row").agg(F.slice(F.array_sort(F.collect_list("signature")), 1, LISTED).alias("least"))
    dealt = dealt.join(sets.select(F.col(ROW).alias("row"), "n", "sketch"), "row").join(least, "row")
    with_other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.signum(F.col("block") - F.col("other")).cast("int").alias("side")
    sides = with_other.select("signature", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "row", "label", "n", "sketch", "least", side)
    return sides.groupBy("signature", "i", "j").applyInArrow(_last_pairs, "x long, y long").distinct()


def _star_pairs(members: DataFrame, links: DataFrame, used: DataFrame) -> DataFrame:
    """For each signature, its sets outside the largest component paired with that component's
    best-linked member that has not yet been used."""
    degree = links.select(F.col("x").alias("row")).union(links.select("y")).groupBy("row").agg(F.count("*").alias("degree"))
    scored = members.join(degree, "row", "left").join(used.withColumn("was", F.lit(1)), "row", "left")
    rank = F.struct(F.coalesce("degree", F.lit(0)), F.xxhash64("row"), "row")
    parts = scored.groupBy("signature", "label").agg(F.count("*").alias("members"), F.max(F.when(F.col("was").isNull(), rank)).alias("best"))
    parts = parts.filter("best IS NOT NULL")
    lead = parts.groupBy("signature").agg(F.max(F.struct("members", "best", "label")).alias("top"))
    lead = lead.select("signature", F.col("top.best.row").alias("lead"), F.col("top.label").alias("lead_label"))
    met = members.join(lead, "signature").filter("label <> lead_label")
    return met.select(F.least("row", "lead").alias("x"), F.greatest("row", "lead").alias("y"), "lead").distinct()


def jaccard_links(table: DataFrame, n: int, few: int = FEW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sets of a numbered, bucketed table and the components of their links.

    Returns ``sets`` (row_id, n, set_a, set_b, sketch), ``classes`` (set_a, set_b, node: the row
    that stands for all texts with this set) and ``labels`` (node, label) of linked nodes.
    """
    spark = table.sparkSession
    sets = staged(table.select(ROW, TEXT).mapInArrow(_sets(n), "row_id long, n long, set_a long, set_b long, sketch binary"), "sets")
    classes = staged(sets.filter("n > 0").groupBy("set_a", "set_b").agg(F.min(ROW).alias("node")), "classes")
    chosen = table.select(ROW, TEXT).join(classes.select(F.col("node").alias(ROW)).hint("shuffle_hash"), ROW)
    buckets = 2 * partitions(spark)
    packed = chosen.mapInArrow(_blocks(n, buckets, few), "bucket int, kind int, first binary, second binary, rows binary")
    met = staged(packed.groupBy("bucket").applyInArrow(_met(buckets, few), "kind int, x long, y long"), "met")
    pairs = met.filter(F.col("kind") == PAIRS).select("x", "y").distinct()
    members = met.filter(F.col("kind") == MEMBERS).select(F.col("x").alias("signature"), F.col("y").alias("row")).distinct()
    links = _links(table, sets, pairs, n)
    labels = components(links)
    used = spark.createDataFrame([], "row long")
    for _ in range(STAR_ROUNDS):
        open_members = staged(_unsettled(members, labels), "members")
        if open_members.isEmpty():
            return sets, classes, labels
        stars = staged(_star_pairs(open_members, links, used), "stars")
        used = staged(used.union(stars.select(F.col("lead").alias("row"))).distinct(), "used")
        tried = stars.select("x", "y").distinct()
        more = _links(table, sets, tried, n)
        links, members = links.union(more), open_members.select("signature", "row")
        labels = components(links)
        if more.count() * WORTH < tried.count():
            break  # what is left are mostly sets with a passage in common; the last step is as exact
    open_members = staged(_unsettled(members, labels), "members")
    links = links.union(_links(table, sets, _all_across(open_members, sets), n))
    return sets, classes, components(links)


def near_duplicates(docs: DataFrame, text: str = "text", n: int = 5, few: int = FEW) -> tuple[DataFrame, DataFrame]:
    """Groups of texts connected by Jaccard links of their word n-gram sets (at least 0.75).

    Words are runs of other than ASCII white space, A-Z lower-cased; the set of a text holds its
    distinct n-grams, or its whole sequence if it has fewer words. A text without words has the
    empty set and is alone. Repeated rows and equal texts are linked.

    Returns the numbered texts and one row per text: ``row_id``, ``n`` (size of its set) and
    ``label`` (the same within a group and nowhere else).
    """
    table = bucketed(numbered(docs, text), ROW, "texts")
    sets, classes, labels = jaccard_links(table, n, few)
    named = classes.join(labels, "node", "left").select("set_a", "set_b", F.coalesce("label", "node").alias("label"))
    # an empty set's row is its own group
    out = sets.select(ROW, "n", "set_a", "set_b").join(named, ["set_a", "set_b"], "left")
    label = F.when(F.col("n") > 0, F.col("label")).otherwise(F.col(ROW))
    return table, out.select(ROW, "n", label.alias("label"))


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", n: int = 5) -> DataFrame:
    """One document of each group: that with the smallest id, or smallest row among equal ids."""
    table, grouped = near_duplicates(docs, text, n)
    ids = table.select(ROW, F.col(REST)[doc_id].alias("id"))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", ROW))[ROW].alias(ROW)
    kept = grouped.join(ids, ROW).groupBy("label").agg(first).select(ROW)
    return table.join(kept, ROW).select(*restored(table, docs.columns, text))


def digest(docs: DataFrame, n: int = 5, few: int = FEW) -> DataFrame:
    """One row per document: size of its set and the smallest doc_id of its group."""
    table, grouped = near_duplicates(docs, "text", n, few)
    grouped = grouped.join(table.select(ROW, F.col(REST)["doc_id"].alias("doc_id")), ROW)
    smallest = grouped.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return grouped.join(smallest, "label").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
