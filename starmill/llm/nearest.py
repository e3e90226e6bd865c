"""Nearest neighbours by largest inner product with a permutation index.

Vectors are first centred: taking one vector from all candidates changes each inner product with a
query by the same amount, and spreads the directions of vectors that share an offset. The centre is the
median of the pivots' components, which no few long vectors can move. Queries are not centred.

Centred vectors are put into bands of about equal length (``BANDS`` for each doubling, however long the
longest is). Within a band the largest inner product with a query is nearly the smallest angle, so
pivots are directions, and each vector is represented by the ``PREFIX`` pivots of the smallest angle
in order, queries and others alike. The index deals the vectors into shards of bounded size and
stores, beside every vector, its band and its ordered pivots. A search task holds one shard: it posts
the shard's vectors in one inverted file per pivot, adds up over a query's own pivots what the files
say of the footrule distance, reranks the closest ``SHARE`` of each band by the exact inner product
in double precision, and keeps the best. Best ones of all shards are merged.

With ranks counted from 0 and a missing pivot ranked ``PREFIX``, the footrule distance of two
prefixes is ``l(l+1) - 2 * sum(min(l - r, l - r'))`` over their common pivots, so the files need
only add up the minima.

Equal vectors are one class in the index. For a search only a class's smallest ids can matter (as
many as are asked for, and one for the query itself), so a vector that a third of all rows share
costs one entry, and its queries are searched once. Ties between classes are broken by their smallest
ids, so that a shard's best classes hold its best ids. An id with several vectors is searched on its
own for each of them, without the classes that hold no other id; else those could fill its list.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from starmill.llm.tables import ROW, staged

PIVOTS = 2048  # pivots: so many vectors at most, those with the smallest hash
PREFIX = 64
SHARE = 0.15
BANDS = 3  # bands of length for each doubling
TIMES = 8  # a band reranks at least so many times what is asked for: all answers can lie in the longest
SHARD = 50_000
QUERY_BLOCK = 5_000


def valid(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, vector, dimension) of rows that take part, in double precision."""
    vector = F.col(f"`{embedding}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), vector.alias("vector")).filter("vec_id IS NOT NULL AND vector IS NOT NULL")
    infinite = "exists(vector, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"
    return rows.filter(f"NOT ({infinite}) AND exists(vector, x -> x <> 0)").withColumn("dimension", F.size("vector"))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length 1, and the band of each vector's length; lengths of 1 lie inside a band."""
    largest = np.abs(x).max(axis=1, keepdims=True)  # squares of very long or short ones have no double
    largest[largest == 0] = np.finfo(float).tiny  # the centre itself has no direction
    x = x / largest
    length = np.maximum(np.sqrt((x**2).sum(axis=1, keepdims=True)), np.finfo(float).tiny)
    doublings = np.log2(largest[:, 0]) + np.log2(length[:, 0])
    return x / length, np.floor(BANDS * doublings + 0.5).astype(np.int32)


def _centred(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Halved, so that no difference is beyond a double."""
    return x / 2 - centre / 2


def _prefix(near: np.ndarray) -> np.ndarray:
    """The nearest pivots of each row in order, from inner products."""
    length = min(PREFIX, near.shape[1])
    some = np.sort(np.argpartition(-near, length - 1, axis=1)[:, :length], axis=1)
    order = np.argsort(-np.take_along_axis(near, some, axis=1), axis=1, kind="stable")
    return np.take_along_axis(some, order, axis=1).astype(np.int16)


def _indexed(pivots, centred: bool):
    """Band and ordered pivots of vectors, of centred ones as candidates and of others as queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                for dimension in sorted(set(part.column(2).to_pylist())):
                    rows = part.filter(pc.equal(part.column(2), dimension))
                    x = _matrix(rows.column(1))
                    centre, own = pivots.value[dimension]
                    directions, band = _directions(_centred(x, centre) if centred else x)
                    order = _prefix(directions @ own.T)
                    yield pa.RecordBatch.from_arrays(
                        [*rows.columns, pa.array(band), pa.array([o.tobytes() for o in order], pa.binary())],
                        names=[*rows.schema.names, "band", "pivots"],
                    )

    return run


def pivots_of(classes: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The centre and the directions of the pivots by dimension. At most ``PIVOTS`` of each are sampled."""
    hashed = classes.select("dimension", "vector", F.xxhash64("vector").alias("hash"))
    rank = F.row_number().over(Window.partitionBy("dimension").orderBy("hash"))
    sample = hashed.withColumn("rank", rank).filter(F.col("rank") <= PIVOTS).orderBy("dimension", "rank").toPandas()
    out = {}
    for d, part in sample.groupby("dimension"):
        x = np.array(part["vector"].tolist(), np.float64)
        centre = 2 * np.median(x / 2, axis=0)
        out[d] = centre, _directions(_centred(x, centre))[0]
    return out


FOUND = "query_class long, several boolean, own long, class_id long, score double"
FOUND_TYPES = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64()]
FOUND_NAMES = ["query_class", "several", "own", "class_id", "score"]


def _search(k: int):
    """All queries of one block against one shard."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        shard = {c: left.column(c) for c in left.column_names}
        n = len(left)
        if not n or not len(right):
            return pa.table([pa.array([], t) for t in FOUND_TYPES], names=FOUND_NAMES)
        band = shard["band"].to_numpy()
        by_band = np.argsort(band, kind="stable")
        x, ids = _matrix(shard["vector"])[by_band], shard[ROW].to_numpy()[by_band]
        first, second = (shard[c].to_numpy()[by_band] for c in ("first_id", "second_id"))
        ranks = np.frombuffer(b"".join(shard["pivots"].to_pylist()), np.int16).reshape(n, -1)[by_band]
        length = ranks.shape[1]
        # inverted files: for each pivot the vectors that have it, with l - rank
        pivot = ranks.ravel().astype(np.int64)
        order = np.argsort(pivot, kind="stable")
        owner, weight = (order // length).astype(np.int32), (length - order % length).astype(np.int16)
        file = np.searchsorted(pivot[order], np.arange(pivot.max() + 2))
        edges = np.r_[0, np.flatnonzero(np.diff(band[by_band])) + 1, n]
        sizes = np.diff(edges)
        wanted = np.maximum(TIMES * (k + 1), np.ceil(SHARE * sizes).astype(np.int64))
        whole = np.flatnonzero(np.repeat(sizes <= wanted, sizes))
        partly = [(edges[b], edges[b + 1], wanted[b]) for b in np.flatnonzero(sizes > wanted).tolist()]
        queries, numbers = _matrix(right.column("q_vector")), right.column(f"q_{ROW}").to_numpy()
        several, owns = right.column("q_several").to_pylist(), right.column("q_own").to_pylist()
        asked = np.frombuffer(b"".join(right.column("q_pivots").to_pylist()), np.int16).reshape(len(right), -1)
        out = []
        for i in range(len(right)):
            near = np.zeros(n, np.int32)
            for r, p in enumerate(asked[i].tolist()):
                if p + 1 < len(file):
                    own = slice(file[p], file[p + 1])
                    near[owner[own]] += np.minimum(weight[own], length - r)
            name = first
            if several[i]:
                name = np.where(first == owns[i], second, first)
                mine = name == owns[i]  # classes of this id alone
                near[mine] = -1
            chosen = np.concatenate([whole, *(a + np.argpartition(-near[a:b], w - 1)[:w] for a, b, w in partly)])
            if several[i]:
                chosen = chosen[~mine[chosen]]
            score = x[chosen] @ queries[i]
            if len(chosen) > k + 1:  # one place is for the query's own class
                top = np.partition(score, len(score) - k - 1)[len(score) - k - 1]
                keep = score >= top
                chosen, score = chosen[keep], score[keep]
            best = np.lexsort((name[chosen], -score))[: k + 1]
            out.append((*(np.full(len(best), v) for v in (numbers[i], several[i], owns[i])), ids[chosen[best]], score[best]))
        columns = [np.concatenate(column) for column in zip(*out, strict=True)]
        return pa.table([pa.array(c, t) for c, t in zip(columns, FOUND_TYPES, strict=True)], names=FOUND_NAMES)

    return run


def search(vectors: DataFrame, k: int = 20, every: int = 20, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The ``k`` nearest other rows of every row whose id is divisible by ``every``.

    Nearness is the inner product in double precision; ties go to the smaller id. Rows whose id or
    vector is null, or whose vector is zero, empty, or holds a null or non-finite component, take no
    part. A row is no candidate of queries with its own id. Vectors of different lengths are never
    compared. Returns ``query_id, rank, vec_id, score``.

    Rows that repeat both id and vector count once. An id with several vectors is one query, with one
    list: rows are ranked by their best score with any of its vectors. As a neighbour it is a row for
    each vector, so its id can be listed that often.
    """
    rows = staged(valid(vectors, vec_id, embedding).distinct(), "vectors")
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    smallest = rows.select("vector", "dimension", "vec_id").withColumn("rank", rank).filter(F.col("rank") <= k + 1)
    smallest = staged(smallest, "smallest")
    first = smallest.filter("rank = 1").select(F.monotonically_increasing_id().alias(ROW), "vector", "dimension", F.col("vec_id").alias("first_id"))
    classes = staged(first, "classes")
    named = classes.select(F.col("vector"), F.col(ROW).alias("class_id"))
    members = staged(smallest.join(named, "vector").select("class_id", "vec_id", "rank"), "members")
    asked = rows.filter(F.col("vec_id") % every == 0).select("vec_id", "vector").join(named, "vector").select("vec_id", "class_id")
    asked = staged(asked, "asked")
    repeated = asked.groupBy("vec_id").agg(F.count("*").alias("n")).filter("n > 1").select("vec_id", F.lit(True).alias("several"))
    asked = asked.join(repeated, "vec_id", "left").withColumn("several", F.coalesce("several", F.lit(False)))
    unit = ["class_id", "several", "own"]
    asked = staged(asked.withColumn("own", F.when(F.col("several"), F.col("vec_id")).otherwise(F.lit(0))), "units")

    spark = vectors.sparkSession
    pivots = spark.sparkContext.broadcast(pivots_of(classes))
    second = members.filter("rank = 2").select(F.col("class_id").alias(ROW), F.col("vec_id").alias("second_id"))
    both = classes.join(second, ROW, "left").withColumn("second_id", F.coalesce("second_id", "first_id"))
    both = both.select(ROW, "vector", "dimension", "first_id", "second_id")
    fields = f"{ROW} long, vector array<double>, dimension int, first_id long, second_id long, band int, pivots binary"
    index = staged(both.mapInArrow(_indexed(pivots, True), fields), "index")
    counts = index.groupBy("dimension").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("shards"))
    sharded = index.join(counts, "dimension").withColumn("shard", F.pmod(F.xxhash64(ROW), F.col("shards")).cast("int"))
    units = asked.select(F.col("class_id").alias(ROW), "several", "own").distinct()
    queries = both.join(units.select(ROW).distinct(), ROW).mapInArrow(_indexed(pivots, False), fields)
    queries = staged(queries.join(units, ROW), "queries")
    blocks = queries.groupBy("dimension").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("blocks"))
    spread = queries.join(blocks, "dimension").join(counts, "dimension")
    spread = spread.withColumn("block", F.pmod(F.xxhash64(F.lit(1), ROW), F.col("blocks")).cast("int"))
    spread = spread.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).drop("blocks", "shards")
    spread = spread.toDF(*[f"q_{c}" for c in spread.columns])
    tasks = sharded.join(blocks, "dimension").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = tasks.drop("blocks", "shards")
    keys = ["dimension", "shard", "block"]
    found = tasks.groupBy(*keys).cogroup(spread.groupBy(*[f"q_{c}" for c in keys])).applyInArrow(_search(k), FOUND)
    found = staged(found, "found")

    # a query needs k ids beside its own, so the best k + 1 of its class's candidates are enough
    best = Window.partitionBy("query_class", "several", "own").orderBy(F.desc("score"), "vec_id")
    listed = found.join(members.drop("rank"), "class_id").filter("NOT several OR vec_id <> own")
    listed = listed.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
    listed = listed.select(F.col("query_class").alias("class_id"), "several", "own", "vec_id", F.col("class_id").alias("met"), "score")
    pairs = asked.withColumnRenamed("vec_id", "query_id").join(listed, unit).filter("query_id <> vec_id")
    pairs = pairs.groupBy("query_id", "vec_id", "met").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
