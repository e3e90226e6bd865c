"""Quality scores from random-indexing word vectors and a small network.

Every token (a word, or a run of other signs) has a sparse random *index vector*; the vector of a
token is the sum of the index vectors of its neighbours over the whole corpus, so tokens used alike
get vectors alike. Tokens are hashed into ``TOKENS`` buckets, which bounds the table. A document is
the mean of its tokens' vectors, beside a few shares of its tokens. A two-layer network in numpy is
fitted to labelled documents on the driver and its probabilities are calibrated by a temperature.

The vectors count all documents. Only the network is fitted on a sample, of at most ``MOST_ROWS``
labelled rows, those with the smallest hash of their id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starmill.llm import kernel as K
from starmill.llm.language_id import fold
from starmill.llm.tables import staged

TOKENS = 1 << 14
DIMENSIONS = 32
ACTIVE = 2  # non-zero places of an index vector
MOST_ROWS = 20_000
HIDDEN = 24
THRESHOLD = 0.3
CHUNK = 512  # rows of the token table that travel together
SALTS = 32

LETTER_OR_DIGIT = K.ALNUM | K._bytes_where(lambda b: 65 <= b <= 90)
SIGN = ~LETTER_OR_DIGIT & K.SOLID
DIGIT = K._bytes_where(lambda b: 48 <= b <= 57)
CAPITAL = K._bytes_where(lambda b: 65 <= b <= 90)
SURFACE = 10


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of each bucket's index vector."""
    seed = K.mix(np.arange(1, TOKENS * ACTIVE + 1, dtype=np.uint64)).reshape(TOKENS, ACTIVE)
    return (seed % K.U(DIMENSIONS)).astype(np.int64), np.where(seed >> K.U(63) > 0, 1, -1)


PLACES, SIGNS = _index_vectors()


def _tokens(piece: K.Texts) -> tuple[K.Words, np.ndarray, np.ndarray]:
    """Words and runs of signs in order, their buckets, and which are signs."""
    words, signs = K.words(piece, LETTER_OR_DIGIT), K.words(piece, SIGN)
    starts, ends = np.r_[words.starts, signs.starts], np.r_[words.ends, signs.ends]
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    both = K.Words(starts, ends, np.searchsorted(starts, piece.offsets))
    bucket = (K.word_hashes(piece, both) >> K.U(64 - TOKENS.bit_length() + 1)).astype(np.int64)
    return both, bucket, order >= len(words.starts)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of neighbours' index vectors over one task's texts, in chunks of buckets."""
    total = np.zeros(TOKENS * DIMENSIONS, np.int64)
    salt = 0
    for batch in batches:
        for piece in K.texts(batch.column(0)):
            found, bucket, _ = _tokens(piece)
            salt = (salt + len(piece.data)) % SALTS
            text = found.text_of()
            here = np.flatnonzero(text[1:] == text[:-1])
            for one, other in ((bucket[here], bucket[here + 1]), (bucket[here + 1], bucket[here])):
                for i in range(ACTIVE):
                    flat = one * DIMENSIONS + PLACES[other, i]
                    total += np.bincount(flat, weights=SIGNS[other, i], minlength=len(total)).astype(np.int64)
    parts = total.reshape(-1, CHUNK * DIMENSIONS)
    used = np.flatnonzero(parts.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array(np.full(len(used), salt, np.int32)), pa.array([parts[i].tobytes() for i in used], pa.binary())],
        names=["chunk", "salt", "sums"],
    )


def _added(key: tuple, table: pa.Table) -> pa.Table:
    total = np.zeros(CHUNK * DIMENSIONS, np.int64)
    for part in table.column("sums"):
        total += np.frombuffer(part.as_buffer(), np.int64)
    return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Unit vectors of all token buckets. Partial sums meet in two steps, so that a task adds up a
    bounded share of them; the driver gets one table of ``TOKENS`` by ``DIMENSIONS``."""
    parts = docs.select(F.col(f"`{text}`")).mapInArrow(_contexts, "chunk int, salt int, sums binary")
    halfway = parts.groupBy("chunk", "salt").applyInArrow(_added, "chunk int, sums binary")
    rows = halfway.groupBy("chunk").applyInArrow(_added, "chunk int, sums binary").collect()
    table = np.zeros((TOKENS // CHUNK, CHUNK * DIMENSIONS))
    for row in rows:
        table[row["chunk"]] = np.frombuffer(row["sums"], np.int64)
    table = table.reshape(TOKENS, DIMENSIONS)
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1)).astype(np.float32)


def _pooled(piece: K.Texts, vectors: np.ndarray) -> np.ndarray:
    """(text, feature): mean token vector, and shares and sizes of the text's tokens."""
    found, bucket, sign = _tokens(piece)
    n, text = len(piece), found.text_of()
    counts = found.counts()
    per_token = np.maximum(counts, 1)
    out = np.zeros((n, DIMENSIONS + SURFACE), np.float32)
    full = np.flatnonzero(counts)
    if len(full):
        own = vectors[bucket]
        out[full, :DIMENSIONS] = np.add.reduceat(own, found.bounds[:-1][full], axis=0) / counts[full, None]
    again = np.zeros(len(bucket), bool)
    again[1:] = (bucket[1:] == bucket[:-1]) & (text[1:] == text[:-1])
    pair = np.unique(text * TOKENS + bucket)
    size = np.maximum(np.diff(piece.offsets), 1)
    by_text = np.repeat(np.arange(n), np.diff(piece.offsets))

    def bytes_in(kind: np.ndarray) -> np.ndarray:
        return np.bincount(by_text, weights=kind[piece.data], minlength=n) / size

    length = found.ends - found.starts
    surface = [
        np.log1p(counts),
        np.bincount(text, weights=sign, minlength=n) / per_token,
        np.bincount(text, weights=sign & (length > 1), minlength=n) / per_token,
        np.bincount(text, weights=again, minlength=n) / per_token,
        np.bincount(pair // TOKENS, minlength=n) / per_token,
        np.bincount(text, weights=length, minlength=n) / per_token / 10,
        bytes_in(DIGIT),
        bytes_in(CAPITAL),
        bytes_in(K._bytes_where(lambda b: b == 10)),
        np.linalg.norm(out[:, :DIMENSIONS], axis=1),
    ]
    out[:, DIMENSIONS:] = np.stack(surface, axis=1)
    return out


def _featured(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in K.texts(batch.column(1)):
                pooled = _pooled(piece, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(piece.first, len(piece)), pa.array([row.tobytes() for row in pooled], pa.binary())],
                    names=["doc_id", "features"],
                )

    return run


class Network:
    """Two layers on standardised features; ``temperature`` divides the last layer's output."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 1, rounds: int = 60, batch: int = 256):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = self._standard(x)
        order = rng.permutation(len(x))
        check, train = np.split(order, [len(order) // 5])
        rate = y[train].mean().clip(0.01, 0.99) if len(train) else 0.5
        self.w1 = rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN))
        self.b1, self.w2, self.b2 = np.zeros(HIDDEN), rng.normal(0, 0.2, HIDDEN), np.array(np.log(rate / (1 - rate)))
        state = {name: (np.zeros_like(getattr(self, name)), np.zeros_like(getattr(self, name))) for name in ("w1", "b1", "w2", "b2")}
        step = 0
        for _ in range(rounds):
            rng.shuffle(train)
            for at in range(0, len(train), batch):
                step += 1
                own = train[at : at + batch]
                self._descend(x[own], y[own], state, step)
        self.temperature = 1.0
        z, target = self._logit(x[check]), y[check]
        losses = {t: np.logaddexp(0, np.where(target > 0.5, -z, z) / t).mean() for t in np.geomspace(0.25, 8, 41)} if len(check) else {}
        self.temperature = min(losses, key=losses.get, default=1.0)

    def _standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def _logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.w1 + self.b1) @ self.w2 + self.b2

    def _descend(self, x, y, state, step, speed=0.004, decay=1e-4) -> None:
        hidden = np.tanh(x @ self.w1 + self.b1)
        error = (1 / (1 + np.exp(-(hidden @ self.w2 + self.b2))) - y) / len(x)
        back = error[:, None] * self.w2 * (1 - hidden**2)
        for name, slope in (("w1", x.T @ back), ("b1", back.sum(axis=0)), ("w2", hidden.T @ error), ("b2", error.sum())):
            value, (first, second) = getattr(self, name), state[name]
            slope = slope + decay * value
            first += 0.1 * (slope - first)
            second += 0.001 * (slope**2 - second)
            value -= speed * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self._logit(self._standard(x)) / self.temperature))


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float32).reshape(len(batch), -1)
            score = shared.value.score(x.astype(np.float64)) if shared.value else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    return run


def scores(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> DataFrame:
    """``doc_id, score``: probability that a text is of good quality, one row per document.

    ``labels`` has ``doc_id`` and ``quality`` (0 or 1; null is no label); several labels of an id
    count as their mean. A null text is an empty one and is scored from the fitted network like any
    other. Without any label every score is 0.5.
    """
    context = docs.sparkSession.sparkContext
    vectors = context.broadcast(word_vectors(docs))
    features = docs.select("doc_id", "text").mapInArrow(_featured(vectors), "doc_id long, features binary")
    features = staged(features, "features")
    marked = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    rows = _sample(features.join(marked, "doc_id"), most_rows).select("features", "quality").collect()
    network = None
    if rows:
        x = np.frombuffer(b"".join(r[0] for r in rows), np.float32).reshape(len(rows), -1)
        network = Network(x.astype(np.float64), np.array([r[1] for r in rows], float))
    return features.mapInArrow(_scored(context.broadcast(network)), "doc_id long, score double")


def _sample(labelled: DataFrame, most_rows: int) -> DataFrame:
    """The ``most_rows`` labelled rows with the smallest hash of their id.

    Rows above a bound on the hash that leaves half as many again go first, in the tasks, so that
    what is then ordered does not grow with the table.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    share = min(1.0, 1.5 * most_rows / max(labelled.count(), 1))
    near = labelled.withColumn("place", place).filter(F.col("place") <= int(share * (1 << 40)))
    return near.orderBy("place", "doc_id", "features").limit(most_rows)


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == 0


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: whether its label was held out, its score, and the decision."""
    learned = labels.filter(~held_out(F.col("doc_id")))
    out = scores(docs.select("doc_id", "text"), learned)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
