"""Numpy on the UTF-8 bytes of many texts at once; what tasks of the operators share.

Everything here sees one Arrow batch inside one task. Texts are cut into pieces of whole texts, so
that working memory follows ``PIECE`` (or the longest single text) and not the batch. All patterns
the operators use treat every non-ASCII character alike, so working on bytes is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 20  # bytes of text worked on at a time, unless one text is longer
ODD = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)  # one odd base for each hash lane
U = np.uint64


def _bytes_where(test) -> np.ndarray:
    return np.array([test(b) for b in range(256)])


#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing A-Z: digits, letters, all of non-ASCII.
ALNUM = _bytes_where(lambda b: b >= 0x80 or chr(b).isalnum())
#: ``[^\x20\x09-\x0D]``: everything but ASCII white space.
SOLID = _bytes_where(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: A-Z to a-z, other bytes unchanged.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on all bits; one to one."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)


class _Lane:
    """Powers of an odd base and of its inverse modulo 2^64, and a random value for each byte."""

    def __init__(self, base: int, seed: int):
        self.base, self.inverse = U(base), U(pow(base, -1, 1 << 64))
        self.byte = mix(np.arange(1, 257, dtype=np.uint64) * U(2 * seed + 1))
        self.powers = self.inverses = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        if len(self.powers) < n:
            steps = np.full(max(n, PIECE + 1), self.base)
            steps[0] = U(1)
            self.powers = np.cumprod(steps, dtype=np.uint64)
            steps[1:] = self.inverse
            self.inverses = np.cumprod(steps, dtype=np.uint64)


_lanes = tuple(_Lane(base, seed) for seed, base in enumerate(ODD))


@dataclass
class Texts:
    """Consecutive rows of a batch: ``data[offsets[i]:offsets[i + 1]]`` are the bytes of row ``first + i``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def prefix(self, lane: int, lower: bool = False) -> np.ndarray:
        """Running polynomial hash of the bytes; ``span_hash`` takes the hash of any stretch from it."""
        own = _lanes[lane]
        own.upto(len(self.data) + 1)
        out = np.zeros(len(self.data) + 1, np.uint64)
        values = own.byte[LOWER] if lower else own.byte
        np.cumsum(values[self.data] * own.powers[: len(self.data)], out=out[1:])
        return out


def span_hash(prefix: np.ndarray, lane: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each stretch; equal bytes and lengths give equal values anywhere."""
    raw = (prefix[ends] - prefix[starts]) * _lanes[lane].inverses[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * U(0x632BE59BD9B4E019))


def texts(column: pa.Array, piece: int = PIECE) -> Iterator[Texts]:
    """The rows of a string column in pieces; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + piece, "right")) - 1)
        lo, hi = int(offsets[at]), int(offsets[to])
        yield Texts(at, raw[lo:hi], offsets[at : to + 1] - lo)
        at = to


@dataclass
class Words:
    """Words of a piece in order: byte bounds, and for each text the range of its words."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # words of text i are bounds[i]:bounds[i + 1]

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts())

    def remaining(self) -> np.ndarray:
        """For each word, how many words of its text follow, itself included."""
        return np.repeat(self.bounds[1:], self.counts()) - np.arange(len(self.starts))


def words(piece: Texts, inside: np.ndarray) -> Words:
    """Longest runs of bytes for which ``inside`` holds, never across texts."""
    n = len(piece.data)
    is_word = np.zeros(n + 2, bool)
    is_word[1:-1] = inside[piece.data]
    begins = piece.offsets[:-1][np.diff(piece.offsets) > 0]
    before, after = is_word[:-2].copy(), is_word[2:].copy()
    before[begins] = False
    after[begins[1:] - 1] = False
    own = is_word[1:-1]
    starts = np.flatnonzero(own & ~before)
    ends = np.flatnonzero(own & ~after) + 1
    return Words(starts, ends, np.searchsorted(starts, piece.offsets))


def word_hashes(piece: Texts, found: Words, lane: int = 0) -> np.ndarray:
    """A 64-bit hash of each word with A-Z lower-cased."""
    return span_hash(piece.prefix(lane, lower=True), lane, found.starts, found.ends)


def grams(hashes: np.ndarray, k: int, lane: int = 0) -> np.ndarray:
    """Hash of k consecutive words starting at each word; the last k - 1 values are left out."""
    n = max(0, len(hashes) - k + 1)
    out = np.zeros(n, np.uint64)
    base = U(ODD[lane])
    for i in range(k):
        out = out * base + hashes[i : i + n]
    return mix(out + U(k))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` consecutive values, by doubling; none if there are fewer."""
    if len(values) < width:
        return values[:0]
    out, size = values, 1
    while size < width:
        step = min(size, width - size)
        out = np.minimum(out[: len(out) - step], out[step:])
        size += step
    return out


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All of starts[i], starts[i] + 1, ... (counts[i] values), one after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(total)


def chunks(arrays: dict[str, np.ndarray], types: dict[str, pa.DataType], rows: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    """Record batches of bounded size from equally long arrays."""
    total = len(next(iter(arrays.values())))
    for at in range(0, total, rows):
        yield pa.RecordBatch.from_arrays(
            [pa.array(a[at : at + rows], types[name]) for name, a in arrays.items()], names=list(arrays)
        )
