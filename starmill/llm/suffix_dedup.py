"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Suffixes are ordered only through ``width`` bytes, most significant digit first: a suffix whose
digits so far are unique leaves, and suffixes still equal at full depth start a repeated string.
Three things keep the sort far smaller than the text:

* Windows are dealt in runs. The *anchor* of a window is the place in it of its smallest hash of
  ``width * 4 // 25`` bytes, so equal windows have equal anchors at equal offsets, and one row
  (anchor, offsets from, to) stands for all neighbouring windows of one anchor.
* A digit has two sides. Its *core* are bytes that every window of the run contains; a run whose
  core is unique leaves. Its *span* are all bytes of the run; if the span repeats, all its windows
  do, and the run is settled. Only one run of each distinct span goes on.
* Runs that are neither are cut into blocks of 64, then 8, then 1 offsets and dealt again. At one
  offset core and span are the window itself, so the answer is exact.

Rows moved follow the number of anchors (about one in a hundred bytes), never the number of pairs:
digits are counted with map-side combine, and the only joins are on digits with unique right sides.
Spans are compared by two independent 64-bit hashes.

Repeated runs of words are found by the same sort: every word is written as the ``UNIT`` bytes of its
hash, and a run of n words is a string of ``n * UNIT`` of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starmill.llm import kernel as K
from starmill.llm.tables import ROW, TEXT, bucketed, numbered, restored, staged

BLOCKS = (64, 8, 1)
UNIT = 8  # bytes of the hash that stands for a word
NODE = "row_id long, at long, core long, span_a long, span_b long"
NODE_TYPES = {"row_id": pa.int64(), "at": pa.int64(), "core": pa.int64(), "span_a": pa.int64(), "span_b": pa.int64()}


def _pack(pos: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return (pos << 32) | (lo << 16) | hi


def _unpack(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return at >> 32, (at >> 16) & 0xFFFF, at & 0xFFFF


def _spans(hashes: list[np.ndarray], starts: np.ndarray, ends: np.ndarray, lo: np.ndarray) -> list[np.ndarray]:
    """Two hashes of the bytes of each stretch and of where its anchor lies in it."""
    salt = lo.astype(np.uint64) * K.U(0xD6E8FEB86659FD93)
    return [K.signed(K.mix(K.span_hash(h, lane, starts, ends) ^ salt)) for lane, h in enumerate(hashes)]


def _as_bytes(piece: K.Texts) -> K.Texts:
    return piece


def _as_words(piece: K.Texts) -> K.Texts:
    """The texts with every word (by ``K.SOLID``, as it is written) as its hash and nothing between."""
    found = K.words(piece, K.SOLID)
    hashes = K.span_hash(piece.prefix(0), 0, found.starts, found.ends)
    return K.Texts(piece.first, hashes.view(np.uint8), found.bounds * UNIT)


def _anchors(width: int, view):
    """Runs of windows by anchor, with the anchor's own bytes as core."""
    size = width * 4 // 25 or 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for piece in map(view, K.texts(batch.column(1))):
                if len(piece.data) < width:
                    continue
                lengths = np.diff(piece.offsets)
                windows = np.maximum(lengths - width + 1, 0)
                starts = K.ranges(piece.offsets[:-1], windows)
                if not len(starts):
                    continue
                hashes = [piece.prefix(0), piece.prefix(1)]
                places = np.arange(len(piece.data) - size + 1)
                cores = K.span_hash(hashes[0], 0, places, places + size)
                order = (cores & K.U(0xFFFFFFFF00000000)) | places.astype(np.uint64)
                anchor = (K.sliding_min(order, width - size + 1)[starts] & K.U(0xFFFFFFFF)).astype(np.int64)
                text = np.repeat(np.arange(len(piece)), windows)
                new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])
                first, last = starts[new], starts[np.r_[new[1:] - 1, len(starts) - 1]]
                anchor, text = anchor[new], text[new]
                lo, hi = anchor - last, anchor - first
                span_a, span_b = _spans(hashes, first, last + width, lo)
                out = {
                    "row_id": rows[piece.first + text],
                    "at": _pack(anchor - piece.offsets[text], lo, hi),
                    "core": K.signed(cores[anchor]),
                    "span_a": span_a,
                    "span_b": span_b,
                }
                yield from K.chunks(out, NODE_TYPES)

    return run


def _split(width: int, block: int, view):
    """Open runs of each text, cut into aligned blocks of offsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ats = batch.column(0).to_numpy(), batch.column(2)
            for piece in map(view, K.texts(batch.column(1))):
                own = ats.slice(piece.first, len(piece))
                counts = np.asarray(own.value_lengths())
                pos, lo, hi = _unpack(np.asarray(own.flatten()))
                text = np.repeat(np.arange(len(piece)), counts)
                blocks = hi // block - lo // block + 1
                number = K.ranges(lo // block, blocks)
                pos, lo, hi, text = (np.repeat(a, blocks) for a in (pos, lo, hi, text))
                lo, hi = np.maximum(lo, number * block), np.minimum(hi, number * block + block - 1)
                hashes = [piece.prefix(0), piece.prefix(1)]
                here = pos + piece.offsets[text]
                inner = here - number * block
                core = K.span_hash(hashes[0], 0, inner, inner - block + 1 + width)
                span_a, span_b = _spans(hashes, here - hi, here - lo + width, lo)
                out = {
                    "row_id": rows[piece.first + text],
                    "at": _pack(pos, lo, hi),
                    "core": K.signed(K.mix(core ^ number.astype(np.uint64))),
                    "span_a": span_a,
                    "span_b": span_b,
                }
                yield from K.chunks(out, NODE_TYPES)

    return run


def _judge(nodes: DataFrame) -> DataFrame:
    """Runs that are settled (their span repeats) or open (one of several spans over one core)."""
    span = ["core", "span_a", "span_b"]
    name = F.xxhash64("row_id", "at")
    classes = nodes.groupBy(*span).agg(F.count("*").alias("runs"), F.min(name).alias("first"))
    several = classes.groupBy("core").agg(F.count("*").alias("spans")).filter("spans > 1")
    kept = classes.join(several, "core", "left").filter("runs > 1 OR spans IS NOT NULL")
    return nodes.join(kept, span).select(
        "row_id", "at", (F.col("runs") > 1).alias("settled"), (F.col("spans").isNotNull() & (name == F.col("first"))).alias("open")
    )


def _by_text(ats: DataFrame) -> DataFrame:
    """At most one row per text; its list is as long as the text at most."""
    return ats.groupBy(ROW).agg(F.collect_list("at").alias("ats"))


def repeated(texts: DataFrame, width: int, view=_as_bytes) -> DataFrame:
    """Runs of repeated windows, ``(row_id, at)``, of a table bucketed by ``row_id``; both in the
    bytes that ``view`` makes of the texts."""
    nodes = texts.select(ROW, TEXT).mapInArrow(_anchors(width, view), NODE)
    judged = staged(_judge(staged(nodes, "runs")), "judged")
    found = judged.filter("settled").select(ROW, "at")
    for block in (b for b in BLOCKS if b < width):  # every window of a block must contain its core
        open_runs = _by_text(judged.filter("open"))
        with_text = texts.select(ROW, TEXT).join(open_runs.hint("shuffle_hash"), ROW)
        nodes = with_text.select(ROW, TEXT, "ats").mapInArrow(_split(width, block, view), NODE)
        judged = staged(_judge(staged(nodes, "runs")), "judged")
        found = found.union(judged.filter("settled").select(ROW, "at"))
    return found


def _covered(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Disjoint, ordered (start, end) of all bytes in the given stretches."""
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.r_[True, starts[1:] > ends[:-1]])
    return np.stack([starts[new], ends[np.r_[new[1:] - 1, len(ends) - 1]]], axis=1)


def _of_bytes(width: int, runs: pa.ListScalar) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of what the windows of each run cover."""
    pos, lo, hi = _unpack(np.asarray(runs.values, np.int64))
    return pos - hi, pos - lo + width


def _of_words(words: int, runs: pa.ListScalar) -> np.ndarray:
    """The same in numbers of words, of runs among their hashes, disjoint and in order. Only windows
    that begin with a word count."""
    first, last = _of_bytes(0, runs)
    first, last = -(-first // UNIT), last // UNIT
    some = first <= last
    return _covered(first[some], last[some] + words)


OUT = pa.schema(
    [
        ("row_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("spans", pa.list_(pa.int64())),
        ("kept_sha256", pa.string()),
        ("kept", pa.string()),
        ("n_repeated_words", pa.int64()),
        ("n_word_spans", pa.int64()),
    ]
)


def _cut(width: int, words: int, with_text: bool, remove_words: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ats, word_ats = batch.column(0), batch.column(2), batch.column(3)
            for piece in K.texts(batch.column(1)):
                raw, bounds = piece.data.tobytes(), piece.offsets.tolist()
                found = K.words(piece, K.SOLID) if words else None
                columns = {name: [] for name in OUT.names[1:]}
                for i in range(len(piece)):
                    text, runs, word_runs = raw[bounds[i] : bounds[i + 1]], ats[piece.first + i], word_ats[piece.first + i]
                    parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
                    if runs.is_valid:
                        parts.append(_of_bytes(width, runs))
                    repeats = np.zeros((0, 2), np.int64)
                    if words and word_runs.is_valid:
                        repeats = _of_words(words, word_runs)
                        if remove_words:
                            at = found.bounds[i] + repeats
                            parts.append((found.starts[at[:, 0]] - bounds[i], found.ends[at[:, 1] - 1] - bounds[i]))
                    columns["n_repeated_words"].append(int((repeats[:, 1] - repeats[:, 0]).sum()))
                    columns["n_word_spans"].append(len(repeats))
                    spans = _covered(*(np.concatenate(side) for side in zip(*parts, strict=True)))
                    edges = [0, *spans.ravel().tolist(), len(text)]
                    kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                    columns["n_bytes"].append(len(text))
                    columns["n_removed"].append(len(text) - len(kept))
                    columns["spans"].append(edges[1:-1])
                    columns["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                    # a cut may leave part of a character, which is dropped from the text
                    columns["kept"].append(kept.decode("utf-8", "ignore") if with_text else None)
                own = [rows.slice(piece.first, len(piece)), *(pa.array(columns[f.name], f.type) for f in list(OUT)[1:])]
                yield pa.RecordBatch.from_arrays(own, schema=OUT)

    return run


def cut_repeats(docs: DataFrame, text: str = "text", width: int = 400, with_text: bool = True, words: int = 0, remove_words: bool = True) -> tuple[DataFrame, DataFrame]:
    """Every text without the bytes of repeated ``width``-byte strings.

    A byte goes if some string of ``width`` bytes that covers it starts at two or more places of
    the input, in one text or in two; overlapping places count, matches never cross texts, and
    strings are judged on the input. Null is an empty text. Repeated rows are separate texts, so
    all their windows repeat. Texts below ``width`` bytes are never changed.

    With ``words``, so do the bytes of every run of so many words (what is between white space, byte
    for byte) that starts at two or more places, however short it is and whatever white space is
    between its words; it goes from the first byte of its first word to the last of its last. Without
    ``remove_words`` such runs are only counted.

    Returns the numbered input (see ``tables.numbered``) and one row per text: ``row_id, n_bytes,
    n_removed, spans`` (start, end, start, end, ... of removed stretches), ``kept_sha256`` (of the
    remaining bytes), ``kept`` (the remaining text, null unless ``with_text``), ``n_repeated_words``
    (words inside repeated runs of ``words`` words) and ``n_word_spans`` (their maximal stretches).
    """
    if not 25 <= width < 1 << 16:
        raise ValueError("width must be between 25 and 65535 bytes")
    if not 0 <= words * UNIT < 1 << 16:
        raise ValueError("words must be between 0 and 8191")
    table, none = bucketed(numbered(docs, text), ROW, "texts"), F.lit(None).cast("long")
    found = repeated(table, width).select(ROW, "at", none.alias("word_at"))
    if words:
        found = found.union(repeated(table, words * UNIT, _as_words).select(ROW, none, "at"))
    found = found.groupBy(ROW).agg(F.collect_list("at").alias("ats"), F.collect_list("word_at").alias("word_ats")).hint("shuffle_hash")
    joined = table.select(ROW, TEXT).join(found, ROW, "left").select(ROW, TEXT, "ats", "word_ats")
    schema = "row_id long, n_bytes long, n_removed long, spans array<long>, kept_sha256 string, kept string, n_repeated_words long, n_word_spans long"
    return table, joined.mapInArrow(_cut(width, words, with_text, remove_words), schema)


def drop_repeats(docs: DataFrame, text: str = "text", width: int = 400, words: int = 0) -> DataFrame:
    """``docs`` with shortened texts; a text that the removal leaves blank goes."""
    table, cut = cut_repeats(docs, text, width, words=words)
    cut = cut.filter("n_removed = 0 OR trim(BOTH ' \t\r\n' FROM kept) <> ''")
    kept = F.when(F.col("n_removed") == 0, F.col(TEXT)).otherwise(F.col("kept"))
    changed = cut.select(ROW, "n_removed", F.when(F.col("n_removed") > 0, F.col("kept")).alias("kept"))
    return table.join(changed, ROW).select(*restored(table, docs.columns, text, kept))


def digest(docs: DataFrame, width: int = 400, words: int = 50) -> DataFrame:
    """One row per document: sizes, number of removed stretches, and the hash of what remains; then
    words inside runs of ``words`` words that start at two or more places, and their stretches, which
    are counted and not removed."""
    table, cut = cut_repeats(docs, "text", width, with_text=False, words=words, remove_words=False)
    ids = table.select(ROW, F.col("rest.doc_id").alias("doc_id"))
    out = cut.join(ids, ROW)
    spans = (F.size("spans") / 2).cast("long")
    return out.select("doc_id", "n_bytes", "n_removed", spans.alias("n_spans"), "kept_sha256", "n_repeated_words", "n_word_spans")
