"""Benchmark decontamination by winnowing.

A *window* is ``size`` consecutive words of a benchmark item, or all words of a shorter item. Both
sides keep, for every ``w`` consecutive k-grams, the one with the smallest hash (leftmost on ties),
with ``k + w - 1 = size``. So each occurrence of a window in a document has the window's own
smallest k-gram at the same offset, among the fingerprints of the document: the guarantee of
winnowing, used here to miss nothing. Matches are then extended to the whole window and compared
there by two independent 64-bit hashes.

Short items have windows of their own lengths; each length present gets its own fingerprints.

Only the fingerprints of documents meet those of the benchmark; the planner broadcasts the latter
if they measure small, and shuffles both otherwise. Lists per document are bounded by its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starmill.llm import kernel as K
from starmill.llm.tables import REST, ROW, TEXT, bucketed, numbered, restored, staged


def _scheme(size: int) -> tuple[int, int]:
    """(k, w) for windows of ``size`` words."""
    k = (size + 1) // 2
    return k, size - k + 1


def _hashes(piece: K.Texts, found: K.Words) -> list[np.ndarray]:
    return [K.word_hashes(piece, found, lane) for lane in (0, 1)]


def _smallest(hashes: np.ndarray, size: int) -> np.ndarray:
    """For each start of ``size`` words, the place of its fingerprint (starts across texts included)."""
    k, w = _scheme(size)
    grams = K.grams(hashes, k)
    order = (grams & K.U(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    return (K.sliding_min(order, w) & K.U(0xFFFFFFFF)).astype(np.int64)


def _window_hashes(hashes: list[np.ndarray], size: int) -> list[np.ndarray]:
    return [K.signed(K.grams(h, size, lane)) for lane, h in enumerate(hashes)]


WINDOW = "item_row long, size int, print long, offset int, hash_a long, hash_b long"
WINDOW_TYPES = {
    "item_row": pa.int64(),
    "size": pa.int32(),
    "print": pa.int64(),
    "offset": pa.int32(),
    "hash_a": pa.int64(),
    "hash_b": pa.int64(),
}


def _item_windows(longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for piece in K.texts(batch.column(1)):
                found = K.words(piece, K.ALNUM)
                hashes, counts, left = _hashes(piece, found), found.counts(), found.remaining()
                text = found.text_of()
                sizes = np.minimum(counts, longest)
                for size in np.unique(sizes[sizes > 0]).tolist():
                    starts = np.flatnonzero((sizes[text] == size) & (left >= size))
                    place = _smallest(hashes[0], size)[starts]
                    hash_a, hash_b = _window_hashes(hashes, size)
                    out = {
                        "item_row": rows[piece.first + text[starts]],
                        "size": np.full(len(starts), size),
                        "print": K.signed(K.grams(hashes[0], _scheme(size)[0]))[place],
                        "offset": place - starts,
                        "hash_a": hash_a[starts],
                        "hash_b": hash_b[starts],
                    }
                    yield from K.chunks(out, WINDOW_TYPES)

    return run


PRINT_TYPES = {"row_id": pa.int64(), "size": pa.int32(), "print": pa.int64(), "place": pa.int32()}


def _fingerprints(sizes: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for piece in K.texts(batch.column(1)):
                found = K.words(piece, K.ALNUM)
                hashes, left, text = K.word_hashes(piece, found), found.remaining(), found.text_of()
                for size in sizes:
                    starts = np.flatnonzero(left >= size)
                    if not len(starts):
                        continue
                    places = _smallest(hashes, size)[starts]
                    places = places[np.r_[True, places[1:] != places[:-1]]]
                    out = {
                        "row_id": rows[piece.first + text[places]],
                        "size": np.full(len(places), size),
                        "print": K.signed(K.grams(hashes, _scheme(size)[0]))[places],
                        "place": places - found.bounds[text[places]],
                    }
                    yield from K.chunks(out, PRINT_TYPES)

    return run


CHECKED = "row_id long, size int, start int, hash_a long, hash_b long"
CHECKED_TYPES = {"row_id": pa.int64(), "size": pa.int32(), "start": pa.int32(), "hash_a": pa.int64(), "hash_b": pa.int64()}


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of the whole window at each candidate start; for each text a row of size 0 with its word count."""
    for batch in batches:
        rows, lists = batch.column(0).to_numpy(), batch.column(2)
        for piece in K.texts(batch.column(1)):
            found = K.words(piece, K.ALNUM)
            counts = found.counts()
            none = np.zeros(len(piece), np.int64)
            out = {"row_id": rows[piece.first : piece.first + len(piece)], "size": none, "start": counts, "hash_a": none, "hash_b": none}
            yield from K.chunks(out, CHECKED_TYPES)
            own = lists.slice(piece.first, len(piece))
            each = np.asarray(own.value_lengths().fill_null(0))
            if not each.sum():
                continue
            text = np.repeat(np.arange(len(piece)), each)
            code = np.asarray(own.flatten())
            hashes = _hashes(piece, found)
            for size in np.unique(code & 0xFFFF).tolist():
                at = (code & 0xFFFF) == size
                here, start = text[at], code[at] >> 16
                fits = (start >= 0) & (start + size <= counts[here])
                here, start = here[fits], start[fits]
                hash_a, hash_b = _window_hashes(hashes, size)
                places = found.bounds[here] + start
                out = {
                    "row_id": rows[piece.first + here],
                    "size": np.full(len(here), size),
                    "start": start,
                    "hash_a": hash_a[places],
                    "hash_b": hash_b[places],
                }
                yield from K.chunks(out, CHECKED_TYPES)


def item_windows(items: DataFrame, text: str, size: int) -> DataFrame:
    """All windows of all items, with ``rest`` holding the item's other columns."""
    rows = staged(numbered(items, text), "items")
    windows = rows.select(ROW, TEXT).mapInArrow(_item_windows(size), WINDOW)
    return staged(windows.join(rows.select(F.col(ROW).alias("item_row"), REST), "item_row"), "windows")


def matches(table: DataFrame, windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(row_id, size, start, hash_a, hash_b)`` of every occurrence of a window in a numbered,
    bucketed table, and ``(row_id, n_words)`` of every text."""
    sizes = [r[0] for r in windows.select("size").distinct().collect()]  # at most the window size
    wanted = windows.select("size", "print", "offset").distinct()
    prints = table.select(ROW, TEXT).mapInArrow(_fingerprints(sizes), "row_id long, size int, print long, place int")
    code = (F.col("place") - F.col("offset")).cast("long") * 65536 + F.col("size")
    starts = prints.join(wanted, ["size", "print"]).groupBy(ROW).agg(F.collect_list(code).alias("starts"))
    extended = table.select(ROW, TEXT).join(starts.hint("shuffle_hash"), ROW, "left").select(ROW, TEXT, "starts")
    checked = staged(extended.mapInArrow(_extended, CHECKED), "extended")
    real = windows.select("size", "hash_a", "hash_b").distinct()
    found = checked.filter("size > 0").join(real, ["size", "hash_a", "hash_b"]).select(*checked.columns).distinct()
    return staged(found, "matches"), checked.filter("size = 0").select(ROW, F.col("start").cast("long").alias("n_words"))


def _union_length(spans: Column) -> Column:
    """Number of places that sorted (start, size) spans cover."""
    start = F.struct(F.lit(0).alias("covered"), F.lit(-1).alias("end"))

    def add(acc: Column, span: Column) -> Column:
        end = span["start"] + span["size"]
        more = F.greatest(end - F.greatest(acc["end"], span["start"]), F.lit(0))
        return F.struct((acc["covered"] + more).alias("covered"), F.greatest(acc["end"], end).alias("end"))

    return F.aggregate(spans, start, add, lambda acc: acc["covered"])


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id", size: int = 10) -> tuple[DataFrame, DataFrame]:
    """Which words of each document lie in an occurrence of a benchmark window.

    Words are runs of digits, letters and non-ASCII characters with A-Z lower-cased; null has none,
    and a text or item without words hits nothing. Repeated items with one id count once; items
    whose id is null hit words but are not listed. Overlapping windows count a word once.

    Returns the numbered documents and one row per document: ``row_id, n_words, n_hit, items``
    (distinct ids as sorted strings), ``spans`` (sorted (start, size) of all occurrences).
    """
    table = bucketed(numbered(docs, text), ROW, "texts")
    windows = item_windows(items, item_text, size)
    found, sizes = matches(table, windows)
    spans = F.array_sort(F.collect_list(F.struct("start", "size"))).alias("spans")
    by_text = found.groupBy(ROW).agg(spans)
    owners = windows.select("size", "hash_a", "hash_b", F.col(REST)[item_id].cast("string").alias("item")).distinct()
    pairs = found.select(ROW, "size", "hash_a", "hash_b").distinct().join(owners.filter("item IS NOT NULL"), ["size", "hash_a", "hash_b"])
    listed = pairs.select(ROW, "item").distinct().groupBy(ROW).agg(F.array_sort(F.collect_list("item")).alias("items"))
    joined = sizes.join(by_text, ROW, "left").join(listed, ROW, "left")
    none = F.array().cast("array<string>")
    hit = F.coalesce(_union_length(F.col("spans")), F.lit(0)).cast("long").alias("n_hit")
    return table, joined.select(ROW, "n_words", hit, F.coalesce("items", none).alias("items"), "spans")


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", size: int = 10) -> DataFrame:
    """``docs`` without the documents in which a benchmark window occurs."""
    table, marked = contamination(docs, items, text, size=size)
    clean = marked.filter("n_hit = 0").select(ROW)
    return table.join(clean, ROW).select(*restored(table, docs.columns, text))


def digest(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """One row per document: words, words hit, items hit and the hash of their ids."""
    table, marked = contamination(docs, items, size=size)
    ids = table.select(ROW, F.col(REST)["doc_id"].alias("doc_id"))
    return marked.join(ids, ROW).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
