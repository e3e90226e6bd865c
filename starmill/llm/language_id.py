"""Language of texts by Viterbi over words, with script ranges to narrow the candidates.

Words are runs of letters. A word scores, for each language, the log probability of its character
trigrams and of the whole word, both hashed into one table of counts that is learned here from all
labelled texts. The script of its letters first narrows the languages a word can have. Viterbi with
a fixed penalty for each switch then labels the words, so that mixed texts fall into spans and short
borrowed words do not break one. The language with most letters in its spans is the text's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from starmill.llm import kernel as K
from starmill.llm.tables import ROW, TEXT

FEATURES = 1 << 15  # hash buckets of trigrams, and as many of whole words
SCRIPTS = 16
WIDTH = 2 * FEATURES + SCRIPTS
SMOOTHING = 0.5
SWITCH = 12.0  # log probability that a change of language between two words costs
RARE_SCRIPT = 0.01  # a language has the scripts of at least this share of its words
IMPOSSIBLE = -1e4
MOST_LANGUAGES = 512  # languages that are learned: those with most texts
PIECE = 1 << 22  # bytes of text worked on at a time with few languages

LETTERS = K._bytes_where(lambda b: b >= 0x80 or chr(b).isalpha())

# First UTF-8 bytes of the main block of each script. Latin is 0, as are bytes that
# begin no letter of those listed.
SCRIPT_OF = np.zeros(256, np.uint8)
for _script, (_first, _last) in enumerate(
    [
        (0xCE, 0xCF),  # Greek
        (0xD0, 0xD3),  # Cyrillic
        (0xD4, 0xD5),  # Armenian
        (0xD6, 0xD7),  # Hebrew
        (0xD8, 0xDB),  # Arabic
        (0xDC, 0xDF),  # Syriac, Thaana, N'Ko
        (0xE0, 0xE0),  # Brahmic scripts, Thai, Lao
        (0xE1, 0xE1),  # Georgian, Khmer, Mongolian, Hangul jamo
        (0xE3, 0xE3),  # Kana
        (0xE4, 0xE9),  # Han
        (0xEA, 0xED),  # Hangul
    ],
    start=1,
):
    SCRIPT_OF[_first : _last + 1] = _script


def _features(piece: K.Texts) -> tuple[K.Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words, the trigram bucket of every byte, the bucket and the script of every word."""
    found = K.words(piece, LETTERS)
    low = K.LOWER[piece.data].astype(np.uint32)
    before, after = np.empty_like(low), np.empty_like(low)
    before[1:], after[:-1] = low[:-1], low[1:]
    before[found.starts], after[found.ends - 1] = 32, 32
    if len(low):
        before[0] = after[-1] = 32
    code = (before << np.uint32(16)) | (low << np.uint32(8)) | after
    trigram = (code * np.uint32(2654435761)) >> np.uint32(32 - FEATURES.bit_length() + 1)
    whole = (K.word_hashes(piece, found) >> K.U(64 - FEATURES.bit_length() + 1)).astype(np.int64) + FEATURES
    if len(found.starts):
        script = np.maximum.reduceat(SCRIPT_OF[piece.data], found.starts)
    else:
        script = np.zeros(0, np.uint8)
    return found, trigram.astype(np.int64), whole, script.astype(np.int64)


def _inside(piece: K.Texts, found: K.Words) -> np.ndarray:
    """For every byte the text it is in if it belongs to a word, else -1."""
    text = np.full(len(piece.data), -1, np.int64)
    at = K.ranges(found.starts, found.ends - found.starts)
    text[at] = np.repeat(found.text_of(), found.ends - found.starts)
    return text


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feature counts of one task's texts by language: (lang, feature, n)."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        encoded = batch.column(1).dictionary_encode()
        names, codes = encoded.dictionary.to_pylist(), encoded.indices.to_numpy()
        for piece in K.texts(batch.column(0)):
            found, trigram, whole, script = _features(piece)
            used, own = np.unique(codes[piece.first : piece.first + len(piece)], return_inverse=True)
            text = _inside(piece, found)
            inside = text >= 0
            word_lang = own[found.text_of()]
            flat = np.concatenate(
                [own[text[inside]] * WIDTH + trigram[inside], word_lang * WIDTH + whole, word_lang * WIDTH + 2 * FEATURES + script]
            )
            table = np.bincount(flat, minlength=len(used) * WIDTH).reshape(len(used), WIDTH)
            for i, code in enumerate(used.tolist()):
                totals[names[code]] = totals.get(names[code], 0) + table[i]
    for name, table in totals.items():
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(table[at].astype(np.int64))], names=["lang", "feature", "n"]
        )


class Model:
    """Log probabilities by language; small and of fixed width, sent to every task."""

    def __init__(self, names: list[str], counts: np.ndarray):
        self.names = names
        self.log = np.zeros((len(names), 2 * FEATURES), np.float32)
        for kind in (slice(0, FEATURES), slice(FEATURES, 2 * FEATURES)):
            smooth = counts[:, kind] + SMOOTHING
            self.log[:, kind] = np.log(smooth / smooth.sum(axis=1, keepdims=True))
        scripts = counts[:, 2 * FEATURES :]
        share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
        self.allowed = share >= RARE_SCRIPT  # (language, script)

    def word_scores(self, piece: K.Texts) -> tuple[K.Words, np.ndarray]:
        """(word, language) log probabilities."""
        found, trigram, whole, script = _features(piece)
        scores = np.empty((len(found.starts), len(self.names)))
        at = K.ranges(found.starts, found.ends - found.starts)
        trigram, begins = trigram[at], np.r_[0, np.cumsum(found.ends - found.starts)[:-1]]
        possible = self.allowed[:, script].T if len(found.starts) else np.zeros(scores.shape, bool)
        possible[~possible.any(axis=1)] = True
        for i, log in enumerate(self.log):
            if len(found.starts):
                scores[:, i] = np.add.reduceat(log[trigram], begins) + log[whole]
        scores[~possible] += IMPOSSIBLE
        return found, scores


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", most: int = MOST_LANGUAGES) -> Model:
    """Count features of all texts with a language. The driver gets sums: at most ``WIDTH`` numbers
    for each of at most ``most`` languages. If there are more, as in a dirty column, those with most
    texts are learned, ties by name; the others are no language that is ever predicted."""
    known = docs.select(F.col(f"`{text}`"), F.col(f"`{lang}`")).dropna()
    frequent = known.groupBy(f"`{lang}`").count().orderBy(F.desc("count"), f"`{lang}`").limit(most).select(F.col(f"`{lang}`").alias("_lang")).collect()
    kept = docs.sparkSession.createDataFrame(frequent, "_lang string")  # at most ``most`` rows
    known = known.join(F.broadcast(kept), F.col(f"`{lang}`") == F.col("_lang"), "left_semi")
    counted = known.mapInArrow(_counts, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    rows = counted.toPandas()
    names = sorted(set(rows["lang"]))
    counts = np.zeros((len(names), WIDTH))
    counts[rows["lang"].map({n: i for i, n in enumerate(names)}).to_numpy(int), rows["feature"].to_numpy(int)] = rows["n"].to_numpy()
    return Model(names, counts)


def viterbi(scores: np.ndarray, bounds: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best language of each word of many texts at once; text i has words bounds[i]:bounds[i + 1].

    Texts are walked in step, longest first, so each step is one operation on all that still run.
    """
    lengths = np.diff(bounds)
    order = np.argsort(-lengths, kind="stable")
    lengths, first = lengths[order], bounds[:-1][order]
    steps = int(lengths[0]) if len(lengths) else 0
    alive = np.searchsorted(-lengths, -np.arange(steps), "left")  # texts with more than t words
    start = np.r_[0, np.cumsum(alive)]
    where = np.concatenate([first[:n] + t for t, n in enumerate(alive.tolist())]) if steps else np.zeros(0, np.int64)
    timed = scores[where]
    stay = np.ones(timed.shape, bool)
    leader = np.zeros(len(where), np.int64)
    best = np.zeros((len(lengths), scores.shape[1]))
    for t in range(steps):
        n, at = alive[t], slice(start[t], start[t + 1])
        own = best[:n]
        if t:
            top = own.argmax(axis=1)
            jump = own[np.arange(n), top] - switch
            leader[at] = top
            np.greater_equal(own, jump[:, None], out=stay[at])
            np.maximum(own, jump[:, None], out=own)
        own += timed[at]
    state = best.argmax(axis=1)
    label = np.zeros(len(where), np.int64)
    for t in range(steps - 1, -1, -1):
        n, at = alive[t], slice(start[t], start[t + 1])
        own = state[:n]
        label[at] = own
        if t:
            state[:n] = np.where(stay[at][np.arange(n), own], own, leader[at])
    out = np.empty(len(where), np.int64)
    out[where] = label
    return out


PREDICTED = "row_id long, lang_pred string, score double, spans array<struct<lang:string,first_byte:long,last_byte:long>>"
SPAN = pa.struct([("lang", pa.string()), ("first_byte", pa.int64()), ("last_byte", pa.int64())])


def _predict(model, with_spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = model.value
        for batch in batches:
            has_letter = batch.column(2).to_numpy(zero_copy_only=False)
            # words times languages are held at once, about as many for many languages as for sixteen
            for piece in K.texts(batch.column(1), min(PIECE, 16 * PIECE // len(own.names))):
                found, scores = own.word_scores(piece)
                label = viterbi(scores, found.bounds)
                text, size, langs = found.text_of(), found.ends - found.starts, len(own.names)
                letters = np.bincount(text * langs + label, weights=size, minlength=len(piece) * langs).reshape(len(piece), langs)
                total = letters.sum(axis=1)
                known = has_letter[piece.first : piece.first + len(piece)].astype(bool) & (total > 0)
                top = letters.argmax(axis=1)
                share = np.where(known, letters.max(axis=1) / np.maximum(total, 1), 0.0)
                spans = _spans(piece, found, text, label, known, own.names) if with_spans else [None] * len(piece)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(piece.first, len(piece)),
                        pa.array([own.names[t] if k else "und" for t, k in zip(top.tolist(), known.tolist(), strict=True)], pa.string()),
                        pa.array(share),
                        pa.array(spans, pa.list_(SPAN)),
                    ],
                    names=["row_id", "lang_pred", "score", "spans"],
                )

    return run


def _spans(piece: K.Texts, found: K.Words, text: np.ndarray, label: np.ndarray, known: np.ndarray, names: list[str]) -> list[list]:
    out: list[list] = [[] for _ in range(len(piece))]
    if not len(label):
        return out
    first = np.flatnonzero(np.r_[True, (label[1:] != label[:-1]) | (text[1:] != text[:-1])])
    last = np.r_[first[1:] - 1, len(label) - 1]
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        i = int(text[a])
        if known[i]:
            offset = int(piece.offsets[i])
            out[i].append({"lang": names[label[a]], "first_byte": int(found.starts[a]) - offset, "last_byte": int(found.ends[b]) - offset})
    return out


def identify(table: DataFrame, model: Model, with_spans: bool = True) -> DataFrame:
    """Language of each text of a numbered table: ``row_id, lang_pred, score, spans``.

    ``score`` is the share of the text's letters in spans of ``lang_pred``. A null text, a text
    without a letter, or any text when nothing was learned, is ``und`` with score 0.
    ``spans`` cover the words in order (bytes from, to; null unless asked for).
    """
    if not model.names:
        return table.select(ROW, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.array().cast("array<struct<lang:string,first_byte:long,last_byte:long>>").alias("spans"))
    shared = table.sparkSession.sparkContext.broadcast(model)
    letter = F.coalesce(F.col(TEXT).rlike(r"\p{L}"), F.lit(False)).alias("has_letter")
    return table.select(ROW, TEXT, letter).mapInArrow(_predict(shared, with_spans), PREDICTED)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: whether it was held out from learning, its language and the score."""
    model = learn(docs.filter(fold(F.col("doc_id")) != 0))
    table = docs.select(F.col("doc_id").alias(ROW), F.col("text").alias(TEXT))
    return identify(table, model, with_spans=False).select(
        F.col(ROW).alias("doc_id"), (fold(F.col(ROW)) == 0).alias("held_out"), "lang_pred", "score"
    )


def keep_known(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", least: float = 0.5) -> DataFrame:
    """``docs`` without those of no known language: ``und``, or with less than the share ``least``
    of their letters in one language. Learns from the documents themselves, as ``digest`` does."""
    model = learn(docs.filter(fold(F.col(f"`{doc_id}`")) != 0), text, lang)
    if not model.names:
        return docs.filter(F.lit(False))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    predict, at = _predict(shared, False), docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, letter = batch.columns
            whole = pa.RecordBatch.from_arrays([pa.array(np.arange(len(batch))), row.field(at), letter], names=[ROW, TEXT, "letter"])
            for found in predict(iter([whole])):
                known = pc.and_(pc.not_equal(found.column(1), "und"), pc.greater_equal(found.column(2), least))
                yield pa.RecordBatch.from_arrays([row.take(found.column(0).filter(known))], names=["row"])

    letter = F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), letter.alias("letter"))
    schema = T.StructType([T.StructField("row", docs.schema)])
    return packed.mapInArrow(keep, schema).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
