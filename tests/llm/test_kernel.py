"""The numpy helpers against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from starmill.llm import kernel as K

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB0 -\né漢\U0001f600.", max_size=40)), max_size=8)
PATTERNS = {"alnum": (K.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "solid": (K.SOLID, r"[^\x20\x09-\x0D]+")}


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.sampled_from(sorted(PATTERNS)), st.integers(1, 60))
def test_words_and_hashes(texts, kind, size):
    table, pattern = PATTERNS[kind]
    if kind == "alnum":
        table = table | K._bytes_where(lambda b: 65 <= b <= 90)
    seen = {}
    column = pa.array([None, *texts], pa.string()).slice(1)
    rows = 0
    for piece in K.texts(column, size):
        found = K.words(piece, table)
        hashes = K.word_hashes(piece, found)
        for i in range(len(piece)):
            raw = bytes(piece.data[piece.offsets[i] : piece.offsets[i + 1]])
            assert raw == (texts[piece.first + i] or "").encode()
            a, b = found.bounds[i], found.bounds[i + 1]
            got = [lower(bytes(piece.data[s:e]).decode()) for s, e in zip(found.starts[a:b], found.ends[a:b])]
            assert got == re.findall(pattern, lower(raw.decode()))
            for word, value in zip(got, hashes[a:b].tolist()):
                assert seen.setdefault(word, value) == value
            rows += 1
    assert rows == len(texts)
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=60), st.integers(1, 20))
def test_sliding_min(values, width):
    got = K.sliding_min(np.array(values, np.uint64), width).tolist()
    assert got == [min(values[i : i + width]) for i in range(len(values) - width + 1)]


def test_grams_are_equal_for_equal_words_only():
    piece = next(K.texts(pa.array(["a b c a b c d", "b c a"])))
    found = K.words(piece, K.SOLID)
    grams = K.grams(K.word_hashes(piece, found), 3)
    assert grams[0] == grams[3] and grams[7] == grams[1] and len(set(grams[:5].tolist())) == 4


def test_ranges():
    assert K.ranges(np.array([5, 9, 2]), np.array([2, 0, 3])).tolist() == [5, 6, 2, 3, 4]
