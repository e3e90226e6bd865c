"""Winnowing against brute force, with items shorter than a window, repeated items and null ids."""

import hashlib
import re

import pytest
from cases import prose

from starmill.llm import decontaminate


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        m = min(size, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[i : i + m]), set()).add(item)
    out = []
    for doc, text in rows:
        w = words(text)
        hit, found = [False] * len(w), set()
        for m in {len(k) for k in windows}:
            for i in range(len(w) - m + 1):
                if tuple(w[i : i + m]) in windows:
                    found |= windows[tuple(w[i : i + m])]
                    hit[i : i + m] = [True] * m
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(w), sum(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), any(hit)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def items(spark, awkward):
    _, docs = awkward
    texts = dict(docs)
    rows = [
        (1, " ".join(texts[7].split()[5:40])),
        (2, " ".join(texts[7].split()[30:44])),
        (20, "one two three"),
        (3, "größe 漢字"),
        (3, "größe 漢字"),
        (4, "CC BY"),
        (5, None),
        (6, " -- "),
        (None, "the MIT license"),
        (100, " ".join(texts[13].split()[19_950:])),
        (7, "x"),
        (8, prose(99, 30)),
    ]
    return spark.createDataFrame([(i, t, 1) for i, t in rows], "item_id long, text string, row_id int"), rows


def test_against_brute_force(awkward, items):
    docs, rows = awkward
    got = decontaminate.digest(docs, items[0]).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, items[1])


def test_drops_exactly_the_contaminated(awkward, items):
    docs, rows = awkward
    out = decontaminate.drop_contaminated(docs, items[0])
    assert out.schema.simpleString() == docs.schema.simpleString()
    clean = sorted((r[0] for r in brute(rows, items[1]) if not r[5]), key=str)
    assert sorted((r.doc_id for r in out.collect()), key=str) == clean


def test_empty_sides(awkward, nothing, items):
    docs, rows = awkward
    assert decontaminate.digest(nothing, items[0]).count() == 0
    none = items[0].filter("false")
    assert decontaminate.drop_contaminated(docs, none).count() == len(rows)
    assert not any(r.contaminated for r in decontaminate.digest(docs, none).collect())
