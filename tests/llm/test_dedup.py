"""Suffix dedup and the Jaccard join against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import prose

from starmill.llm import jaccard_join, suffix_dedup


def brute_cut(texts, width):
    raw = [t.encode() for t in texts]
    seen = Counter(b[i : i + width] for b in raw for i in range(len(b) - width + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if seen[b[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def key(row):
    return [str(v) for v in row]


def brute_words(texts, n):
    """Words in runs of n words that start at two or more places, and their maximal stretches."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    seen = Counter(tuple(w[i : i + n]) for w in words for i in range(len(w) - n + 1))
    out = []
    for w in words:
        hit = {j for i in range(len(w) - n + 1) if seen[tuple(w[i : i + n])] > 1 for j in range(i, i + n)}
        out.append((len(hit), sum(j - 1 not in hit for j in hit)))
    return out


@pytest.mark.parametrize("n", [50, 20])
def test_repeated_words_match_brute_force(awkward, n):
    docs, rows = awkward
    got = [(r.doc_id, r.n_repeated_words, r.n_word_spans) for r in suffix_dedup.digest(docs, words=n).collect()]
    expected = [(i, *found) for (i, _), found in zip(rows, brute_words([t for _, t in rows], n))]
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert any(count for _, count, _ in got)


def test_short_passages_of_over_fifty_words_are_counted(spark):
    """51 short words are less than 400 bytes: no byte goes, and the words are counted all the same."""
    passage = " ".join(f"p{i}" for i in range(51))
    texts = [prose(800 + i, 40) + " " + passage.replace(" ", "\n" if i else " ") + " " + prose(900 + i, 40) for i in range(3)] + [prose(1, 300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r.doc_id, r.n_removed, r.n_repeated_words, r.n_word_spans) for r in suffix_dedup.digest(docs).collect())
    assert got == [(0, 0, 51, 1), (1, 0, 51, 1), (2, 0, 51, 1), (3, 0, 0, 0)]


CONTRACT = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


@pytest.mark.parametrize("width", [400, 60])
def test_cut_matches_brute_force(awkward, width):
    docs, rows = awkward
    got = sorted((tuple(r) for r in suffix_dedup.digest(docs, width).select(*CONTRACT).collect()), key=key)
    expected = [(i, *cut) for (i, _), cut in zip(rows, brute_cut([t for _, t in rows], width))]
    assert got == sorted(expected, key=key)


def test_cut_of_many_overlapping_copies(spark):
    rng = random.Random(3)
    base = prose(11, 150)
    texts = [base[rng.randrange(300) :] + prose(100 + i, 10) + base[: rng.randrange(700)] for i in range(60)]
    texts += ["ab" * 400, "ab" * 250 + "c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = sorted(tuple(r) for r in suffix_dedup.digest(docs, 100).select(*CONTRACT).collect())
    assert got == [(i, *cut) for i, cut in enumerate(brute_cut(texts, 100))]


def test_drop_repeats_keeps_columns_and_clean_texts(awkward):
    docs, rows = awkward
    out = suffix_dedup.drop_repeats(docs, width=60)
    assert out.schema.simpleString() == docs.schema.simpleString()
    kept = {r.doc_id: r for r in out.collect()}
    assert kept[13].text == dict(rows)[13] and kept[13].label == "l" and kept[13].row_id == 5
    assert kept[1].text is None and kept[2].text == ""
    assert 7 not in kept and 10 not in kept  # nothing is left of them


def test_empty_tables(nothing):
    assert suffix_dedup.digest(nothing).count() == 0
    assert suffix_dedup.drop_repeats(nothing).columns == nothing.columns
    assert jaccard_join.digest(nothing).count() == 0
    assert jaccard_join.keep_one(nothing).columns == nothing.columns


def shingles(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)] if words else [])


def brute_groups(rows):
    """Smallest id reachable by links, for each row."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    smallest = {g: min((m for m in ids if m is not None), default=None) for g, ids in members.items()}
    return [(rows[i][0], len(sets[i]), smallest[find(i)]) for i in range(len(rows))]


def test_components_match_brute_force(awkward):
    docs, rows = awkward
    got = sorted((tuple(r) for r in jaccard_join.digest(docs).collect()), key=key)
    assert got == sorted(brute_groups(rows), key=key)


def edited(text, rate, seed):
    rng = random.Random(seed)
    return " ".join(f"z{rng.randrange(10**6)}" if rng.random() < rate else w for w in text.split(" "))


def family(seed):
    """Texts around the threshold: stars, chains, short sets, shared passages, different sizes."""
    rng = random.Random(seed)
    rows = []
    for k in range(6):
        hub = prose(seed * 100 + k, rng.choice([6, 9, 14, 40, 150]))
        rows += [hub] + [edited(hub, rng.choice([0.01, 0.03, 0.05, 0.08]), seed * 1000 + 40 * k + i) for i in range(18)]
        chain = hub
        for i in range(6):
            chain = edited(chain, 0.04, seed * 7000 + 40 * k + i) + f" tail{i}"
            rows.append(chain)
        rows.append(hub + " " + prose(seed * 900 + k, max(1, len(hub.split()) // 4)))
    passage = prose(seed + 5000, 30)
    rows += [passage + " " + prose(seed * 300 + i, 25) for i in range(20)]
    rows += [" ".join(f"q{rng.randrange(3)}" for _ in range(rng.randrange(1, 9))) for _ in range(25)]
    return list(enumerate(rows, start=10))


@pytest.mark.parametrize("few", [8, 2])
def test_components_of_families_match_brute_force(spark, few):
    """With few = 2 nearly all signatures go through stars and the last step."""
    rows = family(few)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(tuple(r) for r in jaccard_join.digest(docs, few=few).collect())
    assert got == sorted(brute_groups(rows))


def test_every_linked_pair_shares_a_posted_signature():
    """Step 2 of the method on random sets at every size, without the later steps."""
    rng = np.random.default_rng(5)
    for _ in range(400):
        both = int(rng.integers(1, 60))
        a = int(rng.integers(0, both // 3 + 1))
        b = int(rng.integers(0, both // 3 + 1))
        tokens = rng.integers(1, 1 << 62, both + a + b).astype(np.uint64)
        x, y = np.sort(tokens[: both + a]), np.sort(np.r_[tokens[:both], tokens[both + a :]])
        if 100 * both >= 75 * (both + a + b) and a + b:
            signatures, owner = jaccard_join._posted(np.r_[x, y], np.array([0, len(x), len(x) + len(y)]))
            assert set(signatures[owner == 0].tolist()) & set(signatures[owner == 1].tolist())


def test_keep_one_keeps_the_smallest_id_of_each_group(awkward):
    docs, rows = awkward
    out = jaccard_join.keep_one(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    kept = sorted(r.doc_id for r in out.collect() if r.doc_id is not None)
    assert 7 in kept and 8 not in kept and 5 in kept and 6 not in kept
    assert {1, 2, 3, 4, 9, 10, 11, 13, 14, 17} <= set(kept)


def test_texts_that_can_be_linked_with_equal_ones_only(spark):
    """Texts of 1 to 6 words have one or two shingles and post no signature."""
    rows = [(i, " ".join(f"q{i % 5}{j}" for j in range(1 + i % 6))) for i in range(40)] + [(50, ""), (51, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = sorted(brute_groups([(i, t or "") for i, t in rows]), key=key)
    for parts in (1, len(rows)):  # one text in a partition, too
        assert sorted((tuple(r) for r in jaccard_join.digest(docs.repartition(parts)).collect()), key=key) == expected
    kept = [r.doc_id for r in jaccard_join.keep_one(docs).collect()]
    assert sorted(kept) == sorted({c for _, n, c in expected if n} | {50, 51})


@pytest.mark.parametrize("width", [25, 40, 62, 64])
def test_narrow_cut_matches_brute_force(spark, width):
    """Equal windows behind different bytes, among many other windows of the same anchors."""
    rng = random.Random(width)
    base = "".join(rng.choice("abcdefgh") for _ in range(200))
    texts = []
    for i in range(120):
        a = rng.randrange(100)
        texts.append(f"{rng.random()}" + base[a : a + rng.randrange(20, 90)] + f"{rng.random()}")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = sorted(tuple(r) for r in suffix_dedup.digest(docs, width).select(*CONTRACT).collect())
    assert got == [(i, *cut) for i, cut in enumerate(brute_cut(texts, width))]
