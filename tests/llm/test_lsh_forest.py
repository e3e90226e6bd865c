"""The LSH forest against brute force, through every one of its steps."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from cases import prose

from starmill.llm import kernel as K, lsh_forest


def shingles(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)] if words else [])


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    smallest = {g: min((m for m in ids if m is not None), default=None) for g, ids in members.items()}
    return [(rows[i][0], len(sets[i]), smallest[find(i)], rows[i][0] == smallest[find(i)]) for i in range(len(rows))]


def key(row):
    return [str(v) for v in row]


def edited(text, rate, seed):
    rng = random.Random(seed)
    return " ".join(f"z{rng.randrange(10**6)}" if rng.random() < rate else w for w in text.split(" "))


def family(seed):
    """Texts around the threshold: stars, chains, short sets, long common passages, equal texts."""
    rng = random.Random(seed)
    rows = []
    for k in range(6):
        hub = prose(seed * 100 + k, rng.choice([10, 14, 40, 150, 400]))
        rows += [hub, hub] + [edited(hub, rng.choice([0.004, 0.01, 0.02, 0.03]), seed * 1000 + 40 * k + i) for i in range(18)]
        chain = hub
        for i in range(6):
            chain = edited(chain, 0.015, seed * 7000 + 40 * k + i) + f" tail{i}"
            rows.append(chain)
    passage = prose(seed + 5000, 150)
    rows += [passage + " " + prose(seed * 300 + i, rng.choice([12, 20, 25, 90])) for i in range(60)]
    rows += [" ".join(f"q{rng.randrange(3)}" for _ in range(rng.randrange(1, 9))) for _ in range(25)]
    return list(enumerate(rows, start=10))


def test_awkward_rows(awkward):
    docs, rows = awkward
    got = sorted((tuple(r) for r in lsh_forest.digest(docs).collect()), key=key)
    assert got == sorted(brute(rows), key=key)


@pytest.mark.parametrize(("crowd", "doubt"), [(lsh_forest.CROWD, lsh_forest.DOUBT), (2, 1e-10)])
def test_families(spark, crowd, doubt):
    """With tiny regions and little doubt allowed, texts go to all depths and into the last step."""
    rows = family(crowd)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(tuple(r) for r in lsh_forest.digest(docs, crowd=crowd, doubt=doubt).collect())
    assert got == sorted(brute(rows))


def test_blocks_alone_find_all_pairs_of_a_region(spark):
    rows = [(i, t, t, 5000 if i < 2500 else 7000, 2900, i < 2000) for i in range(2900) for t in (0, 1)]
    members = spark.createDataFrame(rows, "row_id long, region long, tree int, label long, members long, doubtful boolean")
    signature = np.full(lsh_forest.HASHES, 7, np.uint16).tobytes()
    same, other = (np.array(t, np.uint64).tobytes() for t in ([3, 5, 8], [3, 5, 8, 13]))
    rows = [(i, bytearray(signature), bytearray(other if i % 10 == 0 else same)) for i in range(2900)]
    sets = spark.createDataFrame(rows, "row_id long, signature binary, tokens binary")
    found = lsh_forest._all_across(members, sets, 85)
    assert found.count() == 1800 * 360 + 200 * 40


def test_copies_that_are_alike_through_their_origin_alone(spark):
    """A star of many copies, none linked with another one, among sets that are close and not linked."""
    hub = prose(77, 300)
    rows = [(1000 + i, edited(hub, 0.014, 500 + i)) for i in range(250)] + [(1, hub)]
    rows += [(5000 + i, edited(hub, 0.05, 9000 + i)) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(tuple(r) for r in lsh_forest.digest(docs).collect())
    assert got == sorted(brute(rows)) and sum(c == 1 for _, _, c, _ in got) > 150


def test_signatures_agree_as_often_as_sets():
    """Mean and spread of equal minima of sets of similarity 0.85 over many pairs."""
    rng = np.random.default_rng(3)
    equal = []
    for _ in range(300):
        common, own = 170, 15
        values = rng.integers(1, 1 << 62, common + 2 * own).astype(np.uint64)
        both = np.r_[values[: common + own], values[:common], values[common + own :]]
        one, two = lsh_forest._signatures(both, np.array([0, common + own]))
        equal.append(int((one == two).sum()))
    assert abs(np.mean(equal) - 0.85 * lsh_forest.HASHES) < 1.2
    assert 3 < np.std(equal) < 5.5
    assert min(equal) >= lsh_forest._least_matches(85, lsh_forest.MISS)


def test_keep_one_and_columns(awkward):
    docs, _ = awkward
    out = lsh_forest.keep_one(docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    kept = {r.doc_id for r in out.collect()}
    assert {1, 2, 3, 4, 5, 7, 9, 10, 13} <= kept and not {6, 8} & kept


def test_empty_table(nothing):
    assert lsh_forest.digest(nothing).count() == 0
    assert lsh_forest.keep_one(nothing).columns == nothing.columns


def test_one_long_text_is_worked_on_whole():
    import pyarrow as pa

    text = " ".join(f"w{i}" for i in range(300_000))
    (piece,) = K.texts(pa.array([text]))
    value, bounds = lsh_forest._shingles(piece, 5)
    assert len(value) == 299_996 and bounds.tolist() == [0, 299_996]
