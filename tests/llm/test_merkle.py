"""Merkle manifest against a plain loop, and its proofs as a reader uses them."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from starmill.llm import merkle
from starmill.llm.sequences import running


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def way(levels, i):
    out = []
    for nodes in levels[:-1]:
        first = i // 8 * 8
        out.append(("".join(nodes[first:i]), "".join(nodes[i + 1 : first + 8])))
        i //= 8
    return out


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def brute(rows):
    """rows of (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append((row[0] is not None, row[0] or 0, h(*map(field, row)), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels_of([leaf for *_, leaf, _ in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    top = levels_of([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for i, (has_id, _, leaf, row) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            path = way(trees[g], i) + way(top, k)
            node, text = leaf, row[4]
            if has_id and zlib.crc32(str(row[0]).encode()) % 3 == 0 and text is not None:
                lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
                node = h(*map(field, (*row[:4], lowered)))
            for left, right in path:
                node = h(left, node, right)
            root = top[-1][0]
            out.append((row[0], leaf, trees[g][-1][0], root, h(*(a + b for a, b in path)), node, node == root))
    return out


def key(row):
    return [str(v) for v in row]


FIELDS = "doc_id long, source string, lang string, n_chars long, text string"


def test_awkward_rows_match_the_loop(awkward):
    docs, _ = awkward
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = [tuple(r) for r in merkle.digest(docs).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def sized(sizes, groups):
    return [(1000 * k + 7 * i, f"s{i % 3}", g, i, f"Text {k} {i}") for k, (n, g) in enumerate(zip(sizes, groups)) for i in range(n)]


@pytest.mark.parametrize(
    "sizes",
    [[1], [64, 9, 1], [1] * 70, [512 * 9 + 1, 512 * 8, 512, 513, 512 * 65 + 100]],
)
def test_ragged_trees_match_the_loop(spark, sizes):
    """One leaf, full and ragged blocks, ragged butterflies of two and three rounds, many groups."""
    rows = sized(sizes, [None, "", *(f"g{i:03}" for i in range(100))])
    docs = spark.createDataFrame(rows, FIELDS).repartition(6)
    got = sorted((tuple(r) for r in merkle.digest(docs).collect()), key=key)
    assert got == sorted(brute(rows), key=key)
    assert {zlib.crc32(str(i).encode()) % 3 > 0 for i, *_, verified in got if verified} <= {True}


def test_readers_check_rows_with_their_path(spark):
    rows = sized([700, 5], ["a", None])
    docs = spark.createDataFrame(rows, FIELDS)
    leaf = merkle.leaf_of([F.col(c) for c in merkle.FIELDS])
    out = merkle.proofs(docs, "doc_id", "lang", leaf, with_path=True)
    assert out.filter(merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).count() == 705
    assert out.filter("verified AND folded_root = root").count() == 705
    assert out.filter(merkle.fold(F.reverse("leaf"), F.col("path")) == F.col("root")).count() == 0


def test_repeated_rows_are_leaves_of_their_own(spark):
    rows = [(1, "a", "x", 1, "same")] * 1500 + [(2, "a", "x", 1, "Other")]
    got = sorted((tuple(r) for r in merkle.digest(spark.createDataFrame(rows, FIELDS)).collect()), key=key)
    assert got == sorted(brute(rows), key=key)


def test_empty_table(nothing):
    assert merkle.digest(nothing).count() == 0


def test_running_totals_across_partitions(spark):
    """One group over all partitions, small ones between, negative values."""
    rows = [("hot" if i % 3 else f"g{i % 60}", i, i * (-1) ** i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, o long, v long").withColumn("x", F.col("v")).repartition(5)
    got = {(r.g, r.o): (r["at"], r.v, r.x) for r in running(df, ["g"], ["o"], ["v"], ["x"]).collect()}
    state = defaultdict(lambda: (-1, 0, 0))
    for g, o, v in sorted(rows):
        at, total, xor = state[g]
        state[g] = (at + 1, total + v, xor ^ v)
        assert got[g, o] == state[g]
