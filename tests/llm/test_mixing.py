"""Targets and budgets of the mix, against a plain reading of the rules."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from starmill.llm import mixing


def plain_targets(sizes):
    """Share out by weight; cap; share the excess again until no source is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if share[s] > 3 * sizes[s]]
        if not above:
            return {**fixed, **share}
        fixed |= {s: 3.0 * sizes[s] for s in above}


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    names = [None, *(f"s{i}" for i in range(rng.randrange(1, 9)))]
    sizes = {n: rng.choice([0, 3, 50, 400, 10_000]) for n in names}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(frame, "source").collect()}
    assert got == pytest.approx(plain_targets(sizes))


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 6), min_size=1, max_size=8), st.integers(0, 400), st.sampled_from([8, 1 << 16]))
def test_fit_reaches_the_budget_where_any_choice_does(counts, budget, dp):
    sizes, available = np.array(sorted(counts)), np.array([counts[s] for s in sorted(counts)])
    taken = mixing.fit(sizes, available, budget, dp)
    assert (taken >= 0).all() and (taken <= available).all()
    got, total = int((sizes * taken).sum()), int((sizes * available).sum())
    goal = min(budget, total)
    assert abs(got - goal) <= int(sizes.max())
    if dp > 400:  # the share of every size is fixed first; the rest is fitted as well as can be
        base = available * goal // total if goal < total else available
        reach = {int((sizes * base).sum())}
        for s, n in zip(sizes.tolist(), (available - base).tolist()):
            reach |= {r + s * k for r in reach for k in range(n + 1)}
        assert abs(got - goal) == min(abs(r - goal) for r in reach)


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def test_mix_of_awkward_rows(awkward):
    docs, rows = awkward
    out = mixing.digest(docs).collect()
    again = mixing.digest(docs.repartition(7)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    assert sorted((str(r.doc_id), r.size) for r in out) == sorted((str(i), words(t)) for i, t in rows)
    assert all(r.size == 0 or r.taken % r.size == 0 and 0 <= r.taken <= 3 * r.size for r in out)
    assert sum({r.source_size: r.target for r in out}.values()) == pytest.approx(sum(words(t) for _, t in rows))


def test_taken_words_come_near_each_target(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.choice([1, 2, 3, 5, 8, 60]), rng.choice(["hot"] * 6 + ["b", "c", "d", None])) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    source = {i: s for i, _, s in rows}
    taken, target = defaultdict(int), {}
    for r in mixing.digest(docs).collect():
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    for s in target:
        assert abs(taken[s] - target[s]) <= 1
    mixed = mixing.mixed(docs)
    assert mixed.columns == ["doc_id", "text", "source", "copies"]
    assert sum(words(r.text) * r.copies for r in mixed.collect()) == sum(taken.values())


def test_no_documents(nothing):
    assert mixing.digest(nothing).count() == 0
    assert mixing.mixed(nothing).count() == 0
