import pytest
from hypothesis import given, settings, strategies as st

from starmill.operators.upsert import changed, upsert

SCHEMA = "k LONG, a STRING, b STRING"


def frame(spark, data):
    return spark.createDataFrame([(k, *v) for k, v in data.items()], SCHEMA)


def as_dict(df):
    out = [tuple(r) for r in df.select("k", "a", "b").collect()]
    assert len({r[0] for r in out}) == len(out)
    return {r[0]: (r[1], r[2]) for r in out}


CURRENT = {1: ("old", "x"), 9: ("keep", None), 3: (None, "y")}
INCOMING = {1: (None, "new"), 2: ("new", None), 3: ("fill", "z")}


def test_update_takes_incoming_nulls(spark):
    got = as_dict(upsert(frame(spark, CURRENT), frame(spark, INCOMING), "k", "update"))
    assert got == {**CURRENT, **INCOMING}


def test_ignore_keeps_existing_rows(spark):
    got = as_dict(upsert(frame(spark, CURRENT), frame(spark, INCOMING), "k", "ignore"))
    assert got == {**INCOMING, **CURRENT}


def test_keep_first_fills_only_gaps(spark):
    got = as_dict(upsert(frame(spark, CURRENT), frame(spark, INCOMING), "k", "keep_first"))
    assert got == {1: ("old", "x"), 9: ("keep", None), 2: ("new", None), 3: ("fill", "y")}


def test_insert_only_columns_survive_an_update(spark):
    got = as_dict(upsert(frame(spark, CURRENT), frame(spark, INCOMING), "k", "update", insert_only=("b",)))
    assert got == {1: (None, "x"), 9: ("keep", None), 2: ("new", None), 3: ("fill", "y")}


def test_unknown_policy(spark):
    with pytest.raises(ValueError, match="unknown policy"):
        upsert(frame(spark, CURRENT), frame(spark, INCOMING), "k", "merge")


@pytest.mark.parametrize("policy", ["update", "ignore", "keep_first"])
def test_empty_batch_changes_nothing(spark, policy):
    current = frame(spark, CURRENT)
    after = upsert(current, current.limit(0), "k", policy)
    assert changed(current, after, "k").count() == 0


def test_changed_sees_values_and_presence(spark):
    before, after = frame(spark, CURRENT), frame(spark, {1: ("old", "x"), 9: (None, None), 4: ("n", "n")})
    assert sorted(r.k for r in changed(before, after, "k").collect()) == [3, 4, 9]


cells = st.one_of(st.none(), st.sampled_from(["p", "q"]))
tables = st.dictionaries(st.integers(0, 6), st.tuples(cells, cells), max_size=6)


@settings(max_examples=8, deadline=None)
@given(current=tables, incoming=tables)
def test_against_plain_dictionaries(spark, current, incoming):
    expected = {
        "update": {**current, **incoming},
        "ignore": {**incoming, **current},
        "keep_first": {
            k: tuple(
                c if c is not None else i
                for c, i in zip(current.get(k, (None, None)), incoming.get(k, (None, None)), strict=True)
            )
            for k in {*current, *incoming}
        },
    }
    for policy, rows in expected.items():
        once = upsert(frame(spark, current), frame(spark, incoming), "k", policy)
        assert as_dict(once) == rows
        if policy == "update":
            assert as_dict(upsert(once, frame(spark, incoming), "k", policy)) == rows
