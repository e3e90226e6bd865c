"""The prefix trie against a plain one, with bursts, long paths, equal conversations and awkward rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from starmill.llm import prefix_trie

FIELDS = "conv_id long, turn long, role string, text string, depth long, n string, a long, ends string, conv string"


def table(spark, rows, parts=4):
    return spark.createDataFrame([(*r, 1, "n", 2, "e", "c") for r in rows], FIELDS).repartition(parts)


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, name, (role, text)))
    own = {c: [t for *_, t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 6, c - int(c - 100 * int(c / 100))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(sequences):
    members = defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        sums[node] = (sum(sums[b][0] for b in below) or 1, own + sum(sums[b][1] for b in below))
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(sequences[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children[node]), *sums[node], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def key(row):
    return [str(v) for v in row]


def check(df, sequences):
    got = sorted((tuple(r) for r in df.collect()), key=key)
    assert got == sorted(brute(sequences), key=key)


def awkward_rows():
    rng = random.Random(5)
    rows = [(None, 0, "user", "nobody"), (7, None, None, None), (7, 0, "user", None), (7, 0, None, "tie"), (7, 0, "user", "tie")]
    rows += [(7, 0, "user", "tie")] * 2  # repeated rows are turns of their own
    rows += [(c, t, rng.choice(["user", "assistant", ""]), rng.choice(["Á", "b", "", "漢字 c"])) for c in range(100, 300) for t in range(rng.randrange(1, 9))]
    rows += [(-205, t, "u", f"x{t}") for t in range(7)] + [(-200, t, "u", f"y{t}") for t in range(3)]
    rows += [(430, 3, "user", "short"), (431, 5, "user", "short")]  # without a base; perhaps without a turn
    return rows


@pytest.mark.parametrize("capacity", [6, 4096])
def test_awkward_rows(spark, capacity):
    rows = awkward_rows()
    check(prefix_trie.digest(table(spark, rows), capacity), rebuilt(rows))


def direct(spark, sequences, capacity):
    rows = [(c, p, hashlib.sha256(repr(t).encode()).hexdigest(), len(t[1])) for c, turns in sequences.items() for p, t in enumerate(turns)]
    ids = spark.createDataFrame([(c,) for c in sequences], "conv_id long")
    turns = spark.createDataFrame(rows, "conv_id long, pos long, name string, chars long").repartition(5)
    check(prefix_trie.trie(ids, turns, capacity), sequences)


def test_bursts_below_long_common_beginnings(spark):
    """Heads over many levels and rounds, ends on the way, equal conversations, one very long path."""
    rng = random.Random(9)
    common = [("u", f"t{i}" * (i % 5)) for i in range(150)]
    sequences = {}
    for c in range(300):
        tail = [("a", rng.choice("xyz")) for _ in range(rng.randrange(6))]
        sequences[c * 3] = common[: rng.choice([1, 2, 40, 149, 150])] + tail
    sequences |= {5000 + i: common for i in range(200)}
    sequences |= {6000 + i: [] for i in range(3)}
    sequences[7000] = common + [("u", str(i)) for i in range(2000)]
    direct(spark, sequences, 64)


def test_turnless_conversations_alone(spark):
    direct(spark, {4: [], 2: []}, 8)


def test_empty_table(spark):
    assert prefix_trie.digest(table(spark, [])).count() == 0
    assert prefix_trie.digest(table(spark, [(None, 1, "u", "x")])).count() == 0


def test_containers_hold_no_more_than_their_capacity(spark):
    """A container of several entries never has more turns than the capacity, however many share a turn."""
    rows = [(c, t, "u", f"{'same' if t < 3 else c % 50}") for c in range(0, 40_000, 100) for t in range(8)]
    named = prefix_trie._named(prefix_trie.rebuilt(table(spark, rows))[1])
    paths = named.withColumn("len", F.lit(8).cast("long"))
    heads = prefix_trie._burst(paths, 100)
    passed = heads.groupBy("conv_id").agg(F.count("*").alias("heads"))
    rest = paths.join(passed, "conv_id", "left").filter("pos >= coalesce(heads, 0)")
    tops = rest.filter("pos = coalesce(heads, 0)").select("conv_id", F.col("a").alias("top"))
    sizes = rest.join(tops, "conv_id").groupBy("top").agg(F.count("*").alias("turns"), F.count_distinct("conv_id").alias("members"))
    assert sizes.filter("turns > 100 AND members > 1").count() == 0 and heads.count() > 0
