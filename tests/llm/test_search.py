"""Nearest neighbours against brute force; WARC archives by round trip."""

import gzip
import hashlib
import os

import numpy as np
import pytest

from starmill.llm import nearest, warc
from starmill.llm.queries import QUERIES
from starmill.sources import shared


def brute_search(rows, k, every):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = {}
    for q, v in good:
        if q % every == 0:
            scores = sorted((-float(v @ w), i) for i, w in good if i != q and len(w) == len(v))
            out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def same(got, expected):
    assert set(got) == {q for q, v in expected.items() if v}
    for q in got:
        assert [i for i, _ in got[q]] == [i for i, _ in expected[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in expected[q]])


def test_awkward_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(0, 1 + i % 3, 4).astype(np.float32).tolist()) for i in range(60)]
    rows += [(100 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(40)]  # ties in rank and many equal vectors
    rows += [(200, None), (220, []), (240, [0.0] * 4), (260, [1.0, None, 2.0, 3.0]), (280, [float("nan"), 1.0, 1.0, 1.0])]
    rows += [(300, [float("inf"), 1.0, 1.0, 1.0]), (None, [1.0] * 4), (320, [1.0, 2.0]), (321, [2.0, 1.0]), (340, [5.0])]
    frame = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, rank int, score string").repartition(4)
    for k in (5, 25):
        same(found(nearest.search(frame, k=k)), brute_search(rows, k, 20))
    assert nearest.search(frame.filter("false")).count() == 0


def test_shards_and_query_blocks_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 1, 8).tolist()) for i in range(300)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(nearest, "SHARD", 70)
    monkeypatch.setattr(nearest, "QUERY_BLOCK", 6)
    same(found(nearest.search(frame, k=7, every=10)), brute_search(rows, 7, 10))


def test_recall_of_the_index(spark):
    """At 2,000 vectors of 64 uniform dimensions, the hardest case."""
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    data = frame.toPandas()
    x, ids = np.array(data.embedding.tolist(), float), data.vec_id.to_numpy()
    got = found(nearest.search(frame))
    hits = 0
    for q in got:
        scores = x @ x[ids == q][0]
        scores[ids == q] = -np.inf
        hits += len({i for i, _ in got[q]} & set(ids[np.lexsort((ids, -scores))[:20]].tolist()))
    assert hits / (20 * len(got)) >= 0.9


@pytest.mark.parametrize("case", ["0.2", "0.3", "1.0", "one long", "offset", "clusters"])
def test_recall_on_other_vectors(spark, case):
    """Neighbours by inner product are long vectors; one far longer than all does not hide the others.
    A common offset leaves all directions in a narrow cone, clusters leave them in a few."""
    rng = np.random.default_rng(8)
    x = rng.normal(0, 1, (6000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    if case == "one long":
        x[17] *= 10_000
    elif case == "offset":
        x = rng.normal(0, 1, (6000, 64)) + 8 * rng.normal(0, 1, 64) / 8
    elif case == "clusters":
        x = (rng.normal(0, 1, (12, 64)) * 3)[rng.integers(0, 12, 6000)] + x * 8
    else:
        x *= rng.lognormal(0, float(case), 6000)[:, None]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = found(nearest.search(frame, every=60))
    hits = 0
    for q in got:
        scores = x @ x[q]
        scores[q] = -np.inf
        hits += len({i for i, _ in got[q]} & set(np.argsort(-scores)[:20].tolist()))
    assert len(got) == 100 and hits / (20 * len(got)) >= 0.9


def test_ties_of_different_vectors_go_to_the_smaller_id(spark, monkeypatch):
    """Of 256 different vectors all have the same inner product with the queries."""
    order = np.random.default_rng(2).permutation(256).tolist()
    rows = [(1 + i, [1.0, *(float(v >> b & 1) for b in range(8))]) for i, v in enumerate(order)]
    rows += [(1000 + 1000 * j, [1.0 + j, *[0.0] * 8]) for j in range(3)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    expected = brute_search(rows, 20, 1000)
    same(found(nearest.search(frame, every=1000)), expected)
    monkeypatch.setattr(nearest, "SHARD", 70)
    same(found(nearest.search(frame, every=1000)), expected)


def test_repeated_rows_and_ids(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 1, 6).tolist()) for i in range(1, 90)]
    rows += [r for r in rows if r[0] % 20 == 0 or r[0] % 7 == 0] * 24  # as queries and as neighbours
    rows += [(100, [2.0] * 6)] * 30 + [(101 + i, [2.0] * 6) for i in range(8)]  # its own id first, often
    rows += [(200, [9.0 + i, *rng.normal(0, 1, 5).tolist()]) for i in range(40)]  # one id, many long vectors
    rows += [(201, [9.0, 1.0, 1.0, 1.0, 1.0, i / 8]) for i in range(3)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    distinct = sorted({(i, tuple(v)) for i, v in rows})
    expected = {}
    for q in sorted({i for i, _ in distinct if i % 20 == 0}):
        own = np.array([v for i, v in distinct if i == q])
        scores = sorted((-float((own @ np.array(v)).max()), i) for i, v in distinct if i != q)
        expected[q] = [(i, -s) for s, i in scores[:20]]
    same(found(nearest.search(frame)), expected)


def brute_pages(rows):
    kept = {}
    for i, _, html in rows:
        p = (html or "").encode()
        if len(p) >= 1000 and i is not None:
            kept[p] = max(i, kept.get(p, i))
    out = []
    for i, _, html in rows:
        p = (html or "").encode()
        keeper = kept.get(p)
        revisit = keeper is not None and keeper != i
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None))
    return sorted(out, key=str)


PAGES = [
    (1, "http://Example.com/a", "x" * 1000),
    (2, "https://user@example.com:8080/a#frag", "x" * 1000),
    (2, "https://user@example.com:8080/a#frag", "x" * 1000),
    (3, None, "x" * 999),
    (4, "http://example.com/a", "x" * 999),
    (5, "", None),
    (6, "ftp://b.example.org/ü?q=a b\r\nX: y", "größe " * 400),
    (7, "ftp://b.example.org/ü", "größe " * 400),
    (None, "http://example.com/a", "y" * 5000),
    (8, "http://example.com/", "\r\n\r\nWARC/1.1\r\n" * 300),
    (9, "http://a.b.c.example.com/" + "p/" * 500, "<html>" * 100_000),
] + [(100 + i, "http://hot.example.net/", "same " * 300) for i in range(50)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "k", 0) for r in PAGES], "page_id long, url string, html string, key string, offset int").repartition(4)


def test_round_trip(pages, monkeypatch):
    monkeypatch.setattr(warc, "LINES", 7)  # several blocks in a file
    assert sorted((tuple(r) for r in warc.digest(pages).collect()), key=str) == brute_pages(PAGES)


def test_lookup_reads_only_what_is_asked_for(spark, pages):
    archives, index = shared.new_path(spark, "warc"), shared.new_path(spark, "cdx")
    captures = warc.write_archives(pages, archives)
    directory = warc.build_index(captures, index)
    asked = [(warc.url_key("http://example.com/a"), 1), (warc.url_key("http://hot.example.net/"), 149), ("nobody)/", 1)]
    got = warc.lookup(spark.createDataFrame(asked, "key string, page_id long"), directory, archives, index, with_payload=True).collect()
    assert {(r.page_id, bytes(r.payload) if r.payload is not None else None) for r in got} == {(1, None), (149, b"same " * 300)}
    files = [f for f in os.listdir(archives.removeprefix("file:")) if f.endswith(".warc.gz")]
    head = gzip.open(os.path.join(archives.removeprefix("file:"), files[0])).read(200)
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: re")


def test_damaged_records_are_refused():
    member = gzip.decompress(warc.record(1, "http://a/", b"payload", hashlib.sha1(b"payload").hexdigest(), None))
    with pytest.raises(ValueError):
        warc.parse(gzip.compress(member.replace(b"payload\r\n", b"pay1oad\r\n")))


def test_keys_reverse_hosts():
    assert warc.url_key("https://user@Sub.Example.com:443/a?b#c") == "com,example,sub)/a?b"
    assert warc.url_key(None) == warc.url_key("") == ""


def test_no_pages(pages):
    assert warc.digest(pages.filter("false")).count() == 0


def test_queries_on_the_smallest_tables(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()
    got = QUERIES["op3_warc"](spark, sf_dir).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_pages([tuple(r) for r in rows])
    data = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got, expected = found(QUERIES["op8_nearest"](spark, sf_dir)), brute_search(data, 20, 20)
    assert set(got) == set(expected) and all(len(v) == 20 for v in got.values())
    met = [dict(got[q]).keys() & dict(expected[q]).keys() for q in got]
    assert sum(map(len, met)) >= 0.9 * 20 * len(got)
    every = {q: dict(v) for q, v in brute_search(data, len(data), 20).items()}
    assert all(s == pytest.approx(every[q][i]) for q in got for i, s in got[q])
