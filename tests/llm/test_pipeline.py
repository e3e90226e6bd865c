"""The pipeline, stage by stage and as a whole, against brute force; SQL of the operators that have it."""

import os
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F
from cases import prose
from test_decontaminate import brute as brute_contamination
from test_dedup import brute_groups
from test_mixing import plain_targets, words

import __spark_entry__ as entry_points
import corpus_pipeline
from starmill.llm.oracles import ORACLES
from starmill.llm.queries import QUERIES

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def brute_without_repeats(rows, width=400):
    """Texts without bytes of repeated windows; None where nothing but blanks is left."""
    raw = [(r[1] or "").encode() for r in rows]
    seen = {}
    for b in raw:
        for i in range(len(b) - width + 1):
            seen[b[i : i + width]] = seen.get(b[i : i + width], 0) + 1
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if seen[b[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        text = bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore")
        out.append(None if any(gone) and not text.strip(" \t\r\n") else text)
    return out


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """A small corpus with cases for every stage, and its benchmark."""
    passage, item = prose(500, 90), prose(501, 25)
    texts = {
        1: prose(1, 200),
        2: prose(1, 200),
        3: prose(1, 200).replace("w7", "v7"),
        4: prose(2, 150) + " " + passage + " " + prose(3, 100),
        5: prose(4, 120) + " " + passage + " " + prose(5, 130),
        6: prose(6, 80) + " " + " ".join(item.split()[4:18]) + " " + prose(7, 80),
        7: prose(8, 80) + " " + " ".join(item.split()[4:12]) + " " + prose(9, 80),
        8: "123 456 --- 7",
        9: None,
        10: "",
    }
    texts |= {i: prose(i, 60 + i) for i in range(20, 60)}
    rows = [(i, t, "en" if i % 2 else "fr", ["a", "b", None, "hot"][min(i % 7, 3)], len(t or "")) for i, t in texts.items()]
    folder = str(tmp_path_factory.mktemp("planted"))
    spark.createDataFrame(rows, COLUMNS).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, prose(700, 30))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, [(1, item), (2, prose(700, 30))]


def test_stages_on_planted_cases(spark, planted):
    folder, rows, items = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "jaccard_join", "suffix_dedup", "decontaminate", "mixing"]
    stages = dict(corpus_pipeline.STAGES)

    def out(name, df):
        result = stages[name](spark, df, folder)
        if name != "mixing":
            assert result.schema.simpleString() == docs.schema.simpleString()
        kept = sorted((tuple(r) for r in result.collect()), key=str)
        return kept, spark.createDataFrame(kept, result.schema)

    known, df = out("language_id", docs)
    assert {r[0] for r in rows} - {r[0] for r in known} >= {8, 9, 10}
    assert {r[0] for r in known} >= {1, 2, 3, 4, 5, 6, 7}  # clean ones stay

    one_each, df = out("jaccard_join", df)
    assert {r[0] for r in one_each} == {c for _, _, c in brute_groups([(r[0], r[1]) for r in known])}
    assert not {2, 3} & {r[0] for r in one_each}

    short, df = out("suffix_dedup", df)
    expected = brute_without_repeats(one_each)
    assert {r[0]: r[1] for r in short} == {r[0]: t for r, t in zip(one_each, expected) if t is not None}
    assert all(r[4] == len(r[1]) for r in short)
    assert len(dict((r[0], r[1]) for r in short)[4]) < len(dict((r[0], r[1]) for r in one_each)[4]) - 300

    clean, df = out("decontaminate", df)
    assert {r[0] for r in clean} == {c[0] for c in brute_contamination([(r[0], r[1]) for r in short], items) if not c[5]}
    assert 6 not in {r[0] for r in clean} and 7 in {r[0] for r in clean}

    mixed, _ = out("mixing", df)
    sizes, taken = {}, {}
    for r in clean:
        sizes[r[3]] = sizes.get(r[3], 0) + words(r[1])
    for r in mixed:
        assert 1 <= r[-1] <= 3
        taken[r[3]] = taken.get(r[3], 0) + words(r[1]) * r[-1]
    longest = max(words(r[1]) for r in clean)
    for source, target in plain_targets(sizes).items():
        assert abs(taken.get(source, 0) - target) <= longest


def test_a_stage_deletes_what_the_one_before_left(spark):
    """Folders and names in the catalog alike."""
    from starmill.llm import tables
    from starmill.sources import shared

    with tables.stage(spark):
        frame = spark.range(20).select(F.col("id").alias("row_id"), F.lit("x").alias("text"))
        left = tables.bucketed(frame, "row_id", "left")
        path = tables.staged(left, "copy").inputFiles()[0].rsplit("/", 1)[0]
    names = [t.name for t in spark.catalog.listTables() if t.name.startswith("starmill_left")]
    assert len(names) == 1 and shared.exists(spark, path)
    with tables.stage(spark):
        assert not shared.exists(spark, path)
        assert not spark.catalog.tableExists(names[0])


def test_run_chains_the_stages(spark, planted):
    folder, _, _ = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, folder)
        docs = spark.createDataFrame(result.collect(), result.schema)
    whole = QUERIES["pipeline"](spark, folder)
    assert whole.columns == docs.columns
    assert sorted(map(str, whole.collect())) == sorted(map(str, docs.collect()))


def test_pipeline_of_no_documents(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_queries_are_registered():
    for n in range(1, 11):
        assert [q for q in QUERIES if q.startswith(f"op{n}_")], n
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for file in os.listdir(sf_dir):
        duck.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{file}'")
    expected = duck.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    got = QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == sorted(map(str, expected.fetchall()))


def brute_without_runs(texts, words):
    """Texts without runs of so many words that start at two or more places."""
    found = [[(m.start(), m.end()) for m in re.finditer(r"\S+", t, re.ASCII)] for t in texts]
    runs = [[tuple(t[a:b] for a, b in f[i : i + words]) for i in range(len(f) - words + 1)] for t, f in zip(texts, found, strict=True)]
    seen = Counter(r for own in runs for r in own)
    out = []
    for t, f, own in zip(texts, found, runs, strict=True):
        gone = set()
        for i, r in enumerate(own):
            if seen[r] > 1:
                gone |= set(range(f[i][0], f[i + words - 1][1]))
        out.append("".join(c for i, c in enumerate(t) if i not in gone))
    return out


def test_passages_of_more_than_50_words_go_however_short(spark):
    passage, small, below = prose(900, 51), " ".join("abcdefghij"[i % 7] + "xyz"[i % 3] for i in range(51)), prose(901, 49)
    assert len(passage) < 400 and len(small) < 160
    texts = [prose(i, 150) for i in range(12)]
    texts[0] += " " + passage + " " + prose(50, 100)
    texts[1] = passage.replace(" ", "\n") + "  " + texts[1]
    texts[2] += " " + small + " ñandú " + prose(51, 20)
    texts[3] += " " + small
    texts[4] += " " + below + " " + prose(52, 30)
    texts[5] = below + " " + texts[5]
    texts[6] += " größe " + passage + " " + prose(53, 20) + " " + passage
    texts[7] = small
    texts[8] = "ha " * 60 + texts[8]
    texts[9] = "ha " * 48 + texts[9]
    expected = brute_without_runs(texts, 50)
    assert [len(e) < len(t) for t, e in zip(texts, expected, strict=True)] == [i in (0, 1, 2, 3, 6, 7, 8) for i in range(12)]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in enumerate(texts)], COLUMNS).repartition(4)
    got = {r.doc_id: r for r in dict(corpus_pipeline.STAGES)["suffix_dedup"](spark, docs, "").collect()}
    assert {i: r.text for i, r in got.items()} == {i: e for i, e in enumerate(expected) if e.strip()}
    assert 7 not in got and all(r.n_chars == len(r.text) for r in got.values())
