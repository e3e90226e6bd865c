"""Language, quality, licenses and token counts: brute force where exact, held-out accuracy where learned."""

import re

import duckdb
import numpy as np
import pytest
from cases import prose

from starmill.llm import language_id, licenses, quality, token_counts
from starmill.llm.queries import QUERIES


def brute_viterbi(scores, switch):
    """Best path by trying every predecessor."""
    paths = [(scores[0][s], [s]) for s in range(len(scores[0]))]
    for row in scores[1:]:
        paths = [
            max(((v - (switch if p[-1] != s else 0) + row[s], [*p, s]) for v, p in paths), key=lambda x: x[0]) for s in range(len(row))
        ]
    return max(paths, key=lambda x: x[0])


def test_viterbi_finds_a_best_path():
    rng = np.random.default_rng(4)
    lengths = [0, 1, 7, 30, 3, 0, 12]
    bounds = np.r_[0, np.cumsum(lengths)]
    scores = rng.normal(0, 3, (bounds[-1], 3))
    labels = language_id.viterbi(scores, bounds, 2.5)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b > a:
            own = labels[a:b]
            value = scores[np.arange(a, b), own].sum() - 2.5 * (own[1:] != own[:-1]).sum()
            assert value == pytest.approx(brute_viterbi(scores[a:b].tolist(), 2.5)[0])


def test_language_of_held_out_documents(spark, sf_dir):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op9_language_id"](spark, sf_dir).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and len(held) > 20
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_of_awkward_rows(awkward, nothing):
    docs, rows = awkward
    got = {str(r.doc_id): r for r in language_id.digest(docs).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in ("1", "2", "3", "14"))
    assert got["13"].lang_pred == "en" and got["11"].lang_pred == "es"
    assert language_id.digest(nothing).count() == 0
    kept = language_id.keep_known(docs)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    assert not {1, 2, 3, 14} & {r.doc_id for r in kept.collect()}
    assert all(r.lang_pred == "und" for r in language_id.digest(docs.withColumn("lang", docs.lang.substr(0, 0)).replace("", None, "lang")).collect())


def test_a_column_with_more_languages_than_are_learned(spark):
    """1,200 values: the 512 with most texts are learned, and every text gets one of them."""
    rows = [(i, f"wort{i % 1200}x und nochmal wort{i % 1200}y", f"l{i % 1200:04}") for i in range(1200)]
    rows += [(2000 + i, f"wort{i}x und dann wort{i}z", f"l{i:04}") for i in range(512)] + [(9000, None, "l0000"), (9001, "12", "l1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = language_id.learn(docs)
    assert model.names == sorted(f"l{i:04}" for i in range(512))
    got = {r.doc_id: r.lang_pred for r in language_id.digest(docs).collect()}
    assert len(got) == len(rows) and got[9000] == got[9001] == "und"
    assert set(got.values()) <= {row[2] for row in rows} | {"und"}
    assert language_id.keep_known(docs).columns == docs.columns


def test_spans_of_a_mixed_text(spark):
    german, french = "der die und nicht mit eine auch sich ", "les des pas dans pour avec être une "
    train = [(i, german * 20, "de") for i in range(8)] + [(100 + i, french * 20, "fr") for i in range(8)]
    model = language_id.learn(spark.createDataFrame(train, "id long, text string, lang string"))
    table = spark.createDataFrame([(1, german * 3 + french * 5), (2, "123 !")], "row_id long, text string")
    mixed, none = language_id.identify(table, model).orderBy("row_id").collect()
    raw = (german * 3 + french * 5).encode()
    assert [s.lang for s in mixed.spans] == ["de", "fr"] and mixed.lang_pred == "fr"
    assert raw[mixed.spans[1].first_byte : mixed.spans[1].last_byte].decode() == (french * 5).strip()
    assert none.lang_pred == "und" and none.spans == []


def test_quality_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = QUERIES["op5_quality"](spark, sf_dir).collect()
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    good = [r.score for r in held if truth[r.doc_id] == 1]
    bad = [r.score for r in held if truth[r.doc_id] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.9
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_quality_of_awkward_rows(spark, awkward, nothing):
    docs, rows = awkward
    labels = spark.createDataFrame([(7, 1), (7, 0), (10, 0), (13, 1), (None, 1), (11, None), (999, 1)], "doc_id long, quality int")
    for known in (labels, labels.filter("false")):
        out = quality.digest(docs, known).collect()
        assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    assert quality.digest(nothing, labels).count() == 0


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_licenses(rows):
    out = []
    for doc, text in rows:
        w, places, labels = words(text), [], set()
        for label, phrase in licenses.PHRASES:
            p = phrase.split()
            here = [i for i in range(len(w)) if w[i : i + len(p)] == p]
            places += here
            labels |= {label} if here else set()
        out.append((doc, len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))))
    return sorted(out, key=str)


def base(df):
    return sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in df.collect()), key=str)


def test_license_phrases_against_brute_force(spark, sf_dir, awkward, nothing):
    docs, rows = awkward
    assert base(licenses.digest(docs)) == brute_licenses(rows)
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert base(licenses.digest(table)) == brute_licenses([(r.doc_id, r.text) for r in table.collect()])
    assert licenses.digest(nothing).count() == 0


def test_edited_notices_are_found_and_unrelated_texts_are_not(spark):
    mit, bsd = licenses.NOTICES[0][1], licenses.NOTICES[2][1]
    edited = mit.replace("free of charge,", "free of any charge whatsoever,").replace("publish, ", "")
    rows = [
        (1, prose(1, 50) + " " + mit + " " + prose(2, 50)),
        (2, prose(3, 30) + " " + edited + " " + bsd),
        (3, " ".join(mit.split()[:12])),  # too small a part
        (4, " ".join(reversed(mit.split()))),
        (5, prose(4, 200)),
    ]
    out = {r.doc_id: r for r in licenses.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1].labels == "mit" and out[1].score == 1.0 and out[1].n_base == 0
    assert out[2].labels == "bsd,mit" and out[2].base_labels == ""
    assert [out[i].labels for i in (3, 4, 5)] == ["", "", ""] and out[5].score == 0
    documents, found = licenses.scan(spark.createDataFrame(rows[:1], "doc_id long, text string"))
    span = found.filter("NOT base").first()
    assert (span.first_word, span.last_word) == (len(words(prose(1, 50))), len(words(prose(1, 50) + " " + mit)) - 1)


def encoder():
    with open(token_counts.VOCABULARY, "rb") as file:
        return token_counts._encoder(file.read(), token_counts.PATTERN)


def test_token_histogram_and_limits(spark, awkward, nothing):
    docs, rows = awkward
    encode = encoder().encode_ordinary
    sizes = [len(encode(t)) for _, t in rows]
    sums = token_counts.with_suffix_sums(token_counts.histogram(docs))
    got = {r.n_tokens: r for r in sums.collect()}
    assert set(got) == set(sizes)
    for n, r in got.items():
        assert r.docs == sizes.count(n) and r.docs_from == sum(s >= n for s in sizes) and r.docs_upto == sum(s <= n for s in sizes)
        assert r.tokens_from == sum(s for s in sizes if s >= n) and r.truncated == sum(min(s, n) for s in sizes)
        assert (r.all_docs, r.all_tokens) == (len(sizes), sum(sizes))
    limits = [0, 1, 10, 500, max(sizes), 10**6]
    for r in token_counts.at_limits(sums, limits).collect():
        assert (r.docs_over, r.truncated) == (sum(s > r.context_limit for s in sizes), sum(min(s, r.context_limit) for s in sizes))
    for r in token_counts.quantiles(sums, [0.1, 0.5, 1.0]).collect():
        assert r.n_tokens == min(s for s in sizes if sum(x <= s for x in sizes) >= r.share * len(sizes))
    assert token_counts.with_suffix_sums(token_counts.histogram(nothing)).count() == 0


def test_token_query_matches_the_tokenizer(spark, sf_dir):
    encode = encoder().encode_ordinary
    sizes = [len(encode(r[0] or "")) for r in duckdb.sql(f"SELECT text FROM '{sf_dir}/documents.parquet'").fetchall()]
    rows = QUERIES["op10_token_counts"](spark, sf_dir).collect()
    assert {r.n_tokens: r.docs for r in rows} == {s: sizes.count(s) for s in sizes}
    assert token_counts.MOST_BYTES > 0 and {r.all_tokens for r in rows} == {sum(sizes)}
