"""The parts of the quality classifier and the encoder of very long words against plain loops."""

import re

import numpy as np
import pyarrow as pa
import pytest

from starmill.llm import kernel as K
from starmill.llm import quality, token_counts

TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x20\x09-\x0d]+")
SIGNS = re.compile(rb"[^0-9A-Za-z\x80-\xff\x20\x09-\x0d]+")


def bucket_of(token: bytes) -> int:
    """The bucket of a token by itself."""
    (piece,) = K.texts(pa.array([token], pa.binary()))
    return int(quality._tokens(piece)[1][0])


def tokens_of(text: str) -> list[bytes]:
    return TOKEN.findall(text.encode())


@pytest.fixture(scope="module")
def buckets(awkward):
    return {t: bucket_of(t) for _, text in awkward[1] for t in tokens_of(text)}


def test_tokens_are_words_and_runs_of_signs(awkward, buckets):
    texts = [text for _, text in awkward[1]]
    for piece in K.texts(pa.array(texts, pa.string())):
        found, bucket, sign = quality._tokens(piece)
        for i in range(len(piece)):
            own = slice(found.bounds[i], found.bounds[i + 1])
            expected = tokens_of(texts[piece.first + i])
            assert bucket[own].tolist() == [buckets[t] for t in expected]
            assert sign[own].tolist() == [SIGNS.fullmatch(t) is not None for t in expected]
    assert bucket_of(b"Word") == bucket_of(b"wORD") != bucket_of(b"words")


def test_word_vectors_are_sums_of_neighbours(awkward, buckets):
    """Every token adds its index vector to those beside it, in its own text only, repeated rows included."""
    docs, listed = awkward
    index = np.zeros((quality.TOKENS, quality.DIMENSIONS))
    for place, sign in zip(quality.PLACES.T, quality.SIGNS.T):
        np.add.at(index, (np.arange(quality.TOKENS), place), sign)
    total = np.zeros_like(index)
    for _, text in listed:
        own = [buckets[t] for t in tokens_of(text)]
        for a, b in zip(own, own[1:]):
            total[a] += index[b]
            total[b] += index[a]
    expected = total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1)
    for parts in (1, 7):  # however rows are dealt over tasks
        np.testing.assert_allclose(quality.word_vectors(docs.repartition(parts)), expected, atol=1e-6)


def test_pooled_features_against_a_loop(awkward, buckets):
    texts = [text for _, text in awkward[1]]
    vectors = np.random.default_rng(3).normal(size=(quality.TOKENS, quality.DIMENSIONS)).astype(np.float32)
    for piece in K.texts(pa.array(texts, pa.string())):
        got = quality._pooled(piece, vectors)
        for i in range(len(piece)):
            raw = texts[piece.first + i].encode()
            tokens = tokens_of(texts[piece.first + i])
            own, n, size = [buckets[t] for t in tokens], max(len(tokens), 1), max(len(raw), 1)
            signs = [t for t in tokens if SIGNS.fullmatch(t)]
            mean = np.mean([vectors[b] for b in own], axis=0) if own else np.zeros(quality.DIMENSIONS)
            surface = [
                np.log1p(len(own)),
                len(signs) / n,
                sum(len(t) > 1 for t in signs) / n,
                sum(a == b for a, b in zip(own, own[1:])) / n,
                len(set(own)) / n,
                sum(map(len, tokens)) / n / 10,
                sum(48 <= b <= 57 for b in raw) / size,
                sum(65 <= b <= 90 for b in raw) / size,
                raw.count(b"\n") / size,
                np.linalg.norm(mean),
            ]
            np.testing.assert_allclose(got[i], np.r_[mean, surface], atol=2e-3)


def test_slopes_of_the_network_are_those_of_its_loss():
    """The first step's slopes against differences of log loss and decay in every weight."""
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(40, 6)), rng.integers(0, 2, 40).astype(float)
    network = quality.Network(x, y, rounds=1)
    names, decay = ("w1", "b1", "w2", "b2"), 1e-2
    before = {name: np.array(getattr(network, name)) for name in names}

    def loss() -> float:
        z = network._logit(x)
        weights = sum((getattr(network, name) ** 2).sum() for name in names)
        return np.logaddexp(0, np.where(y > 0.5, -z, z)).mean() + decay / 2 * weights

    expected = {}
    for name in names:
        slope = np.zeros_like(before[name])
        for at in np.ndindex(slope.shape):
            ends = []
            for change in (1e-5, -1e-5):
                moved = before[name].copy()
                moved[at] += change
                setattr(network, name, moved)
                ends.append(loss())
            setattr(network, name, before[name].copy())
            slope[at] = (ends[0] - ends[1]) / 2e-5
        expected[name] = slope
    state = {name: (np.zeros_like(before[name]), np.zeros_like(before[name])) for name in names}
    network._descend(x, y, state, 1, decay=decay)
    for name in names:
        np.testing.assert_allclose(state[name][0] / 0.1, expected[name], atol=1e-6)
        assert (np.sign(before[name] - getattr(network, name)) == np.sign(expected[name])).all()


def test_the_temperature_is_the_best_of_those_tried():
    """It divides logits only, so it leaves the order of scores and never makes held-back rows' loss worse."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 4))
    y = (x[:, 0] + rng.normal(scale=2, size=400) > 0).astype(float)
    network = quality.Network(x, y, seed=4)
    calibrated = network.score(x)
    check = np.split(np.random.default_rng(4).permutation(len(x)), [len(x) // 5])[0]

    def held_back_loss(t: float) -> float:
        network.temperature = t
        p = network.score(x[check])
        return -np.log(np.where(y[check] > 0.5, p, 1 - p)).mean()

    chosen = network.temperature
    assert held_back_loss(chosen) <= min(held_back_loss(t) for t in np.geomspace(0.25, 8, 41)) + 1e-9
    network.temperature = 1.0
    plain = network.score(x)
    assert (np.argsort(calibrated, kind="stable") == np.argsort(plain, kind="stable")).all()


def test_a_very_long_text_without_spaces_is_encoded_whole(spark):
    texts = ["x" * 200_000, "漢" * 50_000, "-" * 100_000]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    with open(token_counts.VOCABULARY, "rb") as file:
        encoder = token_counts._encoder(file.read(), token_counts.PATTERN)
    got = {r.n_tokens: r.docs for r in token_counts.histogram(docs).collect()}
    encoded = [encoder.encode_ordinary(t) for t in texts]
    assert [encoder.decode(e) for e in encoded] == texts
    sizes = [len(e) for e in encoded]
    assert got == {n: sizes.count(n) for n in sizes}
