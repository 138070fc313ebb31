from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from meterlake.llm import toxicity
from meterlake.llm.text import Texts


def _corpus(n, seed):
    """Long clean texts; toxic ones hold a few inflected insults."""
    rng = random.Random(seed)
    parts = ["the", "re", "on", "and", "ti", "en", "sh", "ou", "er", "an"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))
    texts, labels = [], []
    for i in range(n):
        body = [word() for _ in range(rng.randint(20, 200))]
        if i % 3 == 0:
            for _ in range(rng.randint(1, 3)):
                body.insert(rng.randrange(len(body)), "grumblik" + rng.choice(parts) + rng.choice(parts))
        texts.append(" ".join(body))
        labels.append(int(i % 3 == 0))
    return texts, np.array(labels)


@pytest.fixture(scope="module")
def model():
    return toxicity.train(*_corpus(300, 1))


def test_unseen_inflections_and_misspellings(model):
    texts, labels = _corpus(150, 2)
    predicted = model.scores(Texts(pa.array(texts))) >= toxicity.THRESHOLD
    assert (predicted == labels).mean() > 0.97
    clean = " ".join(["the", "reon", "anden"] * 300)
    score = model.scores(Texts(pa.array([clean, clean + " grumblikzzz " + clean, clean + " grumbllik, " + clean])))
    assert score[0] < 0.3 < min(score[1:])


def test_calibration_against_a_search():
    """Slope and shift minimise the weighted log loss."""
    rng = np.random.default_rng(3)
    labels = (np.arange(200) % 4 == 0).astype(int)
    logits = rng.normal(0, 6, 200) + 9 * labels
    n1, n0 = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(labels == 1, n1**-0.5, n0**-0.5)
    weight /= weight.sum()

    def loss(a, b):
        z = a * logits + b
        return (weight * (np.logaddexp(0, z) - target * z)).sum()

    a, b = toxicity.calibrate(logits, labels)
    assert a > 0 and loss(a, b) <= min(loss(a + x, b + y) for x in (-0.02, 0, 0.02) for y in (-0.05, 0, 0.05)) + 1e-6
    apart = toxicity.calibrate(np.where(labels == 1, 5.0, -5.0), labels)
    assert all(np.isfinite(apart)) and toxicity.calibrate(-logits, labels)[0] == 0


def test_a_model_is_the_average_of_its_fits():
    texts, labels = _corpus(60, 6)
    model = toxicity.train(texts, labels, folds=2)
    assert model.vectors.shape[1] == 2 * toxicity.DIMENSIONS
    rng = np.random.default_rng(toxicity.SEED)
    fold = np.zeros(60, int)
    for label in (0, 1):
        own = rng.permutation(np.flatnonzero(labels == label))
        fold[own] = np.arange(len(own)) % 2
    share = np.zeros(toxicity.BUCKETS)
    for k in (0, 1):
        once = toxicity.train_once([t for t, f in zip(texts, fold, strict=True) if f != k], labels[fold != k], seed=toxicity.SEED + k)
        out = Texts(pa.array([t for t, f in zip(texts, fold, strict=True) if f == k]))
        share += once.share * toxicity.calibrate(once.logits(out), labels[fold == k])[0] / 2
    assert np.allclose(model.share, share)


def test_training_reproduces(model):
    again = toxicity.train(*_corpus(300, 1))
    assert np.array_equal(model.share, again.share) and model.offset == again.offset


@pytest.mark.parametrize("joint", ["", "_", "-", "\u00b7"])
def test_texts_without_blanks(model, joint):
    """An insult among joined words is not averaged away by the length of the whole."""
    clean = ["the", "reon", "anden", "tire", "shou", "onthe"] * 60
    toxic = [*clean[:100], "grumblikander", *clean[100:]]
    score = model.scores(Texts(pa.array([joint.join(clean), joint.join(toxic), joint.join(["grumblikon", "the", "reon"] * 40)])))
    assert score[0] < toxicity.THRESHOLD <= min(score[1:])


def test_pieces_cover_long_words_by_whole_characters():
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab\u00e4\u4e00\U0001f600") for _ in range(rng.randint(1, 90))) for _ in range(300)]
    batch = Texts(pa.array(texts))
    starts, lengths = toxicity.pieces(batch.data, batch.offsets[:-1].astype(np.int64), np.diff(batch.offsets))
    owner = np.searchsorted(batch.offsets, starts, side="right") - 1
    for i, text in enumerate(texts):
        own = [(s - batch.offsets[i], n) for s, n in zip(starts[owner == i].tolist(), lengths[owner == i].tolist(), strict=True)]
        raw = text.encode()
        if len(raw) <= toxicity.LONG_WORD:
            assert own == [(0, len(raw))]
            continue
        assert all(raw[a : a + n].decode() and n <= toxicity.PIECE + 3 for a, n in own)
        assert own[0][0] == 0 and sum(own[-1]) == len(raw)
        assert all(b < a + n for (a, n), (b, _) in zip(own, own[1:], strict=False))


def test_a_repeated_id_is_learned_with_its_smallest_text(spark):
    texts, labels = _corpus(90, 4)
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows + [(i, "z" + t) for i, t in rows[::2]], "doc_id long, text string")
    given = spark.createDataFrame([(i, int(y)) for i, y in enumerate(labels)], "doc_id long, toxic int")
    once = spark.createDataFrame([(i, min(t, "z" + t) if i % 2 == 0 else t) for i, t in rows], "doc_id long, text string")
    assert np.array_equal(toxicity.fit(docs, given).share, toxicity.fit(once, given).share)


def test_score_is_that_of_the_worst_window(model):
    texts = ["the reon anden grumblikon the re", "re", "", "the " * 50]
    for text, got in zip(texts, model.scores(Texts(pa.array(texts))), strict=True):
        shares = []
        for w in text.split():
            batch = Texts(pa.array([w]))
            shares.append(model.word_shares(batch)[0][0])
        k = toxicity.WINDOW
        windows = [np.mean(shares[i : i + k]) for i in range(max(1, len(shares) - k + 1))] if shares else [0.0]
        assert got == pytest.approx(1 / (1 + np.exp(-(max(windows) + model.offset))), abs=1e-9)


def test_fit_leaves_the_held_out_fold_alone(spark):
    texts, labels = _corpus(120, 3)
    out = [zlib.crc32(str(i).encode()) % 4 == 2 for i in range(120)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    given = spark.createDataFrame([(i, 0 if o else int(y)) for i, (y, o) in enumerate(zip(labels, out, strict=True))], "doc_id long, toxic int")
    other = spark.createDataFrame([(i, 1 if o else int(y)) for i, (y, o) in enumerate(zip(labels, out, strict=True))], "doc_id long, toxic int")
    assert np.array_equal(toxicity.fit(docs, given).share, toxicity.fit(docs, other).share)


def test_edge_rows(spark, model, edge_documents, clashing, no_documents):
    for df in (edge_documents, clashing):
        rows = toxicity.score(df, model).collect()
        assert [r.doc_id for r in rows] == [d.doc_id for d in df.collect()]
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
        assert rows[0].score == rows[1].score == rows[2].score
    kept = toxicity.keep_clean(clashing, model)
    assert kept.columns == clashing.columns and kept.count() == sum(r.predicted == 0 for r in rows)
    assert toxicity.score(no_documents, model).collect() == []


def test_without_both_labels_there_is_nothing_to_tell_apart(spark, edge_documents, no_documents):
    labels = spark.createDataFrame([(i, 0) for i in range(12)] + [(None, 1), (1, None)], "doc_id long, toxic int")
    model = toxicity.fit(edge_documents, labels)
    assert {r.predicted for r in toxicity.score(edge_documents, model).collect()} == {0}
    assert toxicity.fit(no_documents, labels.limit(0)).offset < 0
