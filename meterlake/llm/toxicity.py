"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (and of the whole word) hashed to
buckets, so a misspelt or inflected word shares most of its vectors with the
words seen. A long word (joined words, or a script without blanks) is cut into
overlapping pieces that count as words, so its length averages nothing away. A
window's vector is the average over its words, a linear softmax
over it gives the probability of label 1, and a text scores as its worst
window: a single insult in a long text is not averaged away, and every word
of the text is in a window.

Embeddings and softmax are trained jointly in numpy on a bounded sample.
Labels belong to texts, not to windows: after a first fit with every window of
a toxic text taken as toxic, the fit goes on with the windows that the model
itself finds worst in each toxic text, and all windows of the others.

One such fit can take rare n-grams of its sample for insults. So each of a few
folds of the sample is left out of one fit and then calibrates it: a logistic
regression of the labels on the worst windows of texts that the fit hasn't
seen. The fits' average is again one linear softmax, over their embeddings side
by side.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.sampling import held_out, sample_per_label
from meterlake.llm.text import SMALL_CHUNK_BYTES, Texts, codes_of, ragged, subword_hashes, text_chunks

DIMENSIONS = 4
BUCKETS = 1 << 16
GRAM_SIZES = (3, 4, 5, 6)
WINDOW = 4
LONG_WORD = 24  # bytes; longer words are cut into pieces
PIECE = 12  # bytes of a piece, to the end of its last character; the next one begins half a piece on
SAMPLE_ROWS = 1_000  # labelled documents of each class, by id hash
SAMPLE_CHARS = 16_384  # longer documents are not taken for fitting
MIN_TEXTS = 3  # of the sample, in which a bucket must be met
ROUNDS = (60, 40, 40, 40, 40)  # steps of the first fit and of those on chosen windows
WINDOWS_A_STEP = 10_000  # of each class
FOLDS = 4  # of the sample, and fits
RATES = {"vectors": 1.0, "weights": 0.02, "bias": 0.05}
THRESHOLD = 0.3
SEED = 7

_WORD_BYTE = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])


def words(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """White-space words without the ASCII signs at their ends, long ones in pieces."""
    starts, lengths = texts.words()
    ends = starts + lengths
    inside = _WORD_BYTE[texts.data[: texts.size]]
    n = texts.size
    at = np.arange(n, dtype=np.int32 if n < 1 << 31 else np.int64)
    following = np.minimum.accumulate(np.where(inside, at, at.dtype.type(n))[::-1])[::-1]
    before = np.maximum.accumulate(np.where(inside, at, at.dtype.type(-1)))
    starts = following[starts].astype(np.int64)
    last = before[ends - 1].astype(np.int64) + 1
    whole = starts < last
    return pieces(texts.data, starts[whole], (last - starts)[whole])


def pieces(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices in order, those of more than ``LONG_WORD`` bytes as overlapping
    pieces of whole characters that cover them."""
    step = PIECE // 2
    long = lengths > LONG_WORD
    if not long.any():
        return starts, lengths
    count = np.where(long, -(-(lengths - PIECE) // step) + 1, 1)
    owner = np.repeat(np.arange(len(starts)), count)
    ends = (starts + lengths)[owner]
    begin = starts[owner] + ragged(np.zeros(len(starts), np.int64), count) * step
    end = np.where(long[owner], np.minimum(begin + PIECE, ends), ends)
    for _ in range(3):  # a UTF-8 character has at most three bytes after its first
        begin += (begin < ends) & (data[np.minimum(begin, len(data) - 1)] & 0xC0 == 0x80)
        end += (end < ends) & (data[np.minimum(end, len(data) - 1)] & 0xC0 == 0x80)
    return begin, end - begin


def subwords(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of every word's subwords one after another, and their offsets by word."""
    hashes, offsets = subword_hashes(data, starts, lengths, GRAM_SIZES)
    return (hashes % np.uint64(BUCKETS)).astype(np.int64), offsets


class Model:
    """Bucket vectors, softmax weights and bias; frozen, about 2 MB a fit."""

    def __init__(self, vectors: np.ndarray, weights: np.ndarray, bias: np.ndarray):
        self.vectors, self.weights, self.bias = vectors, weights, bias
        # The softmax of two classes depends on the difference of their logits,
        # which is linear: each bucket has its share of it.
        self.share = vectors @ (weights[:, 1] - weights[:, 0])
        self.offset = float(bias[1] - bias[0])

    def word_shares(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """The share of every word, and the words' offsets by document."""
        starts, lengths = words(texts)
        codes, first = codes_of(texts.data, starts, lengths)
        if not len(first):
            return np.zeros(0), np.zeros(len(texts) + 1, np.int64)
        buckets, offsets = subwords(texts.data, starts[first], lengths[first])
        share = np.add.reduceat(self.share[buckets], offsets[:-1]) / np.diff(offsets)
        return share[codes], texts.per_doc(starts)

    def scores(self, texts: Texts, window: int = WINDOW) -> np.ndarray:
        """Probability of label 1 of every document: that of its worst window."""
        return 1 / (1 + np.exp(-np.clip(self.logits(texts, window), -700, 700)))

    def logits(self, texts: Texts, window: int = WINDOW) -> np.ndarray:
        share, ends = self.word_shares(texts)
        n = np.diff(ends)
        total = np.concatenate([[0.0], np.cumsum(share)])
        worst = np.zeros(len(texts))  # no words: the average is the zero vector
        short = (n > 0) & (n <= window)
        worst[short] = (total[ends[1:]] - total[ends[:-1]])[short] / n[short]
        long = np.flatnonzero(n > window)
        if len(long):
            size = n[long] - window + 1
            begin = ragged(ends[:-1][long], size)
            mean = (total[begin + window] - total[begin]) / window
            worst[long] = np.maximum.reduceat(mean, np.cumsum(size) - size)
        return np.round(worst, 9) + self.offset


def train(texts: list[str], labels: np.ndarray, *, seed: int = SEED, rounds: tuple[int, ...] = ROUNDS, folds: int = FOLDS) -> Model:
    """The average of ``folds`` fits, each calibrated on the texts it leaves out.

    With fewer texts of a class than folds there are as many folds as texts of
    it; with fewer than two, one fit that isn't calibrated.
    """
    folds = min(folds, int((labels == 0).sum()), int((labels == 1).sum()))
    if folds < 2:
        return train_once(texts, labels, seed=seed, rounds=rounds)
    rng = np.random.default_rng(seed)
    fold = np.zeros(len(texts), np.int64)
    for label in (0, 1):
        own = rng.permutation(np.flatnonzero(labels == label))
        fold[own] = np.arange(len(own)) % folds
    vectors, weights, bias = [], [], np.zeros(2)
    for k in range(folds):
        rest, out = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        model = train_once([texts[i] for i in rest], labels[rest], seed=seed + k, rounds=rounds)
        seen = Texts(pc.utf8_lower(pa.array([texts[i] for i in out], pa.string())))
        slope, shift = calibrate(model.logits(seen), labels[out])
        vectors.append(model.vectors)
        weights.append(model.weights * (slope / folds))
        bias += (model.bias * slope + [0.0, shift]) / folds
    return Model(np.concatenate(vectors, axis=1), np.concatenate(weights), bias)


def calibrate(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic regression of ``labels`` on ``logits``, the
    classes weighted by the roots of their sizes; targets as if each class had one more text of
    the other label, so that separable classes give finite values. A slope below
    zero counts as zero."""
    ones, zeros = int((labels == 1).sum()), int((labels == 0).sum())
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    weight = np.where(labels == 1, 1 / np.sqrt(ones), 1 / np.sqrt(zeros))
    weight /= weight.sum()
    x = np.clip(logits, -60, 60)
    middle, spread = x.mean(), x.std() + 1e-9
    x = np.stack([(x - middle) / spread, np.ones(len(x))], axis=1)
    found = np.zeros(2)
    penalty = np.diag([1e-4, 1e-9])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ found, -50, 50)))
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + penalty
        found -= np.linalg.solve(curve, x.T @ (weight * (p - target)) + penalty @ found)
    slope = max(0.0, float(found[0]) / spread)
    return slope, float(found[1]) - slope * middle


def train_once(texts: list[str], labels: np.ndarray, *, seed: int = SEED, rounds: tuple[int, ...] = ROUNDS) -> Model:
    """Joint training on whole labelled texts, with equal weight to both classes.

    The gradient of each array is scaled by its largest row, so a bucket moves
    by what all windows of a step say about it; buckets met in fewer than
    ``MIN_TEXTS`` texts stay at zero, as they would only name single texts.
    """
    rng = np.random.default_rng(seed)
    batch = Texts(pc.utf8_lower(pa.array(texts, pa.string())))
    starts, lengths = words(batch)
    codes, first = codes_of(batch.data, starts, lengths)
    prior = np.array([np.mean(labels == 0), np.mean(labels == 1)]) if len(labels) else np.array([1.0, 0.0])
    if not len(first) or not 0 < prior[1] < 1:  # nothing to tell apart: the labels' share
        bias = np.log(np.clip(prior, 1e-6, None))
        return Model(np.zeros((BUCKETS, DIMENSIONS)), np.zeros((DIMENSIONS, 2)), bias)
    bags = Bags(*subwords(batch.data, starts[first], lengths[first]))
    ends = batch.per_doc(starts)
    bags.drop_rare(codes, np.repeat(np.arange(len(texts)), np.diff(ends)), MIN_TEXTS)
    # Windows side by side; the last one of a text may be shorter.
    per_text = -(-np.diff(ends) // WINDOW)
    text_of = np.repeat(np.arange(len(texts)), per_text)
    begin = ragged(np.zeros(len(texts), np.int64), per_text) * WINDOW + ends[:-1][text_of]
    column = begin[:, None] + np.arange(WINDOW)
    held = column < ends[1:][text_of][:, None]
    word = np.where(held, codes[np.minimum(column, len(codes) - 1)], bags.n)  # word n is the zero vector
    windows = Windows(word, held.sum(axis=1))
    toxic = labels[text_of] == 1
    share = {"vectors": rng.normal(0, 0.02, (BUCKETS, DIMENSIONS)), "weights": np.tile([-1.0, 1.0], (DIMENSIONS, 1)), "bias": np.zeros(2)}
    share["vectors"][bags.rare] = 0
    speed = {k: np.zeros_like(v) for k, v in share.items()}
    clean, worst_clean, chosen = np.flatnonzero(~toxic), np.zeros(0, np.int64), np.flatnonzero(toxic)
    for turn, steps in enumerate(rounds):
        for step in range(steps):
            a = chosen if len(chosen) <= WINDOWS_A_STEP else rng.choice(chosen, WINDOWS_A_STEP, replace=False)
            b = clean if len(clean) <= WINDOWS_A_STEP else rng.choice(clean, WINDOWS_A_STEP, replace=False)
            rows = np.concatenate([a, b, worst_clean])
            weight = np.concatenate([np.full(len(x), w / max(1, len(x))) for x, w in
                                     ((a, 0.5), (b, 0.25 if turn else 0.5), (worst_clean, 0.25))])
            target = np.concatenate([np.ones(len(a)), np.zeros(len(b) + len(worst_clean))])
            for k, g in _gradient(share, bags, windows, rows, target, weight).items():
                top = np.sqrt((np.atleast_2d(g) ** 2).sum(axis=1).max()) + 1e-12
                speed[k] = 0.8 * speed[k] - RATES[k] * (1 - step / (2 * steps)) * g / top
                share[k] += speed[k]
        logit = _logits(share, bags, windows)
        difference = logit[:, 1] - logit[:, 0]
        worst = np.full(len(texts), -np.inf)
        np.maximum.at(worst, text_of, difference)
        top = np.flatnonzero(difference >= worst[text_of])
        chosen, worst_clean = top[toxic[top]], top[~toxic[top]]
    return Model(share["vectors"], share["weights"], share["bias"])


class Bags:
    """Buckets of distinct words, ragged."""

    def __init__(self, buckets: np.ndarray, offsets: np.ndarray):
        self.buckets, self.offsets = buckets, offsets
        self.n = len(offsets) - 1
        self.size = np.diff(offsets)
        self.rare = np.zeros(BUCKETS, bool)

    def drop_rare(self, codes: np.ndarray, text_of: np.ndarray, least: int) -> None:
        """Keep only buckets met in ``least`` texts; a word's average stays over its whole bag."""
        pair = np.unique(codes * np.int64(text_of.max() + 1) + text_of)
        word, text = pair // (text_of.max() + 1), pair % (text_of.max() + 1)
        seen = np.zeros(BUCKETS, np.int64)
        order = np.argsort(text, kind="stable")
        cuts = np.append(np.flatnonzero(np.diff(text[order], prepend=-1)), len(order))
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            own = word[order[lo:hi]]
            seen[np.unique(self.buckets[ragged(self.offsets[own], self.size[own])])] += 1
        self.rare = seen < least
        keep = ~self.rare[self.buckets]
        owner = np.repeat(np.arange(self.n), self.size)[keep]
        self.buckets = self.buckets[keep]
        self.offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=self.n))])

    def vectors(self, table: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Average vectors of the words ``own``; the buckets summed, and the row of each."""
        kept = self.offsets[own + 1] - self.offsets[own]
        buckets = self.buckets[ragged(self.offsets[own], kept)]
        row = np.repeat(np.arange(len(own)), kept)
        total = np.stack([np.bincount(row, weights=table[buckets, k], minlength=len(own)) for k in range(table.shape[1])], axis=1)
        return total / self.size[own][:, None], buckets, row


class Windows:
    def __init__(self, word: np.ndarray, count: np.ndarray):
        self.word, self.count = word, count


def _logits(share: dict, bags: Bags, windows: Windows) -> np.ndarray:
    vectors = np.concatenate([bags.vectors(share["vectors"], np.arange(bags.n))[0], np.zeros((1, DIMENSIONS))])
    return (vectors[windows.word].sum(axis=1) / windows.count[:, None]) @ share["weights"] + share["bias"]


def _gradient(share: dict, bags: Bags, windows: Windows, rows: np.ndarray, target: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    word, count = windows.word[rows], windows.count[rows]
    own, at = np.unique(word, return_inverse=True)
    at = at.reshape(word.shape)
    real = own[own < bags.n]
    vectors, buckets, row = bags.vectors(share["vectors"], real)
    vectors = np.concatenate([vectors, np.zeros((1, DIMENSIONS))])
    window = vectors[at].sum(axis=1) / count[:, None]
    logit = window @ share["weights"] + share["bias"]
    p = 1 / (1 + np.exp(np.clip(logit[:, 0] - logit[:, 1], -700, 700)))
    error = (p - target) * weight
    error = np.stack([-error, error], axis=1)
    back = (error @ share["weights"].T) / count[:, None]
    flat, repeated = at.reshape(-1), np.repeat(np.arange(len(word)), word.shape[1])
    to_bucket = np.empty_like(share["vectors"])
    for k in range(DIMENSIONS):
        to_word = np.bincount(flat, weights=back[repeated, k], minlength=len(vectors))[: len(real)] / bags.size[real]
        to_bucket[:, k] = np.bincount(buckets, weights=to_word[row], minlength=BUCKETS)
    return {"vectors": to_bucket, "weights": window.T @ error, "bias": error.sum(axis=0)}


def fit(df: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS) -> Model:
    """A model from about ``sample_rows`` labelled documents of each class.

    A document with several labels counts as toxic if one of them says so.
    The sample (at most about 2 x sample_rows x sample_chars characters) goes
    to the driver, where the training runs.

    Defined cases: labels with a null id or another value than 0 and 1, null
    texts and texts of more than ``sample_chars`` characters are not learned
    from; an id that repeats counts once, with the smallest of its texts; other columns
    are ignored; without any labelled document the model knows no insult.
    """
    given = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    given = given.where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    sample = sample_per_label(given.groupBy("id").agg(F.max("label").alias("label")), "label", "id", sample_rows)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where(F.length("text") <= sample_chars)
    # The sample holds about 2 x sample_rows ids whatever the size of the tables.
    found = rows.join(F.broadcast(sample), "id").groupBy("id").agg(F.min("text").alias("text"), F.first("label").alias("label")).orderBy("id").toPandas()
    return train(found["text"].tolist(), found["label"].to_numpy(np.int64))


_MODELS: dict[str, Model] = {}


class _Shared:
    """A model sent to the executors once, built once per worker."""

    def __init__(self, spark, model: Model):
        self.parts = spark.sparkContext.broadcast((model.vectors, model.weights, model.bias))
        self.key = uuid.uuid4().hex

    def get(self) -> Model:
        if self.key not in _MODELS:
            _MODELS.clear()
            _MODELS[self.key] = Model(*self.parts.value)
        return _MODELS[self.key]


def score(df: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Toxicity of every whole text: doc_id, held_out, score, predicted (1 if score >= ``threshold``).

    Defined cases: a null or empty text, or one without words, scores as the
    zero vector does; a text of any length is scored in all its windows; repeated
    rows give equal rows; a null id stays null and is never held out; other
    input columns are ignored; an empty table gives no rows; without labels of
    both classes every text scores the labels' share of ones (0 if none).
    """
    shared = _Shared(df.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.get()
        for rows, _ in text_chunks(batches, 2, SMALL_CHUNK_BYTES):
            p = own.scores(Texts(pc.utf8_lower(rows.column(2))))
            yield pa.RecordBatch.from_pydict({
                "doc_id": rows.column(0), "held_out": rows.column(1),
                "score": pa.array(p), "predicted": pa.array((p >= threshold).astype(np.int32)),
            })

    picked = df.select(F.col(id_col).cast("bigint").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def keep_clean(df: DataFrame, model: Model, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` whose text scores below ``threshold``, with all their
    columns. Cases as for :func:`score`: null and empty texts are scored like any,
    repeated rows alike, an empty table gives no rows."""
    shared = _Shared(df.sparkSession, model)
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.get()
        for rows, _ in text_chunks(batches, at, SMALL_CHUNK_BYTES):
            p = own.scores(Texts(pc.utf8_lower(rows.column(at))))
            yield rows.filter(pa.array(p < threshold))

    return df.mapInArrow(run, df.schema)
