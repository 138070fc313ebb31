"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts up to ``ORDER`` bytes long. The
code length of a text under a language is the sum over its bytes of the bits
that the byte costs after the bytes before it: the longest context that was
seen codes the byte if it has followed there, else an escape is paid and the
next shorter context is asked, with the bytes excluded that the longer one
could have coded; below the empty context the remaining bytes cost the same.
Escapes are those of method C: as many chances as distinct followers.
Statistics are frozen after fitting, so a byte's cost depends on its context
alone, and each distinct (context, byte) is costed once. Costs are integers
in units of 2**-16 bit: sums do not depend on how texts are batched.

The shortest code wins; the score is its posterior under equal priors.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.sampling import held_out, sample_per_label
from meterlake.llm.text import Texts, WordTable, pair_codes, segment_sums, text_chunks

ORDER = 4
SAMPLE_ROWS = 500  # documents per language, by id hash
SAMPLE_CHARS = 65_536  # longer documents are not taken for fitting
UNIT = 1 << 16
UNDETERMINED = "und"
CACHE_ENTRIES = 1_000_000

_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)], np.uint64)
_SIZE = np.uint64(56)


_SEPARATOR = np.array([b < 0x80 and not chr(b).isalpha() for b in range(256)])


class Letters(Texts):
    """Lower-cased texts with every run of ASCII characters that are not
    letters (digits, signs, white space) as one blank: those say little about
    a language and are common in junk."""

    def __init__(self, column: pa.Array):
        super().__init__(pc.utf8_lower(column))
        body = self.data[: self.size]
        blank = _SEPARATOR[body]
        keep = ~blank
        keep[1:] |= ~blank[:-1]
        keep[self.offsets[:-1][self.offsets[:-1] < self.size]] = True
        kept = np.where(blank, np.uint8(0x20), body)[keep]
        self.offsets = np.concatenate([[0], np.cumsum(keep)])[self.offsets]
        self.size = len(kept)
        self.data = np.concatenate([kept, np.zeros(32, np.uint8)])


def grams(texts: Texts, order: int = ORDER) -> np.ndarray:
    """One machine word per byte: the byte with the up to ``order`` bytes before
    it in its document (first byte lowest), and their number on top."""
    n = texts.size
    window = np.ndarray((len(texts.data) - 7,), dtype="<u8", buffer=texts.data, strides=(1,))
    size = np.diff(texts.offsets)
    at, size = texts.offsets[:-1][size > 0], size[size > 0]
    context = np.full(n, order, np.int64)
    for back in range(order):
        context[at[size > back] + back] = back
    at = np.arange(n) - context
    return (window[at] & _MASK[context + 1]) | ((context + 1).astype(np.uint64) << _SIZE)


class Tree:
    """Frozen statistics of one language, from counts of its grams."""

    def __init__(self, gram: np.ndarray, count: np.ndarray, order: int = ORDER):
        size = (gram >> _SIZE).astype(np.int64)
        body = gram & _MASK[7]
        self.order = order
        self.followers, self.n = [], []  # by context length: context + byte, its count
        self.contexts, self.total, self.distinct, self.excluded = [], [], [], []
        for k in range(order + 1):  # suffixes of k context bytes and the byte
            has = size > k
            suffix = body[has] >> (np.uint64(8) * (size[has] - 1 - k).astype(np.uint64))
            keys, codes = np.unique(suffix, return_inverse=True)
            n = np.bincount(codes, weights=count[has], minlength=len(keys)).astype(np.int64)
            context, owner = np.unique(keys & _MASK[k], return_inverse=True)
            self.followers.append(keys)
            self.n.append(n)
            self.contexts.append(context)
            self.total.append(np.bincount(owner, weights=n, minlength=len(context)).astype(np.int64))
            self.distinct.append(np.bincount(owner, minlength=len(context)).astype(np.int64))
            if k:  # what the followers of a context count in the next shorter context
                at = np.searchsorted(self.followers[k - 1], keys >> np.uint64(8))
                shorter = self.n[k - 1][at]
                self.excluded.append(np.bincount(owner, weights=shorter, minlength=len(context)).astype(np.int64))
            else:
                self.excluded.append(np.zeros(len(context), np.int64))

    def cost(self, gram: np.ndarray) -> np.ndarray:
        """Units that each gram's last byte costs after the bytes before it."""
        size = (gram >> _SIZE).astype(np.int64)
        body = gram & _MASK[7]
        bits = np.zeros(len(gram))
        left = np.arange(len(gram))
        out_total, out_distinct = np.zeros(len(gram), np.int64), np.zeros(len(gram), np.int64)  # of the longer context
        for k in range(self.order, -1, -1):
            able = left[size[left] > k]
            if not len(able) or not len(self.contexts[k]):
                continue
            suffix = body[able] >> (np.uint64(8) * (size[able] - 1 - k).astype(np.uint64))
            at, known = _find(self.contexts[k], suffix & _MASK[k])
            able, suffix, at = able[known], suffix[known], at[known]
            escape = self.distinct[k][at] - out_distinct[able]
            whole = self.total[k][at] - out_total[able] + escape
            where, seen = _find(self.followers[k], suffix)
            bits[able[seen]] += np.log2(whole[seen]) - np.log2(self.n[k][where[seen]])
            miss = ~seen & (escape > 0)
            bits[able[miss]] += np.log2(whole[miss]) - np.log2(escape[miss])
            gone = ~seen
            out_total[able[gone]] = self.excluded[k][at[gone]]
            out_distinct[able[gone]] = self.distinct[k][at[gone]]
            left = np.setdiff1d(left, able[seen], assume_unique=True)
        bits[left] += np.log2(np.maximum(1, 256 - out_distinct[left]))
        return np.rint(bits * UNIT).astype(np.int64)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Model:
    """Trees by language; ``costs`` keeps the costs of grams already met by this worker."""

    def __init__(self, trees: dict[str, Tree]):
        self.languages, self.trees = sorted(trees), trees
        self._empty()

    def _empty(self) -> None:
        self.table, self.used = WordTable(CACHE_ENTRIES), 0
        self.known = np.zeros((1 << 12, len(self.languages)), np.int64)

    def costs(self, gram: np.ndarray) -> np.ndarray:
        """Costs of distinct grams, a column per language."""
        if self.used + len(gram) > CACHE_ENTRIES and self.used:
            self._empty()
        entry = self.table.get(gram, gram)
        new = np.flatnonzero(entry < 0)
        while self.used + len(new) > len(self.known):
            self.known = np.concatenate([self.known, np.zeros_like(self.known)])
        entry[new] = np.arange(self.used, self.used + len(new))
        for j, language in enumerate(self.languages):
            self.known[entry[new], j] = self.trees[language].cost(gram[new])
        if len(gram) <= CACHE_ENTRIES:
            self.table.put(gram[new], gram[new], entry[new])
        self.used += len(new)
        return self.known[entry]

    def code_lengths(self, texts: Texts) -> np.ndarray:
        """Code length of every document in units, a column per language."""
        codes, distinct = pd.factorize(grams(texts))
        costs = self.costs(distinct)
        return np.stack([segment_sums(costs[:, j][codes], texts.offsets) for j in range(len(self.languages))], axis=1)


def fit(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
        sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS, order: int = ORDER) -> Model:
    """Trees from a bounded sample: about ``sample_rows`` documents of each label.

    Gram counts are taken in tasks and summed by Spark; the driver gets those
    of the sample only.

    Defined cases: rows with a null id or label, null texts and texts of more
    than ``sample_chars`` characters are not learned from; repeated rows are
    learned from together; other columns are ignored; without any labelled
    document there is no language, and every text is ``und``.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("string").alias("label"))
    rows = rows.where(~held_out(F.col("id")) & F.col("id").isNotNull() & F.col("label").isNotNull() & (F.length("text") <= sample_chars))
    sample = sample_per_label(rows, "label", "id", sample_rows).select("label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _ in text_chunks(batches, 1):
            texts = Letters(part.column(1))
            names, label = np.unique(np.array(part.column(0).to_pylist(), object).astype(str), return_inverse=True)
            gram, owner = grams(texts, order), np.repeat(label, np.diff(texts.offsets))
            code, first = pair_codes(gram, owner)
            yield pa.RecordBatch.from_pydict({
                "label": pa.array(names[owner[first]].tolist(), pa.string()),
                "gram": pa.array(gram[first].astype(np.int64)), "n": pa.array(np.bincount(code, minlength=len(first)), pa.int64()),
            })

    counted = sample.mapInArrow(run, "label string, gram bigint, n bigint").groupBy("label", "gram").agg(F.sum("n").alias("n"))
    found = counted.toPandas()
    return Model({label: Tree(part["gram"].to_numpy(np.int64).astype(np.uint64), part["n"].to_numpy(np.int64), order)
                  for label, part in found.groupby("label")})


_MODELS: dict[str, Model] = {}


def predict(df: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Language of every whole text: doc_id, held_out, lang_pred, score.

    Defined cases: ``und`` with score 0 for a null text or one without a
    letter, and for every text if nothing could be learned; ties go to the
    first language by name; a text of any length is read whole; repeated rows
    give equal rows; a null id stays null and is never held out; other input
    columns are ignored; an empty table gives no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(model.trees)
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _MODELS:
            _MODELS.clear()
            _MODELS[key] = Model(shared.value)
        own = _MODELS[key]
        for rows, original in text_chunks(batches, 2):
            texts = Letters(rows.column(2))
            name, score = np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts))
            if own.languages:
                bits = own.code_lengths(texts) / UNIT
                best = bits.argmin(axis=1)
                lead = bits - bits.min(axis=1, keepdims=True)
                lettered = has_letter(original)
                name[lettered] = np.array(own.languages, object)[best[lettered]]
                score[lettered] = 1 / np.exp2(-np.minimum(lead, 1000)).sum(axis=1)[lettered]
            yield pa.RecordBatch.from_pydict({
                "doc_id": rows.column(0), "held_out": rows.column(1),
                "lang_pred": pa.array(name.tolist(), pa.string()), "score": pa.array(score),
            })

    picked = df.select(F.col(id_col).cast("bigint").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def has_letter(texts: Texts) -> np.ndarray:
    body = texts.data[: texts.size] & 0xDF  # ASCII letters to upper case
    ascii_letter = segment_sums((body >= 0x41) & (body <= 0x5A), texts.offsets) > 0
    for i in np.flatnonzero(~ascii_letter).tolist():
        ascii_letter[i] = any(c.isalpha() for c in texts.text_bytes(i).decode("utf-8"))
    return ascii_letter
