"""Quality rules as a short-circuit cascade.

Each rule rejects a document by integer arithmetic over measures of its whole
text. The verdict is the same in any order, so the order is chosen for cost:
on a sample, every rule's seconds and rejections are measured, and rules run
by rejections (among what the rules before them leave) per second. A later
rule sees only the documents that still stand.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.bpe import LETTER, class_table
from meterlake.llm.text import SMALL_CHUNK_BYTES, Texts, codes_of, pair_codes, segment_sums, text_chunks
from meterlake.llm.tokens import id_and_text

SYMBOLS = "#*$%&|<>"
WINDOW = 5
SAMPLE_ROWS = 512  # rows expected in the sample; it sets the order only
SAMPLE_SEED = 8

_IS_SYMBOL = np.isin(np.arange(256), [ord(c) for c in SYMBOLS])


class Measures:
    """Measures of a chunk's documents, each taken when a rule first asks."""

    def __init__(self, texts: Texts):
        self.texts = texts
        self._known: dict[str, np.ndarray] = {}

    def __getattr__(self, name: str) -> np.ndarray:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._known:
            self._known[name] = getattr(self, f"_take_{name}")()
        return self._known[name]

    def _byte_count(self, mask: np.ndarray) -> np.ndarray:
        return segment_sums(mask, self.texts.offsets)

    def _take_slices(self):
        return self.texts.words()

    def _take_word_ends(self):
        return self.texts.per_doc(self.slices[0])

    def _take_codes(self):
        return codes_of(self.texts.data, *self.slices)[0]

    def _take_n_words(self):
        return np.diff(self.word_ends)

    def _take_word_chars(self):
        body = self.texts.data[: self.texts.size]
        space = (body == 0x20) | ((body >= 0x09) & (body <= 0x0D))
        return self._byte_count(((body & 0xC0) != 0x80) & ~space)

    def _take_n_symbols(self):
        return self._byte_count(_IS_SYMBOL[self.texts.data[: self.texts.size]])

    def _take_n_upper(self):
        body = self.texts.data[: self.texts.size]
        return self._byte_count((body >= 0x41) & (body <= 0x5A))

    def _take_n_lower(self):
        body = self.texts.data[: self.texts.size]
        return self._byte_count((body >= 0x61) & (body <= 0x7A))

    def _take_n_letters(self):
        """Letters of any script. Those beyond ASCII are counted only where
        capitals prevail among the ASCII ones; elsewhere they change no verdict."""
        n = self.n_upper + self.n_lower
        for i in np.flatnonzero(2 * self.n_upper > n).tolist():
            body = self.texts.text_bytes(i)
            if not body.isascii():
                cps = np.frombuffer(body.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
                n[i] += np.count_nonzero(class_table()[cps[cps >= 0x80]] == LETTER)
        return n

    def _take_lines(self):
        """Documents and codes of the lines that hold a word."""
        texts = self.texts
        body = texts.data[: texts.size]
        cuts = np.flatnonzero(body == 0x0A)
        starts = np.unique(np.concatenate([texts.offsets[:-1], cuts + 1]))
        starts = starts[starts < texts.size]
        ends = np.minimum(np.append(starts[1:], texts.size), texts.offsets[np.searchsorted(texts.offsets, starts, side="right")])
        ends = ends - (body[ends - 1] == 0x0A)
        word = self.slices[0]
        held = np.searchsorted(word, ends) > np.searchsorted(word, starts)
        starts, ends = starts[held], ends[held]
        return texts.doc_of(starts), codes_of(texts.data, starts, ends - starts)[0]

    def _take_n_lines(self):
        return np.bincount(self.lines[0], minlength=len(self.texts))

    def _take_n_dup_lines(self):
        doc, code = self.lines
        _, first = pair_codes(doc, code)
        return self.n_lines - np.bincount(doc[first], minlength=len(self.texts))

    def _take_n_same_neighbours(self):
        codes = self.codes
        same = np.zeros(len(codes), bool)
        same[1:] = codes[1:] == codes[:-1]
        begin = self.word_ends[:-1]
        same[begin[begin < len(codes)]] = False
        return segment_sums(same, self.word_ends)

    def _take_n_repeat_words(self):
        """Words inside a window of WINDOW words that the text holds twice or more."""
        codes, ends = self.codes, self.word_ends
        n = len(codes)
        if n < WINDOW:
            return np.zeros(len(self.texts), np.int64)
        doc = np.repeat(np.arange(len(self.texts)), np.diff(ends))
        two = pair_codes(codes[:-1], codes[1:])[0]
        four = pair_codes(two[:-2], two[2:])[0]
        five = pair_codes(four[: n - 4], codes[4:])[0]
        at = np.flatnonzero(doc[: n - 4] == doc[4:])  # windows inside one document
        window = pair_codes(five[at], doc[at])[0]
        again = at[np.bincount(window)[window] > 1] if len(at) else at
        mark = np.zeros(n + 1, np.int64)
        np.add.at(mark, again, 1)
        np.add.at(mark, again + WINDOW, -1)
        return segment_sums(np.cumsum(mark[:n]) > 0, ends)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measures], np.ndarray]


def few_words(m: Measures) -> np.ndarray:
    return m.n_words < 10


def repeated_words(m: Measures) -> np.ndarray:
    return 100 * m.n_repeat_words > 20 * m.n_words


def many_symbols(m: Measures) -> np.ndarray:
    return 100 * m.n_symbols > 10 * m.n_words


def mostly_capitals(m: Measures) -> np.ndarray:
    return 100 * m.n_upper > 50 * m.n_letters


def duplicate_lines(m: Measures) -> np.ndarray:
    return 100 * m.n_dup_lines > 50 * m.n_lines


def same_neighbours(m: Measures) -> np.ndarray:
    return 100 * m.n_same_neighbours > 20 * m.n_words


BASE_RULES = (Rule("few_words", few_words), Rule("repeated_words", repeated_words))
RULES = (
    *BASE_RULES, Rule("many_symbols", many_symbols), Rule("mostly_capitals", mostly_capitals),
    Rule("duplicate_lines", duplicate_lines), Rule("same_neighbours", same_neighbours),
)


def choose_order(df: DataFrame, text_col: str, id_col: str, rules: tuple[Rule, ...] = RULES,
                 sample_rows: int = SAMPLE_ROWS) -> tuple[Rule, ...]:
    """Rules by rejections per second, measured on about ``sample_rows`` rows.

    Every task measures its share of the sample (each row is taken or not by
    itself, so copies of a row are not taken together); the driver gets one
    small row per rule and chunk."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_chunks(batches, 1):
            for k, rule in enumerate(rules):
                began = time.perf_counter()
                rejected = rule.rejects(Measures(texts))
                cost = time.perf_counter() - began
                yield pa.RecordBatch.from_pydict({
                    "rule": pa.array([k], pa.int32()), "cost": [cost], "rejected": pa.array([rejected.tolist()], pa.list_(pa.bool_())),
                })

    share = min(1.0, sample_rows / max(1, df.count()))
    picked = id_and_text(df, id_col, text_col).where(F.rand(SAMPLE_SEED) < share)
    found = picked.mapInArrow(measure, "rule int, cost double, rejected array<boolean>").collect()
    cost = [sum(r.cost for r in found if r.rule == k) for k in range(len(rules))]
    rejects = [np.array([x for r in found if r.rule == k for x in r.rejected], bool) for k in range(len(rules))]
    return tuple(rules[k] for k in greedy_order(cost, rejects))


def greedy_order(cost: list[float], rejects: list[np.ndarray]) -> list[int]:
    """Next comes the rule that rejects most of what still stands per second; ties keep the given order."""
    left, order = list(range(len(cost))), []
    alive = np.ones(len(rejects[0]) if rejects else 0, bool)
    while left:
        best = max(left, key=lambda k: ((rejects[k] & alive).sum() / max(cost[k], 1e-9), -cost[k], -k))
        left.remove(best)
        order.append(best)
        alive &= ~rejects[best]
    return order


def cascade(texts_of: Callable[[np.ndarray], Texts], n: int, rules: tuple[Rule, ...], alive: np.ndarray | None = None) -> np.ndarray:
    """Which of n documents no rule rejects. ``texts_of(rows)`` lays out the rows that still stand."""
    alive = np.ones(n, bool) if alive is None else alive.copy()
    rows, measures = None, None
    for rule in rules:
        standing = np.flatnonzero(alive)
        if not len(standing):
            break
        if rows is None or len(standing) < 0.8 * len(rows):  # lay out anew once enough rows are gone
            rows, measures = standing, Measures(texts_of(standing))
        alive[rows[rule.rejects(measures)]] = False
    return alive


def _layout(rows: pa.RecordBatch, at: int) -> Callable[[np.ndarray], Texts]:
    return lambda picked: Texts(rows.column(at).take(pa.array(picked)))


def judge(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measures and verdict of every whole text.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed (too few or too often repeated words) and kept
    (no rule rejects). The reported measures are taken of every document, the
    other rules run as the cascade on what the base rules leave.

    Defined cases: null and empty texts have no word and fail; repeated rows
    give equal rows; a null id stays null; a text of any length is measured
    whole; other input columns are ignored; an empty table gives no rows.
    """
    order = choose_order(df, text_col, id_col, tuple(r for r in rules if r not in BASE_RULES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_chunks(batches, 1, SMALL_CHUNK_BYTES):
            m = Measures(texts)
            failed = np.zeros(len(texts), bool)
            for rule in BASE_RULES:
                failed |= rule.rejects(m)
            kept = cascade(_layout(rows, 1), len(texts), order, ~failed)
            yield pa.RecordBatch.from_pydict({
                "doc_id": rows.column(0),
                **{c: pa.array(getattr(m, c), pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")},
                "base_failed": pa.array(failed), "kept": pa.array(kept),
            })

    schema = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
              "n_repeat_words bigint, base_failed boolean, kept boolean")
    return id_and_text(df, id_col, text_col).mapInArrow(run, schema)


def keep_good(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``df`` that no rule rejects, with all their columns; same cases as :func:`judge`."""
    order = choose_order(df, text_col, id_col, rules)
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_chunks(batches, at, SMALL_CHUNK_BYTES):
            yield rows.filter(pa.array(cascade(_layout(rows, at), len(texts), order)))

    return df.mapInArrow(run, df.schema)


# --- the same by SQL -----------------------------------------------------------------

# DuckDB; windows are counted by their words, positions by the windows over them.
JUDGE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), win AS (
  SELECT r, i, array_to_string(ws[i : i + 4], ' ') AS w
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 5)
), rep AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest(range(i, i + 5)) AS p
        FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS c FROM win) WHERE c > 1)
  GROUP BY r
), m AS (
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines,
         CAST(coalesce(rep.n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS n_upper,
         length(regexp_replace(t, '[^\p{L}]+', '', 'g')) AS n_letters,
         len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_same
  FROM d LEFT JOIN rep USING (r)
), s AS (
  SELECT *, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 10 * n_words OR 100 * n_upper > 50 * n_letters
            OR 100 * n_dup_lines > 50 * len(lines) OR 100 * n_same > 20 * n_words) AS kept
FROM s
"""
