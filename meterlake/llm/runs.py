"""Periodic runs of words: descending-LCP Kruskal over suffix classes.

A run is a maximal stretch of words with a smallest period q that is at least
two periods long. The suffixes of a text at the starts s and s + q of a run's
first two periods share a prefix of exactly (length - q) >= q words, and no
position between them shares as much: it would give a smaller period. So:

1. Suffixes are sorted by doubling; the ranks of every doubling level give the
   common prefix (LCP) of neighbours in that order.
2. Neighbours are united from the longest LCP down. A class is an ordered set
   of positions, the smaller one goes into the larger.
3. Two positions i < j that a union at LCP l makes neighbours in their class
   share exactly l words. With j - i <= l they seed the run [i, j + l) with
   period j - i, if the word before i does not extend it.

Every run is seeded once, as neighbours s and s + q. Runs shorter than
``least`` words need LCPs of at least half of it, so only texts in which some
six words occur twice are sorted at all (a hash finds them; what it lets
through wrongly costs time only).

Texts are independent of each other: a map over Arrow batches, without a
shuffle. A text is held whole in its task: about 100 bytes a word, and 4 bytes
a word and doubling level (the logarithm of its longest repeat) if it repeats.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.text import SMALL_CHUNK_BYTES, Texts, codes_of, mix64, ragged, text_chunks

LEAST = 12  # words of the shortest run
Rearrange = Callable[[int | None, int], np.ndarray | None]


def periodic_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """The word order of a text that this study makes periodic from some word
    on, or None where it stays as it is (also without an id or words)."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % p])


def _doubled(codes: np.ndarray) -> list[np.ndarray]:
    """Ranks of the 1, 2, 4, ... words from every place on, until all differ."""
    n = len(codes)
    levels = [np.unique(codes, return_inverse=True)[1].astype(np.int32)]
    step = 1
    while step < n and int(levels[-1].max()) + 1 < n:
        rank = levels[-1].astype(np.int64)
        beyond = np.zeros(n, np.int64)  # 0: past the end
        beyond[:-step] = rank[step:] + 1
        levels.append(np.unique(rank * (n + 1) + beyond, return_inverse=True)[1].astype(np.int32))
        step *= 2
    return levels


def _neighbours(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring places in suffix order and the words that they share."""
    levels = _doubled(codes)
    order = np.argsort(levels[-1], kind="stable")
    i, j, shared = order[:-1], order[1:], np.zeros(max(0, len(order) - 1), np.int64)
    last = len(codes) - 1
    for k in range(len(levels) - 1, -1, -1):
        x, y = i + shared, j + shared
        inside = (x <= last) & (y <= last)
        rank = levels[k]
        shared += (inside & (rank[np.minimum(x, last)] == rank[np.minimum(y, last)])).astype(np.int64) << k
    return i, j, shared


def runs_of(codes: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least ``least`` codes, by start,
    then period. Codes that occur once part texts that are searched together."""
    if len(codes) < 2:
        return []
    left, right, shared = _neighbours(codes)
    # A run of period q and length L >= 2q has an LCP of L - q >= L / 2.
    used = np.flatnonzero(shared >= max(1, -(-least // 2)))
    used = used[np.argsort(-shared[used], kind="stable")]
    before = np.concatenate([[-1], codes[:-1]]).tolist()
    class_of: dict[int, list[int]] = {}
    found: list[tuple[int, int, int]] = []

    def seed(i: int, j: int, lcp: int) -> None:
        period = j - i
        if period <= lcp and lcp + period >= least and (i == 0 or before[i] != before[j]):
            found.append((i, lcp + period, period))

    for i, j, lcp in zip(left[used].tolist(), right[used].tolist(), shared[used].tolist(), strict=True):
        large, small = class_of.get(i) or [i], class_of.get(j) or [j]
        if len(large) < len(small):
            large, small = small, large
        n, gap, last = len(large), -1, -1
        places = []
        for x in small:
            at = bisect_left(large, x)
            places.append(at)
            if at != gap:  # small's positions in one gap of large are neighbours already
                if gap >= 0 and gap < n:
                    seed(last, large[gap], lcp)
                if at:
                    seed(large[at - 1], x, lcp)
                gap = at
            last = x
        if gap < n:
            seed(last, large[gap], lcp)
        if len(small) < 8:
            for at, x in zip(reversed(places), reversed(small), strict=True):
                large.insert(at, x)
        else:
            large += small
            large.sort()  # two ascending stretches: one merge
        if len(large) == 1 + len(small):
            class_of[i] = class_of[j] = large
        for x in small:
            class_of[x] = large
    found.sort(key=lambda r: (r[0], r[2]))
    return found


def _may_repeat(code: np.ndarray, ends: np.ndarray, words: int) -> np.ndarray:
    """Texts in which some ``words`` words in a row occur twice (or seem to)."""
    n = len(code)
    doc = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    if n < words:
        return np.zeros(len(ends) - 1, bool)
    hashed = doc.astype(np.uint64)
    size = n - words + 1
    hashed = hashed[:size]
    for k in range(words):
        hashed = mix64(hashed * np.uint64(0x9E3779B97F4A7C15) + code[k : k + size].astype(np.uint64))
    whole = np.arange(size) + words <= ends[doc[:size] + 1]
    hashed, owner = hashed[whole], doc[:size][whole]
    order = np.argsort(hashed)
    hashed, owner = hashed[order], owner[order]
    again = hashed[1:] == hashed[:-1]
    out = np.zeros(len(ends) - 1, bool)
    out[owner[1:][again]] = True
    return out


def _chunk_runs(code: np.ndarray, ends: np.ndarray, least: int) -> list[list[tuple[int, int, int]]]:
    """The runs of every text of a chunk, from its words' codes."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(ends) - 1)]
    picked = np.flatnonzero(_may_repeat(code, ends, max(1, -(-least // 2))))
    n = np.diff(ends)[picked]
    if not len(picked):
        return out
    # Side by side, each with codes of its own and a code that occurs once after it.
    starts = np.concatenate([[0], np.cumsum(n + 1)])
    line = np.empty(int(starts[-1]), np.int64)
    owner = np.repeat(np.arange(len(picked)), n)
    line[ragged(starts[:-1], n)] = owner * (int(code.max()) + 1) + code[ragged(ends[:-1][picked], n)]
    line[starts[1:] - 1] = len(picked) * (int(code.max()) + 1) + np.arange(len(picked))
    for start, length, period in runs_of(line, least):
        at = int(np.searchsorted(starts, start, side="right")) - 1
        out[picked[at]].append((start - int(starts[at]), length, period))
    return out


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """The words that stay: those that no run holds beyond its first period."""
    step = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    return np.flatnonzero(np.cumsum(step[:n]) == 0)


_COLUMNS = [("n_words", pa.int64()), ("starts", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
            ("periods", pa.list_(pa.int64())), ("collapsed", pa.string())]


def _batch(texts: Texts, ids: list, rearrange: Rearrange | None, least: int):
    starts, lengths = texts.words()
    ends = texts.per_doc(starts)
    code = codes_of(texts.data, starts, lengths)[0] if len(starts) else np.zeros(0, np.int64)
    orders: dict[int, np.ndarray] = {}
    if rearrange is not None:
        for k, doc_id in enumerate(ids):
            order = rearrange(doc_id, int(ends[k + 1] - ends[k]))
            if order is not None:
                orders[k] = order
                code[ends[k] : ends[k + 1]] = code[ends[k] : ends[k + 1]][order]
    for k, runs in enumerate(_chunk_runs(code, ends, least)):
        words = texts.text_bytes(k).split()  # ASCII white space, as in Texts.words
        if k in orders:
            words = [words[i] for i in orders[k].tolist()]
        if runs:
            words = [words[i] for i in kept_words(len(words), runs).tolist()]
        yield int(ends[k + 1] - ends[k]), runs, b" ".join(words)


def find_runs(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
              rearrange: Rearrange | None = None) -> DataFrame:
    """The runs of every whole text, and the text without their repetitions.

    Words are runs of characters that are not ASCII white space, compared as
    they are and numbered from 0. Returns doc_id, n_words, the arrays starts,
    lengths and periods (one element per run of at least ``least`` words, by
    start, then period) and collapsed: the words that no run holds beyond its
    first period, joined by one space. ``rearrange(doc_id, n_words)`` may give
    another order of a text's words before the search (a function of those two
    alone, so that a task run again gives the same).

    Defined cases: a null or empty text, or one without words, has no runs and
    collapses to the empty string; a null id is passed on (and to
    ``rearrange``); runs that overlap are all reported; repeated rows are
    answered each; a text of any length is searched whole; other columns are
    ignored; an empty table gives no rows.
    """
    rows = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), *_COLUMNS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches, 1, SMALL_CHUNK_BYTES):
            n, found, collapsed = zip(*_batch(texts, part.column(0).to_pylist(), rearrange, least), strict=True)
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(n, pa.int64()),
                *(pa.array([[r[c] for r in runs] for runs in found], pa.list_(pa.int64())) for c in range(3)),
                pa.array([c.decode() for c in collapsed], pa.string()),
            ], schema=schema)

    kinds = "doc_id bigint, n_words bigint, starts array<bigint>, lengths array<bigint>, periods array<bigint>, collapsed string"
    return rows.mapInArrow(run, kinds)


def run_digests(found: DataFrame) -> DataFrame:
    """Per document of ``find_runs``: n_runs; start, length, period and
    exponent_milli of its longest run (ties: smallest start, then period; nulls
    without runs); sha256 of the list of runs and of the collapsed text."""
    triples = F.arrays_zip("starts", "lengths", "periods")
    line = lambda r: F.concat_ws(",", r["starts"], r["lengths"], r["periods"])
    listed = F.concat(F.array_join(F.transform(triples, line), "\n"), F.when(F.size("starts") > 0, "\n").otherwise(""))
    # Order by length down, then start and period up, as the greatest struct.
    longest = F.array_max(F.transform(triples, lambda r: F.struct(
        r["lengths"].alias("length"), (-r["starts"]).alias("start"), (-r["periods"]).alias("period"))))
    best = found.withColumn("best", longest)
    length, period = F.col("best.length"), -F.col("best.period")
    return best.select(
        "doc_id", F.size("starts").cast("bigint").alias("n_runs"), (-F.col("best.start")).alias("start"), length.alias("length"),
        period.alias("period"), F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
