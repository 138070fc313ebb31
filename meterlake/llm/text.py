"""Array views of text batches, shared by the operators that read whole texts.

A batch of texts is laid out as one UTF-8 byte array with document offsets.
Words, tokens and lines are (start, length) slices of that array, and equal
slices get equal integer codes, so that later steps work on integers.
Everything here runs inside a Spark task on one Arrow batch.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

# Text handled at once inside a task; a longer single text is one chunk.
CHUNK_BYTES = 4 << 20
# For operators that gain little from larger chunks: half the working memory.
SMALL_CHUNK_BYTES = 2 << 20

_ASCII_SPACE = np.zeros(256, bool)
_ASCII_SPACE[[0x20, *range(0x09, 0x0E)]] = True

# Bytes k.. of a little-endian word that lie beyond a slice of length k.
_LOW = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


class Texts:
    """One chunk: ``data`` bytes (zero padded), ``offsets`` of its documents."""

    def __init__(self, column: pa.Array):
        column = column.fill_null("") if column.null_count else column
        wide = column.cast(pa.large_string())
        raw = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
        body = wide.buffers()[2]
        lo, hi = (int(raw[0]), int(raw[-1])) if len(wide) else (0, 0)
        self.data = np.zeros(hi - lo + 32, np.uint8)
        if hi > lo:
            self.data[: hi - lo] = np.frombuffer(body, np.uint8)[lo:hi]
        self.size = hi - lo
        self.offsets = (raw - lo).astype(np.int64) if len(wide) else np.zeros(1, np.int64)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text_bytes(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def doc_of(self, starts: np.ndarray) -> np.ndarray:
        """The document each byte position lies in."""
        return np.searchsorted(self.offsets, starts, side="right") - 1

    def per_doc(self, positions: np.ndarray) -> np.ndarray:
        """Offsets that split ascending byte positions by document."""
        return np.searchsorted(positions, self.offsets, side="left")

    def lower_ascii(self) -> None:
        upper = (self.data >= 0x41) & (self.data <= 0x5A)
        self.data[upper] += 32

    def codepoints(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code points, their byte positions (with the end), document offsets in code points."""
        body = self.data[: self.size]
        cps = np.frombuffer(body.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        at = np.flatnonzero((body & 0xC0) != 0x80)
        docs = np.searchsorted(at, self.offsets, side="left")
        return cps, np.append(at, self.size), docs

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and lengths of the runs of bytes that are not ASCII white space."""
        inside = ~_ASCII_SPACE[self.data[: self.size]]
        return _runs(inside, self.offsets)


def _runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of true cells that do not cross document offsets."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edge = offsets[(offsets > 0) & (offsets < n)]
    first[edge] = inside[edge]
    last[edge - 1] = inside[edge - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1 - starts


def text_chunks(batches, text_at: int, limit: int = CHUNK_BYTES):
    """(batch rows, Texts) for every chunk of every Arrow batch."""
    for batch in batches:
        column = batch.column(text_at)
        lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        lo, total = 0, 0
        for i, size in enumerate(lengths.tolist()):
            if i > lo and total + size > limit:
                yield batch.slice(lo, i - lo), Texts(column.slice(lo, i - lo))
                lo, total = i, 0
            total += size
        if lo < len(lengths):
            yield batch.slice(lo), Texts(column.slice(lo))


def codes_of(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code of every slice (equal bytes, equal code) and a first slice per code.

    Exact: slices up to 15 bytes are compared as one or two machine words
    that hold their bytes and length, longer ones as byte strings.
    """
    assert sys.byteorder == "little"
    n = len(starts)
    codes = np.empty(n, np.int64)
    firsts: list[np.ndarray] = []
    used = 0
    if not n:
        return codes, np.zeros(0, np.int64)
    window = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    size = lengths.astype(np.uint64) << np.uint64(56)
    short = np.flatnonzero(lengths < 8)
    if len(short):
        key = (window[starts[short]] & _LOW[lengths[short]]) | size[short]
        got, uniques = pd.factorize(key)
        codes[short] = got
        firsts.append(short[_first(got, len(uniques))])
        used = len(uniques)
    middle = np.flatnonzero((lengths >= 8) & (lengths < 16))
    if len(middle):
        low = window[starts[middle]]
        high = (window[starts[middle] + 8] & _LOW[lengths[middle] - 8]) | size[middle]
        got, first = pair_codes(low, high)
        codes[middle] = got + used
        firsts.append(middle[first])
        used += len(first)
    long = np.flatnonzero(lengths >= 16)
    if len(long):
        seen: dict[bytes, int] = {}
        body = data.tobytes()
        got = np.fromiter(
            (seen.setdefault(body[s : s + k], len(seen)) for s, k in zip(starts[long].tolist(), lengths[long].tolist(), strict=True)),
            np.int64, len(long),
        )
        codes[long] = got + used
        firsts.append(long[_first(got, len(seen))])
    return codes, np.concatenate(firsts)


def _first(codes: np.ndarray, n: int) -> np.ndarray:
    first = np.empty(n, np.int64)
    first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return first


def pair_codes(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of pairs of 64-bit words (exact) and a first position per code."""
    a, b = a.astype(np.uint64, copy=False), b.astype(np.uint64, copy=False)
    mixed = mix64(a ^ mix64(b))
    got, uniques = pd.factorize(mixed)
    first = _first(got, len(uniques))
    if (a[first][got] == a).all() and (b[first][got] == b).all():
        return got, first
    ca, ua = pd.factorize(a)  # two pairs share a mixed word: compare the words themselves
    cb, ub = pd.factorize(b)
    got, uniques = pd.factorize(ca.astype(np.int64) * len(ub) + cb)
    return got, _first(got, len(uniques))


def two_words(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slices of up to 15 bytes as two machine words, one to one: bytes, and length on top."""
    window = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    low = window[starts] & _LOW[np.minimum(lengths, 8)]
    high = window[starts + 8] & _LOW[np.maximum(lengths - 8, 0)]
    return low, high | lengths.astype(np.uint64) << np.uint64(56)


class WordTable:
    """Exact map from pairs of machine words to integers, for whole arrays."""

    def __init__(self, capacity: int):
        self.bits = max(10, int(np.ceil(np.log2(capacity * 2))))
        self.mask = (1 << self.bits) - 1
        self.low, self.high = (np.zeros(1 << self.bits, np.uint64) for _ in range(2))
        self.value = np.full(1 << self.bits, -1, np.int64)

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (mix64(low ^ mix64(high)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where it is absent."""
        out = np.full(len(low), -1, np.int64)
        rows, slot = np.arange(len(low)), self._slot(low, high)
        while len(rows):
            value = self.value[slot]
            hit = (value >= 0) & (self.low[slot] == low[rows]) & (self.high[slot] == high[rows])
            out[rows[hit]] = value[hit]
            on = (value >= 0) & ~hit
            rows, slot = rows[on], (slot[on] + 1) & self.mask
        return out

    def put(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> None:
        """Distinct keys that are absent. Of two keys that meet in a slot with
        equal values only one may be kept."""
        rows, slot = np.arange(len(low)), self._slot(low, high)
        while len(rows):
            free = self.value[slot] < 0
            self.value[slot[free]] = value[rows[free]]  # of several in one slot the last one stays
            mine = free & (self.value[slot] == value[rows])
            self.low[slot[mine]], self.high[slot[mine]] = low[rows[mine]], high[rows[mine]]
            rows, slot = rows[~mine], (slot[~mine] + 1) & self.mask


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (xor-shift and odd multiplications)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def slice_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash per slice, the same for equal bytes in any batch."""
    out = mix64(lengths.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    if not len(starts):
        return out
    window = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    left, at, rows = lengths.astype(np.int64).copy(), starts.astype(np.int64).copy(), np.arange(len(starts))
    while len(rows):
        word = window[at[rows]] & _LOW[np.minimum(left[rows], 8)]
        out[rows] = mix64(out[rows] * np.uint64(0x9E3779B97F4A7C15) + word)
        left[rows] -= 8
        at[rows] += 8
        rows = rows[left[rows] > 0]
    return out


def ragged(offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices that list ``offsets[i] .. offsets[i] + lengths[i]`` one after another."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.repeat(offsets - (ends - lengths), lengths) + np.arange(total)


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets (0 where empty)."""
    total = np.concatenate([np.zeros(1, values.dtype if values.dtype.kind == "f" else np.int64), np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def subword_hashes(
    data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, sizes: tuple[int, ...]
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every slice's byte n-grams (with marked ends) and of the whole
    slice, one slice after another, and their offsets by slice; sizes up to 7."""
    size = lengths + 2
    at = np.concatenate([[0], np.cumsum(size)])
    marked = np.zeros(int(at[-1]) + 8, np.uint8)
    marked[at[:-1]] = ord("<")
    marked[at[1:] - 1] = ord(">")
    marked[ragged(at[:-1] + 1, lengths)] = data[ragged(starts, lengths)]
    window = np.ndarray((len(marked) - 7,), dtype="<u8", buffer=marked, strides=(1,))
    slice_of = np.repeat(np.arange(len(starts)), size)
    left = np.repeat(at[1:], size) - np.arange(int(at[-1]))
    owners, hashes = [np.arange(len(starts))], [slice_hashes(marked, at[:-1], size)]
    for k in sizes:
        begin = np.flatnonzero(left >= k)
        owners.append(slice_of[begin])
        hashes.append(mix64((window[begin] & _LOW[k]) | np.uint64(k << 56)))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(hashes)[order], np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(starts)))])
