"""SimHash near-duplicates: byte-position inverted index with count filtering.

A fingerprint is eight bytes. Two that differ in at most two bits share at
least ``LEAST_SHARED`` = 6 of their bytes, place by place. The index therefore
lists each distinct fingerprint under every choice of six places with the
bytes there (28 lists): two fingerprints meet in a list exactly when their
tally of shared positional bytes reaches that guaranteed minimum, and a list
holds at most 2**16 fingerprints (two free bytes), whatever the data. Copies
count once, so a large group of copies is one entry, and near copies spread
over as many lists as their differing bytes have values.

Within a list, pairs are tallied over all eight places and verified by their
differing bits. A list longer than ``LONG_LIST`` isn't paired up: a verified
partner differs from a fingerprint in one byte (tally 7, one or two bits of
it) or in both free bytes (tally 6, one bit each), so the 136 partners that
these tallies allow are looked up in the sorted list. Both ways find the same
pairs; a task passes on a spanning forest of what its batch found.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.graph import components, stored
from meterlake.llm.text import SMALL_CHUNK_BYTES, Texts, ragged, text_chunks

SIZE = 3  # words of a shingle
SEED = 42
PLACES = 8
MOST_BITS = 2
LEAST_SHARED = PLACES - MOST_BITS
LONG_LIST = 256
PAIRS_AT_ONCE = 1 << 20

# The five primes of XXH64.
_P1 = np.uint64(0x9E3779B185EBCA87)
_P2 = np.uint64(0xC2B2AE3D27D4EB4F)
_P3 = np.uint64(0x165667B19E3779F9)
_P4 = np.uint64(0x85EBCA77C2B2AE63)
_P5 = np.uint64(0x27D4EB2F165667C5)


# --- fingerprints --------------------------------------------------------------------


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def xxh64_slices(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of every slice of ``data`` (padded by 8 bytes): all slices below 32
    bytes side by side, longer ones one by one through the library."""
    out = np.uint64(seed) + _P5 + lengths.astype(np.uint64)
    at, left = starts.copy(), np.where(lengths < 32, lengths, 0)
    words = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    while len(rows := np.flatnonzero(left >= 8)):
        out[rows] = _rotated(out[rows] ^ (_rotated(words[at[rows]] * _P2, 31) * _P1), 27) * _P1 + _P4
        at[rows] += 8
        left[rows] -= 8
    rows = np.flatnonzero(left >= 4)
    half = words[at[rows]] & np.uint64(0xFFFFFFFF)
    out[rows] = _rotated(out[rows] ^ (half * _P1), 23) * _P2 + _P3
    at[rows] += 4
    left[rows] -= 4
    while len(rows := np.flatnonzero(left > 0)):
        out[rows] = _rotated(out[rows] ^ (data[at[rows]].astype(np.uint64) * _P5), 11) * _P1
        at[rows] += 1
        left[rows] -= 1
    out ^= out >> np.uint64(33)
    out *= _P2
    out ^= out >> np.uint64(29)
    out *= _P3
    out ^= out >> np.uint64(32)
    long = np.flatnonzero(lengths >= 32)
    if len(long):
        body = memoryview(data)
        out[long] = [xxhash.xxh64_intdigest(body[s : s + n], seed) for s, n in zip(starts[long].tolist(), lengths[long].tolist(), strict=True)]
    return out


def _shingles(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Every text's words joined by one blank, A-Z lowered; its shingles as
    slices of that (repeats included), and their offsets by text."""
    texts.lower_ascii()
    starts, lengths = texts.words()
    ends = texts.per_doc(starts)
    place = np.concatenate([[0], np.cumsum(lengths + 1)])
    line = np.full(int(place[-1]) + 8, 0x20, np.uint8)
    line[ragged(place[:-1], lengths)] = texts.data[ragged(starts, lengths)]
    n_words = np.diff(ends)
    count = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    first = ragged(ends[:-1], count)
    last = np.minimum(first + size, np.repeat(ends[1:], count)) - 1
    return line, place[first], place[last] + lengths[last] - place[first], np.concatenate([[0], np.cumsum(count)])


def majority_bits(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per group the 64 bits that more than half of its hashes have."""
    n = np.diff(offsets)
    # Four 16-bit counters in a word cannot overflow within 2**15 hashes.
    cuts = np.unique(np.concatenate([offsets, np.arange(0, len(hashes), 1 << 15)]))
    group = np.searchsorted(cuts, offsets)
    lanes = np.uint64(0x0001000100010001)
    out = np.zeros(len(n), np.uint64)
    for k in range(16):
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum((hashes >> np.uint64(k)) & lanes, dtype=np.uint64)])[cuts]
        part = run[1:] - run[:-1]
        for lane in range(4):
            counts = np.concatenate([[0], np.cumsum((part >> np.uint64(16 * lane)) & np.uint64(0xFFFF), dtype=np.int64)])[group]
            out |= (2 * np.diff(counts) > n).astype(np.uint64) << np.uint64(k + 16 * lane)
    return out


def fingerprints(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """doc_id and the 64-bit fingerprint (as a bigint) of every whole text."""
    rows = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches, 1, SMALL_CHUNK_BYTES):
            line, starts, lengths, offsets = _shingles(texts, size)
            bits = majority_bits(xxh64_slices(line, starts, lengths), offsets)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(bits.view(np.int64))], names=["doc_id", "fp"])

    return rows.mapInArrow(run, "doc_id bigint, fp bigint")


# --- index -----------------------------------------------------------------------------


def _list_masks() -> list[int]:
    """The bits of six places, for every choice of them, as signed 64-bit values."""
    masks = (sum(0xFF << 8 * p for p in chosen) for chosen in combinations(range(PLACES), LEAST_SHARED))
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def tally(x: np.ndarray) -> np.ndarray:
    """Positional bytes that two fingerprints share, from their exclusive or."""
    return sum(((x >> np.uint64(8 * p)) & np.uint64(0xFF)) == 0 for p in range(PLACES))


def _partners(free: int) -> np.ndarray:
    """Differences that a verified pair of a list may have in its two free bytes:
    one or two bits of one byte (tally 7), one bit of each (tally 6)."""
    places = [p for p in range(PLACES) if free >> 8 * p & 0xFF]
    bits = [[1 << (8 * p + b) for b in range(8)] for p in places]
    found = [x for byte in bits for x in byte] + [x | y for byte in bits for x, y in combinations(byte, 2)]
    if len(bits) == 2:
        found += [x | y for x in bits[0] for y in bits[1]]
    return np.array(found, np.uint64)


def _pairs_of_lists(fp: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of verified fingerprints that share a list. Lists are the
    stretches between ``ends``, each in ascending (signed) order."""
    bits = fp.view(np.uint64)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    size = np.diff(ends)
    short = size <= LONG_LIST
    rows = ragged(ends[:-1][short], size[short])
    after = np.repeat(ends[1:][short], size[short]) - rows - 1
    total = np.cumsum(after)
    for lo in range(0, int(total[-1]) if len(total) else 0, PAIRS_AT_ONCE):
        part = slice(*np.searchsorted(total, [lo, lo + PAIRS_AT_ONCE], side="right"))
        a = np.repeat(rows[part], after[part])
        b = ragged(rows[part] + 1, after[part])
        x = bits[a] ^ bits[b]
        ok = tally(x) >= LEAST_SHARED
        ok[ok] = np.bitwise_count(x[ok]) <= MOST_BITS
        left.append(a[ok])
        right.append(b[ok])
    for k in np.flatnonzero(~short).tolist():
        lo, hi = int(ends[k]), int(ends[k + 1])
        members = fp[lo:hi]
        for x in _partners(~int(mask[lo]) & (1 << 64) - 1):
            wanted = (bits[lo:hi] ^ x).view(np.int64)
            at = np.minimum(np.searchsorted(members, wanted), hi - lo - 1)
            hit = np.flatnonzero((members[at] == wanted) & (at > np.arange(hi - lo)))
            left.append(lo + hit)
            right.append(lo + at[hit])
    return np.concatenate(left), np.concatenate(right)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stars (node, smallest node) that connect what the pairs connect."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        least = np.minimum(label[x], label[y])
        np.minimum.at(label, label[x], least)
        np.minimum.at(label, label[y], least)
        label = label[label]
        if (label == before).all():
            break
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def _links_of_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the lists of a sorted partition; a list may go on in the next batch."""
    kept_mask, kept_fp = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def links(mask: np.ndarray, fp: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
        ends = np.append(starts, len(fp))
        a, b = _pairs_of_lists(fp, ends, mask)
        a, b = forest(fp[a], fp[b])
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        mask = np.concatenate([kept_mask, batch.column(0).to_numpy()])
        fp = np.concatenate([kept_fp, batch.column(1).to_numpy()])
        if not len(fp):
            continue
        listed = mask & fp
        new = np.ones(len(fp), bool)
        new[1:] = (mask[1:] != mask[:-1]) | (listed[1:] != listed[:-1])
        starts = np.flatnonzero(new)
        whole = int(starts[-1])
        yield links(mask[:whole], fp[:whole], starts[:-1])
        kept_mask, kept_fp = mask[whole:], fp[whole:]
    if len(kept_fp):
        yield links(kept_mask, kept_fp, np.zeros(1, np.int64))


def _links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within two bits."""
    posted = distinct.select("fp").withColumn("mask", F.explode(F.array(*[F.lit(m) for m in _list_masks()]))).select("mask", "fp")
    key = ["mask", F.col("mask").bitwiseAND(F.col("fp"))]
    return posted.repartition(*key).sortWithinPartitions(*key, "fp").mapInArrow(_links_of_lists, "a bigint, b bigint")


def _same_id_links(prints: DataFrame) -> DataFrame:
    """Links between the different fingerprints of rows that repeat a doc_id."""
    named = prints.where(F.col("doc_id").isNotNull())
    hubs = named.groupBy("doc_id").agg(F.min("fp").alias("b"), F.max("fp").alias("most")).where("b < most").select("doc_id", "b")
    return named.join(hubs, "doc_id").where("fp <> b").select(F.col("fp").alias("a"), "b")


def _hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def near_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """Near-duplicate components of documents by 64-bit SimHash.

    Returns doc_id, fingerprint (16 lowercase hex digits) and component_id: the
    smallest doc_id reachable over fingerprints that differ in at most two bits.

    Words are runs of characters that are not ASCII white space, with A-Z
    lowered; a bit is set if it is in over half the XXH64 hashes (seed 42) of
    the text's ``size``-word shingles, repeats included.

    Defined cases: a text with fewer words than a shingle has its whole
    sequence as its only one; a null or empty text, or one without words, has
    fingerprint zero and is linked like any other; equal fingerprints are
    linked; rows that repeat a doc_id are the same document, so the links of
    their texts are joined; a row with a null id links others, and its component_id is
    the smallest id that it reaches, null if it reaches none; a text of any
    length is read whole; other columns are ignored; an empty table gives no
    rows.
    """
    prints = stored(fingerprints(df, id_col=id_col, text_col=text_col, size=size), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct_fingerprints")
    labels = components(_links(distinct).union(_same_id_links(prints)).distinct())
    named = distinct.join(labels.select(F.col("node").alias("fp"), "label"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    heads = named.groupBy("label").agg(F.min("least").alias("component_id"))
    members = stored(named.join(heads, "label").select("fp", "component_id"), "members")
    return prints.join(members, "fp").select("doc_id", _hex(F.col("fp")).alias("fingerprint"), "component_id")
