"""Token ids, token counts and their digests over whole texts.

``encode_texts`` (byte-level BPE encoding and decoding) and ``count_tokens``
(counts from heap merging, without ids) read each text once in Arrow batches
and need no shuffle. The vocabulary file is read on the driver and broadcast:
its size is fixed (about 1 MB).

Defined cases, both operators: a null text counts as empty; an empty text has
no tokens; a very long text is one chunk of its task; repeated rows give equal
rows; a null id stays null; other input columns are ignored, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm import bpe
from meterlake.llm.text import WordTable, codes_of, segment_sums, text_chunks, two_words

OVER_LIMIT = 1024

_COLUMNS = {
    "n_tokens": "bigint",
    "ids": "array<int>",
    "starts": "array<bigint>",
    "ids_sha256": "string",
    "decoded_sha256": "string",
}

# Vocabularies of this worker process, by file digest: tasks of one worker
# share the cache of merged tokens.
_RANKS: dict[str, bpe.Ranks] = {}
_ENCODERS: dict[tuple[str, bool], bpe.Encoder] = {}
_COUNTS: dict[str, _CountCache] = {}


class Vocabulary:
    """A vocabulary file, sent to the executors once."""

    def __init__(self, spark, path: str):
        with open(path, "rb") as f:
            raw = f.read()
        self.kind = "json" if path.endswith(".json") else "tiktoken"
        self.key = hashlib.sha256(raw).hexdigest()
        self.raw: Broadcast = spark.sparkContext.broadcast(raw)

    def ranks(self) -> bpe.Ranks:
        if self.key not in _RANKS:
            load = bpe.load_json if self.kind == "json" else bpe.load_tiktoken
            _RANKS[self.key] = load(self.raw.value)
        return _RANKS[self.key]

    def encoder(self, special: bool) -> bpe.Encoder:
        at = (self.key, special)
        if at not in _ENCODERS:
            _ENCODERS[at] = bpe.Encoder(self.ranks(), special)
        return _ENCODERS[at]


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encode_texts(
    df: DataFrame,
    vocabulary: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    columns: tuple[str, ...] = ("ids", "starts"),
    special: bool = False,
) -> DataFrame:
    """Ids of every whole text, by the ranks of a vocabulary file.

    ``columns`` picks from: ``n_tokens``; ``ids``; ``starts`` (byte position
    of each token in the text, which ``decode_ids`` needs none of but span
    look-ups do); ``ids_sha256`` (of the ids as little-endian 32-bit words);
    ``decoded_sha256`` (of the bytes decoded from the ids).

    Defined cases: a null or empty text has no ids; a text of any length is
    encoded whole; repeated rows are encoded each; a null id stays null; other
    columns are ignored; an empty table gives no rows.
    """
    vocab = Vocabulary(df.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocab.encoder(special)
        for rows, texts in text_chunks(batches, 1):
            ids, offsets = encoder.encode(texts)
            made = {"doc_id": rows.column(0)}
            for name in columns:
                made[name] = _column(encoder, name, ids, offsets)
            yield pa.RecordBatch.from_pydict(made)

    schema = ", ".join(["doc_id bigint", *(f"{c} {_COLUMNS[c]}" for c in columns)])
    return id_and_text(df, id_col, text_col).mapInArrow(run, schema)


def _column(encoder: bpe.Encoder, name: str, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    if name == "n_tokens":
        return pa.array(np.diff(offsets), pa.int64())
    if name == "ids":
        return pa.ListArray.from_arrays(offsets.astype(np.int32), ids.astype(np.int32))
    if name == "starts":
        size = encoder.token_len[ids]
        before = np.concatenate([[0], np.cumsum(size)])
        at = before[:-1] - np.repeat(before[offsets[:-1]], np.diff(offsets))
        return pa.ListArray.from_arrays(offsets.astype(np.int32), at)
    if name == "ids_sha256":
        return pa.array(_digests(ids.astype("<u4").view(np.uint8), offsets * 4), pa.string())
    data, ends = encoder.decode(ids, offsets)
    return pa.array(_digests(data, ends), pa.string())


def _digests(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    body = memoryview(np.ascontiguousarray(data))
    ends = offsets.tolist()
    return [hashlib.sha256(body[a:b]).hexdigest() for a, b in zip(ends, ends[1:], strict=False)]


def decode_ids(df: DataFrame, vocabulary: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The bytes of every list of ids: ``doc_id``, ``decoded`` (binary).

    Defined cases: a null or empty list gives no bytes; nulls in a list and ids
    that the vocabulary does not have (negative or too large) give none of their
    own; repeated rows are decoded each; a null id stays null; other columns are
    ignored; an empty table gives no rows.
    """
    vocab = Vocabulary(df.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocab.encoder(False)
        for rows in batches:
            n = len(encoder.token_len)
            lists = [np.array([i for i in x.as_py() or [] if i is not None and 0 <= i < n], np.int64) for x in rows.column(1)]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
            data, ends = encoder.decode(np.concatenate([np.zeros(0, np.int64), *lists]), offsets)
            parts = [data[a:b].tobytes() for a, b in zip(ends.tolist(), ends.tolist()[1:], strict=False)]
            yield pa.RecordBatch.from_pydict({"doc_id": rows.column(0), "decoded": pa.array(parts, pa.binary())})

    picked = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return picked.mapInArrow(run, "doc_id bigint, decoded binary")


def count_tokens(
    df: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = OVER_LIMIT
) -> DataFrame:
    """Tokens of every whole text, from merges alone: a token's count is its
    bytes minus the pairs that heap merging joins. No ids are made.

    Returns doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``).
    Cases as for :func:`encode_texts`.
    """
    vocab = Vocabulary(df.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, cache = vocab.ranks(), _COUNTS.setdefault(vocab.key, _CountCache())
        for rows, texts in text_chunks(batches, 1):
            n_tokens = _counts(ranks, cache, texts)
            yield pa.RecordBatch.from_pydict({
                "doc_id": rows.column(0),
                "n_bytes": pa.array(np.diff(texts.offsets), pa.int64()),
                "n_tokens": pa.array(n_tokens, pa.int64()),
                "over_limit": pa.array(n_tokens > limit),
            })

    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return id_and_text(df, id_col, text_col).mapInArrow(run, schema)


class _CountCache:
    """Counts of distinct tokens of up to 15 bytes, kept per worker."""

    def __init__(self):
        self.table, self.used = WordTable(bpe.CACHE_ENTRIES), 0

    def counts(self, ranks: bpe.Ranks, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        if self.used + len(starts) > bpe.CACHE_ENTRIES and self.used:
            self.table, self.used = WordTable(bpe.CACHE_ENTRIES), 0
        out = np.full(len(starts), -1, np.int64)
        short = np.flatnonzero(lengths < 16)
        low, high = two_words(data, starts[short], lengths[short])
        out[short] = self.table.get(low, high)
        missing = np.flatnonzero(out < 0)
        body = data.tobytes()
        for row, s, k in zip(missing.tolist(), starts[missing].tolist(), lengths[missing].tolist(), strict=True):
            out[row] = k - bpe.merge_heap(ranks, body[s : s + k])[0]
        new = np.isin(short, missing, assume_unique=True)
        if new.sum() <= bpe.CACHE_ENTRIES:
            self.table.put(low[new], high[new], out[short[new]])
            self.used += int(new.sum())
        return out


def _counts(ranks: bpe.Ranks, cache: _CountCache, texts) -> np.ndarray:
    parts = bpe.split_special(texts, ranks.special)
    starts, lengths, docs = bpe.token_slices(parts)
    if len(starts):
        codes, first = codes_of(parts.data, starts, lengths)
        counts = cache.counts(ranks, parts.data, starts[first], lengths[first])
        per_part = segment_sums(counts[codes], docs)
    else:
        per_part = np.zeros(len(docs) - 1, np.int64)
    if not isinstance(parts, bpe.Parts):
        return per_part
    return parts.join_counts(per_part)
