"""Best-fit packing of tokenised documents into sequences of fixed length.

Sum-of-squares packing: with N(g) open sequences that have g tokens left, a
piece goes where the sum of the N(g)^2 becomes smallest, either into an open
sequence or into a new one. Only documents longer than a sequence are cut.

The state of the method is the counts N(g), so pieces can be packed in
independent shards: each shard is one task of bounded size and leaves only a
few open sequences behind. The pieces are written once with a number of their
own, counted, and dealt to shards by a hash of that number, so a shard has about
``SHARD_PIECES`` pieces, however long the documents are and however often a row
occurs.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.graph import stored
from meterlake.llm.text import text_chunks
from meterlake.llm.tokens import Vocabulary, id_and_text

CAPACITY = 2048
END_OF_DOCUMENT = 0
SHARD_PIECES = 16_384

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_PACKED = f"{_PIECES}, sequence_id bigint, offset bigint"


def cut(n: int, capacity: int) -> list[int]:
    """Piece lengths of a document of n tokens: full pieces, the first may be shorter."""
    rest = n % capacity
    return ([rest] if rest else []) + [capacity] * (n // capacity)


def pieces(
    df: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, end_id: int = END_OF_DOCUMENT,
) -> DataFrame:
    """Token pieces of every document: its ids (with ``end_id`` after them), cut to
    capacity. Cases as for :func:`pack_documents`."""
    vocab = Vocabulary(df.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocab.encoder(True)
        for rows, texts in text_chunks(batches, 1):
            ids, offsets = encoder.encode(texts)
            ends = offsets[1:] + np.arange(1, len(offsets))  # with an end id after each document
            full = np.insert(ids, offsets[1:], np.uint32(end_id)).astype("<u4")
            body = memoryview(full.view(np.uint8))
            out: list[tuple] = []
            begin = 0
            for row, end in enumerate(ends.tolist()):
                at = begin
                for k, size in enumerate(cut(end - begin, capacity)):
                    out.append((row, k, at - begin, size, zlib.crc32(body[4 * at : 4 * (at + size)])))
                    at += size
                begin = end
            row, k, start, size, crc = (np.array(x, np.int64) for x in zip(*out, strict=True))
            yield pa.RecordBatch.from_pydict({
                "doc_id": rows.column(0).take(pa.array(row)),
                "piece": pa.array(k, pa.int32()),
                "start": pa.array(start),
                "length": pa.array(size),
                "ids_crc32": pa.array(crc),
            })

    return id_and_text(df, id_col, text_col).mapInArrow(run, _PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, placed in the given order.

    Placing a piece of length s into a sequence with gap g changes the sum of
    squares by 2 N(g - s) - 2 N(g) + 2 (the first term is absent where the
    piece fills the gap); a new one is a gap of ``capacity`` that no count
    holds. Ties go to the smallest gap.
    """
    count = np.zeros(capacity + 1, np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    used = 0
    big = np.int64(1) << 62
    for i, s in enumerate(lengths.tolist()):
        change = 2 * (count[: capacity + 1 - s] - count[s:]) + 2  # by resulting gap
        change[0] = 1 - 2 * count[s]
        change[count[s:] == 0] = big
        fresh = 2 * int(count[capacity - s]) + 1 if s < capacity else 0
        left = int(change.argmin())
        if change[left] <= fresh:
            gap = left + s
            which = open_at[gap].pop()
            count[gap] -= 1
            sequence[i], offset[i] = which, capacity - gap
        else:
            left, which = capacity - s, used
            used += 1
            sequence[i], offset[i] = which, 0
        if left:
            open_at[left].append(which)
            count[left] += 1
    return sequence, offset


def pack(numbered: DataFrame, n_shards: int, *, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows of :func:`pieces` that have a
    ``number`` of their own each. Nulls and repeated rows are pieces like others."""

    def one(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece", "ids_crc32", "number"], ascending=[False, True, True, True, True], na_position="first", kind="stable")
        sequence, offset = sum_of_squares(group["length"].to_numpy(), capacity)
        shard = int(group["shard"].iloc[0])
        return group.drop(columns=["shard", "number"]).assign(sequence_id=(np.int64(shard) << 32) + sequence, offset=offset)

    shard = F.pmod(F.xxhash64("number"), F.lit(n_shards))
    return numbered.withColumn("shard", shard).groupBy("shard").applyInPandas(one, _PACKED)


def pack_documents(
    df: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, end_id: int = END_OF_DOCUMENT, shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """Whole documents into sequences of at most ``capacity`` tokens.

    Returns doc_id, piece (from 0), start (ids of the document before it),
    length, ids_crc32, sequence_id and offset (gapless from 0 in a sequence).

    Defined cases: a null or empty text is the end id alone; a text of any
    length is cut into pieces of ``capacity`` tokens, the first may be shorter;
    repeated rows are packed as often as they occur; a null id stays null;
    ties go to the fullest sequence; other input columns are ignored; an empty
    table gives no rows.
    """
    found = pieces(df, vocabulary, id_col=id_col, text_col=text_col, capacity=capacity, end_id=end_id)
    numbered = stored(found.withColumn("number", F.monotonically_increasing_id()), "pieces")
    return pack(numbered, max(1, math.ceil(numbered.count() / shard_pieces)), capacity=capacity)
