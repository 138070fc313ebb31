"""Token ids, counts and packing against the public libraries."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meterlake.llm import bpe, packing, tokens
from meterlake.llm.text import Texts
from tests.conftest import SF_SMALL

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def own():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(JSON)


def _strange(n: int) -> list[str]:
    rng = random.Random(3)
    parts = ["'", "s", "t", "re", "ll", "ve", "d", "m", " ", "  ", "\n", "\t", "a", "é", "1", "२", "!", "…", " ", "　",
             "中", "😀", "\x1c", "\x85", "<|endoftext|>", "A", "'S", "\r\n", "​", "Ⅷ", "²", "\0", "word"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_ids_of_strange_texts(own, lib):
    texts = [*_strange(4000), "", "x" * 5000, "ab" * 3000 + " " * 200, "漢" * 900]
    batch = Texts(pa.array([*texts, None]))
    with open(RANKS, "rb") as f:
        encoder = bpe.Encoder(bpe.load_tiktoken(f.read()))
    ids, offsets = encoder.encode(batch)
    decoded, ends = encoder.decode(ids, offsets)
    for i, text in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == own.encode_ordinary(text), text
        assert decoded[ends[i] : ends[i + 1]].tobytes() == text.encode()
    assert offsets[-1] == offsets[-2]
    with open(JSON, "rb") as f:
        ranks = bpe.load_json(f.read())
    ids, offsets = bpe.Encoder(ranks, special=True).encode(batch)
    counts = tokens._counts(ranks, tokens._CountCache(), batch)
    for i, text in enumerate(texts):
        wanted = lib.encode(text, add_special_tokens=False).ids
        assert ids[offsets[i] : offsets[i + 1]].tolist() == wanted, text
        assert counts[i] == len(wanted)


def test_every_code_point_before_a_suffix(own, lib):
    """All code points that a text can hold, beside letters, numbers and a suffix, in both libraries."""
    with open(RANKS, "rb") as f:
        encoder = bpe.Encoder(bpe.load_tiktoken(f.read()))
    with open(JSON, "rb") as f:
        ranks = bpe.load_json(f.read())
    cps = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for lo in range(0, len(cps), 1 << 16):
        texts = [f"x {c}'s a{c} 1{c}" for c in map(chr, cps[lo : lo + (1 << 16)])]
        batch = Texts(pa.array(texts))
        ids, offsets = encoder.encode(batch)
        wanted = own.encode_ordinary_batch(texts)
        assert ids.tolist() == [i for w in wanted for i in w] and np.diff(offsets).tolist() == [len(w) for w in wanted]
        counts = tokens._counts(ranks, tokens._CountCache(), batch)
        assert counts.tolist() == [len(e.ids) for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_heap_and_row_merging_agree():
    with open(RANKS, "rb") as f:
        ranks = bpe.load_tiktoken(f.read())
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 9, 20, 32):
        data = rng.integers(97, 105, (200, size)).astype(np.uint8)
        ids, counts = bpe.merge_many(ranks, data.reshape(-1), np.arange(200) * size, size)
        for row in range(200):
            merges, symbols = bpe.merge_heap(ranks, data[row].tobytes())
            assert [s for s in symbols if s >= 0] == ids[row, : counts[row]].tolist()
            assert size - merges == counts[row]


def test_encode_edge_rows(edge_documents, clashing, no_documents, own):
    names = ("n_tokens", "ids", "starts", "ids_sha256", "decoded_sha256")
    rows = tokens.encode_texts(edge_documents, RANKS, columns=names).collect()
    given = edge_documents.collect()
    assert len(rows) == len(given)
    for r, d in zip(rows, given, strict=True):
        wanted = own.encode_ordinary(d.text or "")
        assert (r.doc_id, r.ids, r.n_tokens) == (d.doc_id, wanted, len(wanted))
        assert r.ids_sha256 == hashlib.sha256(np.array(wanted, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
        sizes = [len(own.decode_single_token_bytes(i)) for i in wanted]
        assert r.starts == [sum(sizes[:k]) for k in range(len(sizes))][: len(sizes)] if len(sizes) < 500 else True
    assert tokens.encode_texts(clashing, RANKS, columns=("n_tokens",)).count() == len(given)
    assert tokens.encode_texts(no_documents, RANKS).collect() == []


def test_decode_ids_round_trip(edge_documents):
    encoded = tokens.encode_texts(edge_documents, RANKS)
    decoded = tokens.decode_ids(encoded, RANKS).collect()
    assert [bytes(r.decoded) for r in decoded] == [(d.text or "").encode() for d in edge_documents.collect()]


def test_decode_strange_ids(spark):
    top = sum(1 for _ in open(RANKS, "rb"))
    rows = [(1, [5, None, 6]), (2, [top]), (3, [-1, 7]), (4, None), (5, []), (None, [8])]
    got = tokens.decode_ids(spark.createDataFrame(rows, "doc_id long, ids array<int>"), RANKS).collect()
    one = {i: bytes(tokens.decode_ids(spark.createDataFrame([(0, [i])], "doc_id long, ids array<int>"), RANKS).first().decoded) for i in (5, 6, 7, 8)}
    assert [(r.doc_id, bytes(r.decoded)) for r in got] == [
        (1, one[5] + one[6]), (2, b""), (3, one[7]), (4, b""), (5, b""), (None, one[8])]


def test_counts_edge_rows(edge_documents, clashing, no_documents, lib):
    for df in (edge_documents, clashing):
        for r, d in zip(tokens.count_tokens(df, JSON).collect(), df.collect(), strict=True):
            n = len(lib.encode(d.text or "", add_special_tokens=False).ids)
            assert (r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) == (d.doc_id, len((d.text or "").encode()), n, n > 1024)
    assert tokens.count_tokens(no_documents, JSON).collect() == []


def _check_packing(rows, texts, lib, capacity):
    by_sequence: dict[int, list] = {}
    by_doc: dict = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    for doc_id, text in texts.items():
        ids = np.array([*lib.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for k, r in enumerate(sorted(by_doc[doc_id], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
        assert len(by_doc[doc_id]) == math.ceil(len(ids) / capacity)
    return len(by_sequence)


def test_packing(spark, lib):
    documents = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = packing.pack_documents(documents, JSON).collect()
    used = _check_packing(rows, {r.doc_id: r.text for r in documents.collect()}, lib, 2048)
    assert used <= math.ceil(sum(r.length for r in rows) / 2048) * 1.02 + 1


def test_packing_edge_rows(spark, clashing, no_documents, lib):
    rows = packing.pack_documents(clashing, JSON, shard_pieces=5).collect()
    capacity = 2048
    filled: dict[int, list] = {}
    for r in rows:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in filled.values():
        ends = [o + k for o, k in sorted(places)]
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= capacity
    for d in clashing.where("doc_id is not null").collect():
        n = len(lib.encode(d.text or "", add_special_tokens=False).ids) + 1
        copies = 2 if d.doc_id == 4 else 1
        assert sum(r.length for r in rows if r.doc_id == d.doc_id) == n * copies
    assert sum(r.doc_id == 4 for r in rows) == 2  # repeated rows are packed as often as they occur
    assert sum(r.doc_id is None for r in rows) == 1
    assert [(r.length, r.piece) for r in rows if r.doc_id in (1, 2)] == [(1, 0), (1, 0)]
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert packing.pack_documents(no_documents, JSON).collect() == []


def test_equal_rows_spread_over_all_shards(spark):
    rows = spark.range(4000).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit("one text of a few words").alias("text"))
    packed = packing.pack_documents(rows, JSON, shard_pieces=1000).collect()
    shards = [r.sequence_id >> 32 for r in packed]
    assert len(packed) == 4000 and len(set(shards)) == 4
    assert max(shards.count(k) for k in set(shards)) < 1200


def test_sum_of_squares_places_by_the_smallest_change():
    """Against a direct search over all open gaps."""
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 31, 400)
    capacity = 30
    sequence, _ = packing.sum_of_squares(lengths, capacity)
    gap_of: dict[int, int] = {}
    for s, which in zip(lengths.tolist(), sequence.tolist(), strict=True):
        counts = {g: sum(v == g for v in gap_of.values()) for g in range(1, capacity + 1)}

        def change(gap, new, s=s, counts=counts):
            after = dict(counts)
            if not new:
                after[gap] -= 1
            if gap - s:
                after[gap - s] = after.get(gap - s, 0) + 1
            return sum(v * v for v in after.values()) - sum(v * v for v in counts.values())

        options = {g: change(g, False) for g in counts if counts[g] and g >= s}
        least = min([*options.values(), change(capacity, True)])
        if which in gap_of:
            assert options[gap_of[which]] == least
            gap_of[which] -= s
        else:
            assert change(capacity, True) == least
            gap_of[which] = capacity - s
