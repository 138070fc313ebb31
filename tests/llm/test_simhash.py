from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from meterlake.llm import queries, simhash
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def print_of(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """(doc_id, fingerprint, component): all pairs of rows; rows of one id belong together."""
    prints = [print_of(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            same = rows[i][0] is not None and rows[i][0] == rows[j][0]
            if same or (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(((d, f"{p:016x}", least.get(find(i))) for i, ((d, _), p) in enumerate(zip(rows, prints, strict=True))), key=str)


def _run(df):
    return sorted((tuple(r) for r in simhash.near_duplicates(df).collect()), key=str)


def test_hashes_are_those_of_the_library():
    rng = random.Random(1)
    parts = [bytes(rng.randrange(256) for _ in range(n)) for n in [*range(80), 200, 1000]]
    data = np.frombuffer(b"".join(parts) + bytes(16), np.uint8)
    lengths = np.array([len(p) for p in parts])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    for seed in (0, 42):
        assert simhash.xxh64_slices(data, starts, lengths, seed).tolist() == [xxhash.xxh64_intdigest(p, seed) for p in parts]


def test_majority_of_very_many_hashes():
    rng = np.random.default_rng(2)
    hashes = rng.integers(0, 1 << 63, 150_000, dtype=np.uint64) | np.uint64(1 << 62)
    offsets = np.array([0, 0, 100_000, 100_003, 150_000])
    want = [sum(1 << b for b in range(64) if 2 * int(((part >> np.uint64(b)) & np.uint64(1)).sum()) > len(part))
            for part in (hashes[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True))]
    assert simhash.majority_bits(hashes, offsets).tolist() == want


@pytest.mark.parametrize("long_list", [1, 256])
def test_lists_give_all_close_pairs(spark, monkeypatch, long_list):
    """Links of the index connect what all pairs connect, for short and long lists."""
    monkeypatch.setattr(simhash, "LONG_LIST", long_list)
    rng = random.Random(3)
    prints = {rng.getrandbits(64) for _ in range(100)}
    for base in list(prints)[:20]:
        for _ in range(12):
            x = base
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    dense = rng.getrandbits(64)
    prints |= {dense ^ (i & 0x55) << 8 ^ (i >> 3 & 0x3F) << 56 for i in range(500)}
    values = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in values]
    df = spark.createDataFrame([(s,) for s in signed], "fp long").repartition(3)
    got = {(r.a, r.b) for r in simhash._links(df).collect()}
    assert got and all((a != b) for a, b in got)

    def classes(pairs):
        parent = {s: s for s in signed}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in pairs:
            parent[find(a)] = find(b)
        groups = {}
        for s in signed:
            groups.setdefault(find(s), set()).add(s)
        return sorted(map(sorted, groups.values()))

    close = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2]
    assert classes(got) == classes(close)


def test_tally_counts_shared_places():
    x = np.array([0, 1, 0x8000000000000000, 0x0101010101010101, 0x00FF00FF00FF00FF], np.uint64)
    assert simhash.tally(x).tolist() == [8, 7, 7, 0, 4]


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in queries.op11_simhash_near_dedup(spark, SF_SMALL).collect()), key=str)
    assert got == brute(rows)
    assert any(d != c for d, _, c in got)


def _families(seed):
    rng = random.Random(seed)
    word = lambda: f"{rng.choice('abcdefgh')}{rng.randrange(300)}"
    rows = []
    for size in (1, 2, 3, 4, 40, 200, 200, 600):
        base = [word() for _ in range(size)]
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(size)] = word()
            rows.append((len(rows), " ".join(copy)))
    rows += [(1000 + i, rows[70][1].upper()) for i in range(60)]
    rng.shuffle(rows)
    return rows


def test_families_of_near_copies(spark):
    rows = _families(4)
    assert _run(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)) == brute(rows)


def test_null_ids_and_repeated_ids_link_others(spark):
    rows = _families(5)
    rng = random.Random(6)
    rows = [(None if rng.random() < 0.3 else d // 3 if rng.random() < 0.2 else d, t) for d, t in rows]
    assert _run(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_strange_rows(spark, edge_documents, clashing, no_documents):
    rows = [(r.doc_id, r.text) for r in edge_documents.collect()]
    assert _run(edge_documents) == brute(rows) == _run(clashing)
    assert {r[1] for r in _run(edge_documents) if r[0] in (1, 2, 3)} == {"0" * 16}
    assert _run(no_documents) == []
