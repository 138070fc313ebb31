from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.llm import queries, runs
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w, least=12):
    """Every maximal stretch per period, by comparing words that lie the period apart."""
    n, out = len(w), []
    for q in range(1, n // 2 + 1):
        start = None
        for i in range(n - q + 1):
            if i < n - q and w[i] == w[i + q]:
                start = i if start is None else start
                continue
            if start is not None and i + q - start >= max(least, 2 * q):
                out.append((start, i + q - start, q))
            start = None

    def has_period(s, length, d):
        return all(w[x] == w[x + d] for x in range(s, s + length - d))

    smallest = [r for r in out if not any(has_period(r[0], r[1], d) for d in range(1, r[2]))]
    return sorted(smallest, key=lambda r: (r[0], r[2]))


def periodic(doc_id, words):
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def brute(doc_id, text, move=True):
    words = WORD.findall(text or "")
    words = periodic(doc_id, words) if move else words
    found = brute_runs(words)
    gone = {i for s, length, p in found for i in range(s + p, s + length)}
    listed = "".join(f"{s},{length},{p}\n" for s, length, p in found)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    top = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *top, sha(listed), sha(" ".join(x for i, x in enumerate(words) if i not in gone)))


def _digests(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", range(8))
def test_runs_against_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(60):
        n, k = rng.randrange(0, 70), rng.choice([1, 2, 2, 3, 6])
        w = [rng.randrange(k) for _ in range(n)]
        if n and rng.random() < 0.5:
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randint(2, 6)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
        least = rng.choice([2, 4, 7, 12])
        assert runs.runs_of(np.array(w, np.int64), least) == brute_runs(w, least)


def test_kept_words_drop_all_but_the_first_period():
    assert runs.kept_words(6, [(1, 4, 1)]).tolist() == [0, 1, 5]
    assert runs.kept_words(0, []).tolist() == []


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in rows if len((r.text or "").split()) < 1500]
    assert len(short) > 150
    got = _digests(queries.op13_periodic_runs(spark, SF_SMALL).where(F.col("doc_id").isin([r.doc_id for r in short])))
    assert got == sorted((brute(r.doc_id, r.text) for r in short), key=str)
    assert any(r[1] for r in got) and any(not r[1] for r in got)


def test_overlapping_runs_and_texts_side_by_side(spark):
    texts = ["a b " * 20 + "c " + "b c " * 9, "x " * 11, "x " * 12, "a a b a a b a a b a a b a a b a a a a a a a a a a a a a",
             "Aa aA " * 8, "é è " * 7 + "  é", "one\ttwo\nthree one\r\ntwo\x0bthree " * 5, "x " * 12]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    found = runs.run_digests(runs.find_runs(df))
    assert _digests(found) == sorted((brute(i, t, move=False) for i, t in enumerate(texts)), key=str)


def test_strange_rows(spark, edge_documents, clashing, no_documents):
    ask = lambda df: _digests(runs.run_digests(runs.find_runs(df, rearrange=runs.periodic_tail)))
    small = edge_documents.where("doc_id is null or doc_id <> 10")
    rows = small.select("doc_id", "text").collect()
    assert ask(small) == sorted((brute(r.doc_id, r.text) for r in rows), key=str)
    assert ask(clashing) == ask(edge_documents)
    assert ask(no_documents) == []
    empty = [r for r in ask(edge_documents) if r[0] == 1][0]
    assert empty[1:6] == (0, None, None, None, None) and empty[6] == empty[7] == hashlib.sha256(b"").hexdigest()


def test_a_long_periodic_text(spark):
    period = [f"w{i}" for i in range(3000)]
    words = ["start"] * 1 + period * 20 + ["end"]
    df = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    row = runs.find_runs(df).first()
    assert (row.starts, row.lengths, row.periods) == ([1], [60_000], [3000])
    assert row.collapsed == " ".join(["start", *period, "end"]) and row.n_words == 60_002
