from __future__ import annotations

import math

import numpy as np
import pytest

from meterlake.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string"


LONG = 2**63 - 1


def brute(rows, k):
    taken = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        taken.append((i, [math.floor(64 * float(np.float32(x))) for x in v]))
    out = []
    for a, (i, q) in enumerate(taken):
        if i % 20:
            continue
        score = lambda w, q=q: min(max(sum(x * y for x, y in zip(q, w, strict=False)), -LONG - 1), LONG)
        best = sorted((-score(w), j) for b, (j, w) in enumerate(taken) if b != a)[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def _run(spark, rows, k, **blocks):
    df = spark.createDataFrame([(i, v, "taken") for i, v in rows], SCHEMA)
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(df, k, **blocks).collect())


@pytest.mark.parametrize("blocks", [{}, {"query_block": 3, "vector_block": 40}])
def test_against_brute_force(spark, blocks):
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.2, 8)]) for i in range(300)]
    rows += [(1000 + i, [0.5] * 8) for i in range(200)]  # one vector under many ids: ties
    rows += [(2000, None), (2020, [None] * 8), (2040, [float("nan")] + [0.1] * 7), (2060, [float("inf")] * 8), (None, [0.1] * 8)]
    rows += [(40, [0.9] * 8), (60, rows[60][1]), (60, rows[60][1]), (3000, [0.25, -0.5]), (-20, [-0.5] * 8)]
    assert _run(spark, rows, 20, **blocks) == brute(rows, 20)


def test_fewer_candidates_than_k(spark):
    rows = [(0, [0.1, 0.2]), (1, [0.3, 0.1]), (20, [-0.4, 0.9])]
    assert _run(spark, rows, 20) == brute(rows, 20)


def test_only_negative_scores(spark):
    rows = [(0, [1.0, 1.0])] + [(i, [-0.1 * i, -0.3]) for i in range(1, 60)]
    assert _run(spark, rows, 5, vector_block=10) == brute(rows, 5)


def test_repeated_ids_are_rows_of_their_own(spark):
    """Rows that share an id are candidates of each other and of every query."""
    rows = [(20, [2.0]), (1, [0.5]), (1, [2.0]), (2, [1.0]), (20, [1.0]), (20, [1.0]), (40, [-1.0])]
    assert _run(spark, rows, 20) == brute(rows, 20)
    assert (20, 1, 1, 128 * 128) in _run(spark, rows, 3)


def test_wide_components_are_not_clipped(spark):
    rows = [(20, [64.0]), (1, [1e8]), (2, [4e7])]
    assert [r[3] for r in _run(spark, rows, 2)] == [64 * 64 * 64 * 10**8, 64 * 64 * 64 * 4 * 10**7] == [r[3] for r in brute(rows, 2)]
    rows = [(0, [1e30, 1.0]), (1, [1e30, -1e30]), (2, [0.0, 1.0]), (3, [1e9, 3e8]), (20, [-1e30, 5.0]), (4, [2e9, 1e-3])]
    assert _run(spark, rows, 4) == brute(rows, 4)
    assert _run(spark, rows, 4, query_block=1, vector_block=2) == brute(rows, 4)


def test_empty_tables(spark):
    assert _run(spark, [], 20) == []
    assert _run(spark, [(1, [0.5])], 20) == []


def test_fewer_scores_than_pairs_are_completed(spark):
    rng = np.random.default_rng(7)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.2, 32)]) for i in range(2000)]
    completed = spark.sparkContext.accumulator(0)
    assert _run(spark, rows, 5, completed=completed) == brute(rows, 5)
    assert 0 < completed.value < 100 * 1999 // 2
