from __future__ import annotations

import math

import numpy as np
import pytest

from meterlake.llm import negatives
from meterlake.llm.vectors import Exact

SCHEMA = "vec_id long, label int, embedding array<float>, score string, anchor string, row string"
LONG = 2**63 - 1


def brute(rows, positives=5, found=3, low=50, high=95):
    taken = []
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        taken.append((i, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for a, (i, label, q) in enumerate(taken):
        if i % 50:
            continue
        score = [min(max(sum(x * y for x, y in zip(q, w, strict=False)), -LONG - 1), LONG) for _, _, w in taken]
        mine = sorted((-score[b], taken[b][0]) for b in range(len(taken)) if b != a and taken[b][1] == label)[:positives]
        other = sorted((-score[b], taken[b][0]) for b in range(len(taken)) if taken[b][1] != label)
        for p, j in mine:
            fits = [(s, k) for s, k in other if low * -p <= 100 * -s <= high * -p][:found]
            out += [(i, j, r + 1, k, -p, -s) for r, (s, k) in enumerate(fits)]
    return sorted(out)


def _run(spark, rows, **how):
    df = spark.createDataFrame([(i, label, v, "taken", "taken", "taken") for i, label, v in rows], SCHEMA)
    return sorted(tuple(r) for r in negatives.hard_negatives(df, **how).collect())


def _clusters(seed, n=900, width=12, labels=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.4, (labels + 3, width))
    rows = []
    for i in range(n):
        label = int(rng.integers(labels))
        v = (centres[rng.integers(labels + 3)] + rng.normal(0, 0.15, width)) * rng.choice([0.2, 1.0, 1.0, 3.0])
        rows.append((i, label, [float(x) for x in v]))
    return rows


@pytest.mark.parametrize("blocks", [{}, {"anchor_block": 5, "bucket_rows": 60}, {"focus": 1, "bucket_rows": 200}, {"focus": 12, "bucket_rows": 30}])
def test_against_brute_force(spark, blocks):
    rows = _clusters(1)
    assert _run(spark, rows, **blocks) == brute(rows)


def test_ties_repeats_and_strange_rows(spark):
    rows = _clusters(2, 300)
    rows += [(1000 + i, i % 3, [0.5] * 12) for i in range(150)]  # one vector under many ids
    rows += [(50, 1, rows[50][2]), (100, 2, [0.25] * 12), (100, 2, [0.25] * 12), (-50, 0, [-0.5] * 12)]
    rows += [(150, 0, [0.0] * 12), (2000, 3, [0.0] * 12), (2050, 1, [0.75, -0.5]), (2100, 4, [])]
    rows += [(2150, None, [0.1] * 12), (2200, 1, None), (2250, 1, [None] * 12), (2300, 1, [float("nan")] * 12),
             (2350, 1, [float("inf")] * 12), (None, 1, [0.1] * 12)]
    want = brute(rows)
    assert _run(spark, rows, bucket_rows=64) == want
    assert _run(spark, rows) == want


def test_wide_components_are_exact_and_saturate(spark):
    rows = [(0, 0, [1e8, 3.0]), (1, 0, [1e8, 1.0]), (2, 0, [1e7, 2.0]), (3, 1, [8e7, 1.5]), (4, 1, [5e6, 0.25]), (5, 1, [6e7, -1.0]),
            (50, 1, [1e30, 1.0]), (51, 1, [2e30, -1.0]), (52, 0, [1e-11, 7.0]), (53, 1, [0.5, 0.5])]
    assert _run(spark, rows) == brute(rows)


def test_empty_and_single(spark):
    assert _run(spark, []) == []
    assert _run(spark, [(50, 1, [0.5])]) == []
    assert _run(spark, [(50, 1, [0.5]), (1, 1, [0.5]), (2, 0, [0.4])]) == [(50, 1, 1, 2, 128 * 128, 128 * 102)]


def test_no_candidate_is_lost_and_some_are_pruned():
    rng = np.random.default_rng(5)
    v = rng.normal(0, 40, (2000, 8))
    v = (v / np.linalg.norm(v, axis=1)[:, None] * 100).round()  # one length class
    q = v[3] * 1.5
    bucket = negatives.Bucket(v)
    score = v @ q
    for share in (0.999, 0.99, 0.9, 0.5, 0.0, -0.5):
        threshold = share * float(score.max())
        at = bucket.candidates(q, threshold)
        assert set(np.flatnonzero(score >= threshold)) <= set(at.tolist())
    assert len(bucket.candidates(q, 0.95 * float(score.max()))) < 100
    assert len(bucket.candidates(q, 1e9)) == 0
    assert bucket.pruned > 0


def test_window_in_whole_numbers():
    assert negatives.window(101, 50, 95) == (51, 95)
    assert negatives.window(0, 50, 95) == (0, 0)


def test_products_beyond_a_mantissa():
    left = np.array([[2.0**40, 1.0], [2.0**62, 2.0**62]])
    right = np.array([[2.0**20, 3.0], [2.0**62, -1.0]])
    assert Exact(left[:1], right[:1]).products([0], [0]).tolist() == [[2**60 + 3]]
    assert Exact(left, right).products([1], [0, 1]).tolist() == [[LONG, LONG]]
