"""Exact top-k inner-product search with three-phase uniform thresholds.

Scores are sums over ``PARTS`` blocks of dimensions, so each (vector block,
dimension block) holds a list of partial scores for every query.

1. Gather: every vector block lists, per dimension block, its k best partial
   scores, completes the scores of the vectors on these lists only, and gives
   the best of them. The k-th best over all blocks is a safe cutoff: k vectors
   reach it.
2. Collect: the cutoff goes back to every block. A vector whose score reaches
   the cutoff has a partial score of at least cutoff / PARTS in some dimension
   block, so only such entries are collected (for any sign of the scores).
3. Resolve: the collected entries' remaining partial scores are added, those
   below the cutoff go, and a block gives its k best.

Queries and vectors meet in cells (query block, vector block) of bounded size:
the stated query set is compared with all rows in blocks, and no task or
driver holds the queries or the vectors whole. The quantised rows are written
once and read from there. A vector that many ids share ties in every block,
where the k smallest ids are enough.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.graph import stored
from meterlake.llm.vectors import LONG, Exact, matrix, quantised, takes_part

PARTS = 4
SCALE = 64
QUERY_BLOCK = 1024
VECTOR_BLOCK = 4096
ROWS_AT_ONCE = 256  # queries of a cell compared at once


class Cell:
    """Partial scores of a block of queries with a block of vectors."""

    def __init__(self, queries: pa.Table, vectors: pa.Table):
        vectors = vectors.sort_by("id")
        self.query_row, self.query_id = (queries[c].to_numpy() for c in ("row", "id"))
        self.row, self.ids = (vectors[c].to_numpy() for c in ("row", "id"))
        q, v = matrix(queries["q"]), matrix(vectors["q"])
        width = max(q.shape[1], v.shape[1])
        q, v = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, v))
        exact = Exact(q, v)
        self.q, self.v = exact.left, exact.right
        # Narrower floats hold the sums exactly where these stay below their mantissa.
        if self.q.dtype == np.float64 and width * max(1.0, np.abs(q).max(initial=0)) * max(1.0, np.abs(v).max(initial=0)) < 2**24:
            self.q, self.v = self.q.astype(np.float32), self.v.astype(np.float32)
        self.cuts = [slice(s[0], s[-1] + 1) for s in np.array_split(np.arange(width), min(PARTS, width))]

    def pieces(self):
        for lo in range(0, len(self.q), ROWS_AT_ONCE):
            rows = np.arange(lo, min(len(self.q), lo + ROWS_AT_ONCE))
            yield rows, [self.q[rows, c] @ self.v[:, c].T for c in self.cuts]

    def completed(self, partial: list[np.ndarray], i: int, at: np.ndarray) -> np.ndarray:
        """Whole scores of a query's listed vectors, as 64-bit numbers."""
        total = sum(p[i, at] for p in partial)
        if total.dtype == object:
            return np.array([min(max(int(x), -LONG - 1), LONG) for x in total], np.int64)
        return total.astype(np.int64)

    def listed(self, partial: list[np.ndarray], k: int) -> np.ndarray:
        """Which vectors are among the k + 1 best of some part (one more than k, as
        the query's own row may be among them)."""
        out = np.zeros(partial[0].shape, bool)
        for p in partial:
            if p.shape[1] <= k + 1 or p.dtype == object:
                out[:] = True
            else:
                np.put_along_axis(out, np.argpartition(p, p.shape[1] - k - 1, axis=1)[:, -k - 1 :], True, axis=1)
        return out


def _best(at: np.ndarray, total: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best entries: score down (~x falls as x rises, at every 64-bit x), then id up (the vectors' order)."""
    if len(at) > k:
        least = np.partition(total, len(total) - k)[len(total) - k]
        over = np.flatnonzero(total >= least)
        return over[np.lexsort((at[over], ~total[over]))[:k]]
    return np.lexsort((at, ~total))


def _search(k: int, with_cutoff: bool, completed: Accumulator | None) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Phase 1 of a cell, or with the cutoffs phases 2 and 3."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query": [], "query_id": [], "id": [], "score": []}
        if len(left) and len(right):
            cell = Cell(left, right)
            cutoffs = left["cutoff"].to_pylist() if with_cutoff else None
            for rows, partial in cell.pieces():
                if with_cutoff:
                    # -LONG - 1 stands for every score below it as well.
                    least = np.array([-math.inf if cutoffs[r] is None or cutoffs[r] < -LONG else cutoffs[r] for r in rows])
                    most = partial[0]
                    for p in partial[1:]:
                        most = np.maximum(most, p)
                    # Rounding of a wide cutoff must not lose an entry at it.
                    near = (len(partial) * most >= (least - np.abs(np.where(np.isinf(least), 0, least)) * 1e-6)[:, None]).astype(bool)
                else:
                    near = cell.listed(partial, k)
                for i, row in enumerate(rows.tolist()):
                    at = np.flatnonzero(near[i])
                    at = at[cell.row[at] != cell.query_row[row]]
                    total = cell.completed(partial, i, at)
                    if completed is not None:
                        completed.add(len(at))
                    if with_cutoff and cutoffs[row] is not None:
                        over = total >= cutoffs[row]
                        at, total = at[over], total[over]
                    best = _best(at, total, k)
                    n = len(best)
                    for name, part in (("query", np.full(n, cell.query_row[row])), ("query_id", np.full(n, cell.query_id[row])),
                                       ("id", cell.ids[at[best]]), ("score", total[best])):
                        out[name].append(part)
        return pa.table({name: pa.array(np.concatenate([np.zeros(0, np.int64), *parts]), pa.int64()) for name, parts in out.items()})

    return work


def top_k(df: DataFrame, k: int = 20, *, id_col: str = "vec_id", vector_col: str = "embedding", query_every: int = 20,
          query_block: int = QUERY_BLOCK, vector_block: int = VECTOR_BLOCK, completed: Accumulator | None = None) -> DataFrame:
    """The k best other rows by integer inner product for every query row.

    Components become floor(64 * x). Queries are the rows whose id is divisible
    by ``query_every``; returns query_id, rank (from 1), vec_id, score; ties go
    to the smaller vec_id. ``completed`` (an accumulator) counts the scores that
    were added up whole.

    Defined cases: rows with a null id, a null vector, or a null or non-finite
    component take no part; rows that repeat an id all count, as queries (each
    with its own ranks) and as candidates of each other; shorter vectors are
    padded with zeros; a score beyond 64 bits counts as the nearest 64-bit
    number; fewer than k candidates give all of them; other columns are
    ignored; an empty table gives no rows.
    """
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & takes_part(F.col("v")))
    vectors = stored(rows.select(F.monotonically_increasing_id().alias("row"), "id", quantised(F.col("v"), SCALE).alias("q")), "vectors")
    is_query = F.col("id") % query_every == 0
    n, n_queries = vectors.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    across, down = max(1, math.ceil(n / vector_block)), max(1, math.ceil(n_queries / query_block))
    number = lambda last: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(last - 1).cast("bigint")))
    block = lambda of: F.pmod(F.xxhash64("row"), F.lit(of))
    vector_cells = vectors.withColumn("vb", block(across)).withColumn("qb", number(down)).groupBy("qb", "vb")
    queries = vectors.where(is_query).select(*[F.col(c).alias(c) for c in vectors.columns])

    def visit(asked: DataFrame, with_cutoff: bool) -> DataFrame:
        cells = asked.withColumn("qb", block(down)).withColumn("vb", number(across)).groupBy("qb", "vb")
        return cells.cogroup(vector_cells).applyInArrow(_search(k, with_cutoff, completed), "query bigint, query_id bigint, id bigint, score bigint")

    by_score = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    listed = visit(queries, False).withColumn("r", F.row_number().over(by_score)).where(F.col("r") <= k)
    cutoffs = listed.groupBy("query").agg(F.when(F.count("*") >= k, F.min("score")).alias("cutoff"))
    asked = queries.join(cutoffs.withColumnRenamed("query", "row"), "row", "left")
    return (
        visit(asked, True).withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
    )


TOP_K_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r
  WHERE a.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
FROM s
WINDOW w AS (PARTITION BY r ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 20
"""
