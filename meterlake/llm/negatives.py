"""Hard-negative mining by LEMP-style coordinate pruning.

Vectors lie in buckets of similar length, the longest first. A bucket that
cannot reach an anchor's threshold by its longest vector is not visited. In a
visited bucket the threshold becomes a least cosine t, and for every focus
coordinate f of the anchor (its largest ones) a vector that reaches t has

    q_f t - sqrt((1 - q_f^2)(1 - t^2))  <=  p_f  <=  q_f t + sqrt((1 - q_f^2)(1 - t^2))

(unit vectors q, p; a side is open where q_f itself reaches t). The bucket's
coordinate lists are sorted, so each range is a stretch of a list; vectors in
all stretches are the candidates, and their exact integer scores decide. The
ranges have a margin for rounding, so they lose nothing.

There are two searches: an anchor's best rows of its label (the positives),
then for each positive the best rows of other labels in its score window. Both
begin with the bucket of the longest vectors; the k-th best there is a safe
threshold for the others. Anchors meet buckets in cells of bounded size:
the stated query set against all rows, in blocks. Nothing but the number of
rows in each of a few hundred length classes reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.graph import stored
from meterlake.llm.vectors import Exact, matrix, quantised, takes_part

SCALE = 256
FOCUS = 8  # coordinates of an anchor whose ranges are intersected
ANCHOR_BLOCK = 1024
BUCKET_ROWS = 4096
LENGTH_RATIO = 1.1  # of the longest to the shortest vector of a length class
CLASSES = 700  # lengths from 1.1**-350 to 1.1**350; what lies beyond is in the last class
MARGIN = 1e-9


# --- one bucket ------------------------------------------------------------------------


def feasible(q: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray]:
    """Range of a unit vector's coordinates if its cosine with a unit vector is
    at least t, for the coordinates q of that one."""
    spread = np.sqrt(np.maximum(0.0, 1 - q * q) * max(0.0, 1 - t * t))
    low = np.where(-q >= t, -1.0, q * t - spread)
    high = np.where(q >= t, 1.0, q * t + spread)
    return low - MARGIN, high + MARGIN


class Bucket:
    """Vectors of similar length with sorted coordinate lists."""

    def __init__(self, vectors: np.ndarray):
        with np.errstate(over="ignore", invalid="ignore"):
            self.lengths = np.sqrt((vectors * vectors).sum(axis=1))
            self.unit = vectors / np.where(self.lengths > 0, self.lengths, 1.0)[:, None]
        self.safe = bool(np.isfinite(self.lengths).all())  # longer ones than a double can square are never pruned
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.pruned = 0

    def list_of(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.lists[f] = order, self.unit[order, f]
        return self.lists[f]

    def candidates(self, q: np.ndarray, threshold: float, focus: int = FOCUS) -> np.ndarray:
        """Rows among which are all whose inner product with q reaches the threshold."""
        everything = np.arange(len(self.lengths))
        if not len(everything) or threshold == -math.inf or not self.safe:
            return everything
        with np.errstate(over="ignore"):
            length = math.sqrt(float(q @ q))
        if not math.isfinite(length):
            return everything
        # The least cosine is where the vectors are longest, for a negative threshold where they are shortest.
        reach = length * float(self.lengths.max() if threshold > 0 else self.lengths.min())
        if reach == 0:
            return everything if threshold <= 0 else everything[:0]
        t = threshold / reach
        t -= MARGIN * max(1.0, abs(t))
        if t > 1:
            self.pruned += len(everything)
            return everything[:0]
        if t <= -1:
            return everything
        unit = q / length
        chosen = np.argsort(-np.abs(unit), kind="stable")[:focus]
        lows, highs = feasible(unit[chosen], t)
        met, needed = np.zeros(len(everything), np.int16), 0
        for f, low, high in zip(chosen.tolist(), lows.tolist(), highs.tolist(), strict=True):
            order, values = self.list_of(f)
            a, b = np.searchsorted(values, low, side="left"), np.searchsorted(values, high, side="right")
            if b - a < len(values):
                met[order[a:b]] += 1
                needed += 1
        found = np.flatnonzero(met == needed)
        self.pruned += len(everything) - len(found)
        return found


def _first(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: score down (~x falls as x rises, at every 64-bit x), then id up."""
    return np.lexsort((ids, ~score))[:k]


# --- cells -----------------------------------------------------------------------------


class Cells:
    """Vectors dealt to buckets by length class, and anchors to blocks that visit them."""

    def __init__(self, rows: DataFrame, is_anchor: Column, anchor_block: int, bucket_rows: int):
        counted = rows.groupBy("cls").agg(F.count("*").alias("n"), F.count(F.when(is_anchor, 1)).alias("anchors")).collect()
        self.blocks = max(1, math.ceil(sum(r["anchors"] for r in counted) / anchor_block))
        first, classes = 0, []
        for r in sorted(counted, key=lambda r: -r["cls"]):
            n = max(1, math.ceil(r["n"] / bucket_rows))
            classes.append((r["cls"], first, n))
            first += n
        self.classes = classes or [(0, 0, 1)]
        table = F.create_map(*[F.lit(x) for c, lo, n in self.classes for x in (c, (lo << 32) + n)])
        spot = F.element_at(table.cast("map<int,bigint>"), F.col("cls"))
        dealt = F.shiftright(spot, 32) + F.pmod(F.xxhash64("row"), spot.bitwiseAND(0xFFFFFFFF))
        self.vectors = rows.select(dealt.alias("bucket"), "row", "id", "label", "q")

    def visit(self, anchors: DataFrame, buckets: str, work: Callable, schema: str) -> DataFrame:
        """``work`` on every cell of an anchor block and a bucket: of the longest
        vectors (``first``) or those that the anchors' thresholds reach (``rest``)."""
        vectors = self.vectors.where("bucket = 0") if buckets == "first" else self.vectors.where("bucket > 0")
        if buckets == "first":
            to = F.array(F.lit(0).cast("bigint"))
        else:
            length, least = F.col("length"), F.col("least")
            open_ = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(lo).cast("bigint").alias("lo"), F.lit(lo + n - 1).cast("bigint").alias("hi"))
                              for c, lo, n in self.classes])
            # A class's vectors are at most LENGTH_RATIO ** class long; the last class has no bound.
            reached = F.filter(open_, lambda x: least.isNull() | (least <= 0) | (x["c"] >= CLASSES // 2)
                               | (length * F.pow(F.lit(LENGTH_RATIO), x["c"].cast("double")) * (1 + 1e-6) >= least))
            visited = F.flatten(F.transform(reached, lambda x: F.sequence(x["lo"], x["hi"])))
            to = F.filter(visited, lambda b: b > 0)
        block = F.pmod(F.xxhash64("row"), F.lit(self.blocks))
        # Columns of their own: anchors are rows of the same table as the vectors.
        own = anchors.select(*[F.col(c).alias(c) for c in anchors.columns])
        left = own.withColumn("block", block).withColumn("bucket", F.explode(to)).groupBy("block", "bucket")
        every = F.sequence(F.lit(0).cast("bigint"), F.lit(self.blocks - 1).cast("bigint"))
        right = vectors.withColumn("block", F.explode(every)).groupBy("block", "bucket")
        return left.cogroup(right).applyInArrow(work, schema)


def _length_class(q: Column) -> Column:
    """Number of the length's class; a class's vectors are at most LENGTH_RATIO ** number long."""
    squared = F.aggregate(q, F.lit(0.0), lambda total, x: total + x * x)
    number = F.ceil(F.log(squared) / (2 * math.log(LENGTH_RATIO)) + 1e-9)
    half = CLASSES // 2
    return F.when(squared <= 0, -half).when(squared < float("inf"), F.greatest(F.least(number, F.lit(half)), F.lit(1 - half))).otherwise(half).cast("int")


def _vector_rows(df: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("string").alias("label"),
                     F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & takes_part(F.col("v")))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "id", "label", quantised(F.col("v"), scale).alias("q"))
    return rows.withColumn("cls", _length_class(F.col("q"))).withColumn("length", F.sqrt(F.aggregate("q", F.lit(0.0), lambda t, x: t + x * x)))


class _Cell:
    """One cell's rows as arrays."""

    def __init__(self, left: pa.Table, right: pa.Table):
        anchors, vectors = matrix(left["q"]), matrix(right["q"])
        width = max(anchors.shape[1], vectors.shape[1])
        self.q, self.v = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (anchors, vectors))
        self.row, self.ids = right["row"].to_numpy(), right["id"].to_numpy()
        self.label = np.array(right["label"].to_pylist(), object)
        self.exact, self.bucket = Exact(self.q, self.v), Bucket(self.v)

    def reaching(self, i: int, threshold: float, focus: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and exact scores of the vectors that reach the threshold."""
        at = self.bucket.candidates(self.q[i], threshold, focus)
        score = self.exact.products(slice(i, i + 1), at)[0] if len(at) else np.zeros(0, np.int64)
        over = score >= threshold
        return at[over], score[over]


def _table(columns: dict[str, list]) -> pa.Table:
    return pa.table({name: pa.array(np.concatenate([np.zeros(0, np.int64), *parts]), pa.int64()) for name, parts in columns.items()})


def _positives_of(k: int, focus: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"anchor": [], "row": [], "id": [], "score": []}
        if len(left) and len(right):
            cell = _Cell(left, right)
            rows = zip(left["row"].to_pylist(), left["label"].to_pylist(), left["least"].to_pylist(), strict=True)
            for i, (row, label, least) in enumerate(rows):
                at, score = cell.reaching(i, -math.inf if least is None else least, focus)
                mine = (cell.label[at] == label) & (cell.row[at] != row)
                at, score = at[mine], score[mine]
                best = _first(score, cell.ids[at], k)
                for name, part in (("anchor", np.full(len(best), row)), ("row", cell.row[at[best]]), ("id", cell.ids[at[best]]), ("score", score[best])):
                    out[name].append(part)
        return _table(out)

    return work


def _negatives_of(k: int, focus: int, low: int, high: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"anchor": [], "place": [], "id": [], "score": []}
        if len(left) and len(right):
            cell = _Cell(left, right)
            rows = zip(left["row"].to_pylist(), left["label"].to_pylist(), left["least"].to_pylist(), left["wanted"].to_pylist(), strict=True)
            for i, (row, label, least, wanted) in enumerate(rows):
                at, score = cell.reaching(i, float(least), focus)
                other = cell.label[at] != label
                at, score = at[other], score[other]
                for w in wanted:
                    floor, top = window(w["score"], low, high)
                    fits = (score >= max(floor, w["cut"])) & (score <= top)
                    best = _first(score[fits], cell.ids[at[fits]], k)
                    found = at[fits][best]
                    for name, part in (("anchor", np.full(len(best), row)), ("place", np.full(len(best), w["place"])),
                                       ("id", cell.ids[found]), ("score", score[fits][best])):
                        out[name].append(part)
        return _table(out)

    return work


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """The least and the greatest n with low * score <= 100 * n <= high * score."""
    return -(-low * score // 100), high * score // 100


def hard_negatives(
    df: DataFrame, *, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", scale: int = SCALE,
    anchor_every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, focus: int = FOCUS,
    anchor_block: int = ANCHOR_BLOCK, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Hard negatives of every anchor and each of its positives.

    Components become floor(scale * x); a score is the integer inner product
    with the anchor, higher first, ties to the smaller id. Anchors are the rows
    whose id is divisible by ``anchor_every``; an anchor's positives are its
    first other rows of the same label; a positive's negatives are the first
    rows of other labels with low * positive <= 100 * negative <= high * positive.
    Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score
    and negative_score; pairs without such a row give none.

    Defined cases: rows with a null id, label or vector, or a null or
    non-finite component, take no part; every row counts, also when it repeats
    an id or a vector (an anchor's other rows may have its id); shorter vectors
    are padded with zeros; a positive of score 0 allows negatives of score 0,
    one below 0 none; a score beyond 64 bits counts as the nearest 64-bit
    number; other columns are ignored; an empty table gives no rows.
    """
    rows = stored(_vector_rows(df, id_col, label_col, vector_col, scale), "vectors")
    is_anchor = F.col("id") % anchor_every == 0
    cells = Cells(rows, is_anchor, anchor_block, bucket_rows)
    anchors = rows.where(is_anchor).select("row", F.col("id").alias("anchor_id"), "label", "q", "length")

    by_score = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id", "row")
    find = _positives_of(positives, focus)
    kinds = "anchor bigint, row bigint, id bigint, score bigint"
    ranked = lambda found, by, k: found.withColumn("place", F.row_number().over(by)).where(F.col("place") <= k)

    seeds = stored(ranked(cells.visit(anchors.withColumn("least", F.lit(None).cast("double")), "first", find, kinds), by_score, positives), "seeds")
    # Any of an anchor's best rows scores at least as much as the last of a full list.
    enough = seeds.where(F.col("place") == positives).select(F.col("anchor").alias("row"), F.col("score").cast("double").alias("least"))
    rest = cells.visit(anchors.join(enough, "row", "left"), "rest", find, kinds)
    best = stored(ranked(seeds.drop("place").unionByName(rest), by_score, positives), "positives")

    wanted = best.where("score >= 0").withColumn("cut", F.expr(f"cast(ceil({low} * cast(score as decimal(20,0)) / 100) as bigint)"))
    known = anchors.withColumnRenamed("row", "anchor")

    def with_windows(pairs: DataFrame) -> DataFrame:
        per_anchor = pairs.groupBy("anchor").agg(
            F.min("cut").cast("double").alias("least"), F.collect_list(F.struct("place", "score", "cut")).alias("wanted"))
        return known.join(per_anchor, "anchor").withColumnRenamed("anchor", "row")

    find = _negatives_of(negatives, focus, low, high)
    kinds = "anchor bigint, place bigint, id bigint, score bigint"
    by_pair = Window.partitionBy("anchor", "place").orderBy(F.col("score").desc(), "id")
    rank = lambda found: found.withColumn("rank", F.row_number().over(by_pair)).where(F.col("rank") <= negatives)
    seeds = stored(rank(cells.visit(with_windows(wanted), "first", find, kinds)), "negative_seeds")
    full = seeds.where(F.col("rank") == negatives).select("anchor", "place", F.col("score").alias("reached"))
    raised = wanted.join(full, ["anchor", "place"], "left").withColumn("cut", F.greatest("cut", F.coalesce("reached", "cut")))
    rest = cells.visit(with_windows(raised), "rest", find, kinds)
    found = rank(seeds.drop("rank").unionByName(rest))

    named = best.select("anchor", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        found.join(named, ["anchor", "place"]).join(known.select("anchor", "anchor_id"), "anchor")
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                "positive_score", F.col("score").alias("negative_score"))
    )


HARD_NEGATIVES_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r
  WHERE a.vec_id % 50 = 0
), p AS (
  SELECT ar, anchor_id, br, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, id, br) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.id AS negative_id,
       positive_score, s.score AS negative_score
FROM p JOIN s ON p.ar = s.ar AND NOT s.same
  AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.ar, p.br ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER w <= 3
"""
