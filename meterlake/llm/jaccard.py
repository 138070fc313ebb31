"""N-gram Jaccard join: a size-aware heavy-light join with exact verification.

Documents are sets of word shingles. Equal sets are one class; the smallest
doc_id of a class stands for it, and only classes are joined.

* Light sets (size up to a boundary): two sets of sizes a and b are similar
  exactly if they share c(a, b) shingles, so each light set lists all its
  subsets of that size for every partner size. Sets that list the same subset
  are linked without looking at anything else.
* Heavy sets: shingles are ordered from rare to frequent, and a set is posted
  in the inverted lists of its first shingles, of which similar sets share at
  least one. Lists are scanned in two rounds. First each set is compared with
  one set that it meets most often as the smallest of a list, which joins
  large groups of near copies by as many comparisons as members. Then only
  sets that meet in a list but are not connected yet are counted: a pair is
  verified if it could still be similar by its sizes, the places in both
  sets' orders, and the number of lists it shares.
* The boundary is the size at which the subsets of the light sets, counted
  over the table's own sizes, cost as much as posting them would.

The order comes from a sketch of all documents' shingles (fixed size, see
``SKETCH_BITS``); it decides costs only. Nothing is sampled or cut off.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.graph import components, stored
from meterlake.llm.shingles import SIZE, shingle_sets
from meterlake.llm.text import mix64, ragged, text_chunks
from meterlake.operators.joins import skew_safe_join

SIMILARITY = 75  # percent
SKETCH_BITS = 20  # 2**20 counters of 32 bits: 4 MB per task and on each executor
SKETCH_PARTS = 64
LIGHT_MOST = 16  # the boundary is at most this size
POSTING_COST = 4.0  # of a posting and its share of scanning, in subsets listed
LIST_ROWS = 4096  # a list expected to be longer is scanned in parts of about this size
FILTER_BITS = 26  # of the id filter, at most

_LOW56 = np.uint64((1 << 56) - 1)


def needed_overlap(a: int, b: int, percent: int = SIMILARITY) -> int:
    return -(-percent * (a + b) // (100 + percent))


def prefix_size(n: int, percent: int = SIMILARITY) -> int:
    return n - -(-percent * n // 100) + 1


def _overlap(a: Column, b: Column, percent: int) -> Column:
    return F.floor((F.lit(percent) * (a + b) + (99 + percent)) / (100 + percent))


def _prefix(n: Column, percent: int) -> Column:
    return n - F.floor((F.lit(percent) * n + 99) / 100) + 1


def partner_sizes(n: int, percent: int = SIMILARITY) -> range:
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def subsets_listed(n: int, boundary: int, percent: int = SIMILARITY) -> int:
    return sum(comb(n, needed_overlap(n, b, percent)) for b in partner_sizes(n, percent) if b <= boundary)


def boundary_by_cost(sizes: dict[int, int], percent: int = SIMILARITY) -> int:
    """The boundary with the least cost for the number of classes by size."""

    def cost(boundary: int) -> float:
        light = sum(k * subsets_listed(n, boundary, percent) for n, k in sizes.items() if n <= boundary)
        posted = sum(k * prefix_size(n, percent) for n, k in sizes.items() if n >= least_posted(boundary, percent))
        return light + POSTING_COST * posted

    return min(range(LIGHT_MOST + 1), key=lambda b: (cost(b), b))


def least_posted(boundary: int, percent: int = SIMILARITY) -> int:
    """Smallest size that may link with a set beyond the boundary."""
    return -(-percent * (boundary + 1) // 100)


# --- passes over the texts -----------------------------------------------------------


_SETS = "doc_id bigint, n int, d1 bigint, d2 bigint, small array<bigint>, part int, counts binary"


def _digests(hashed: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over each set that do not depend on order: equal sets, equal digests."""
    out = []
    for salt in (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(hashed ^ salt), dtype=np.uint64)])
        out.append((total[offsets[1:]] - total[offsets[:-1]]).view(np.int64))
    return out[0], out[1]


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))


def _sets_and_sketch(rows: DataFrame, size: int, bits: int) -> DataFrame:
    """Per document its set's size, digests and (if small) hashes; and, per task,
    the counts of all shingles by the top bits of their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << bits, np.uint32)
        schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("d1", pa.int64()), ("d2", pa.int64()),
                            ("small", pa.list_(pa.int64())), ("part", pa.int32()), ("counts", pa.binary())])
        for part, texts in text_chunks(batches, 1):
            hashed, offsets = shingle_sets(texts, size)
            counters += np.bincount((hashed >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits).astype(np.uint32)
            n = np.diff(offsets)
            d1, d2 = _digests(hashed, offsets)
            kept = np.where(n <= LIGHT_MOST, n, 0)
            none = pa.nulls(len(n))
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(n, pa.int32()), pa.array(d1), pa.array(d2),
                _lists(hashed[ragged(offsets[:-1], kept)], np.concatenate([[0], np.cumsum(kept)])),
                none.cast(pa.int32()), none.cast(pa.binary()),
            ], schema=schema)
        blobs = [x.tobytes() for x in np.split(counters, SKETCH_PARTS)]
        none = pa.nulls(SKETCH_PARTS)
        yield pa.RecordBatch.from_arrays([
            none.cast(pa.int64()), none.cast(pa.int32()), none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.list_(pa.int64())),
            pa.array(range(SKETCH_PARTS), pa.int32()), pa.array(blobs, pa.binary()),
        ], schema=schema)

    return rows.mapInArrow(run, _SETS)


def _frequency_classes(found: DataFrame, bits: int) -> np.ndarray:
    """Binary logarithm of each counter's excess over the mean; 4 MB reach the driver."""

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((1 << bits) // SKETCH_PARTS, np.uint64)
        for blob in group["counts"]:
            total += np.frombuffer(blob, np.uint32)
        return pd.DataFrame({"part": [group["part"].iloc[0]], "counts": [total.tobytes()]})

    def halves(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((1 << bits) // SKETCH_PARTS, np.uint64)
        for blob in group["counts"]:
            total += np.frombuffer(blob, np.uint64)
        return pd.DataFrame({"part": [group["part"].iloc[0]], "counts": [total.tobytes()]})

    # Counts of many tasks are added in two steps of about the square root of their
    # number, so that none gets them all.
    counts = found.where(F.col("part").isNotNull())
    salts = max(1, math.ceil(math.sqrt(counts.count() / SKETCH_PARTS)))
    salted = counts.select("part", "counts", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)).alias("salt"))
    once = salted.groupBy("part", "salt").applyInPandas(add, "part int, counts binary")
    parts = once.groupBy("part").applyInPandas(halves, "part int, counts binary").collect()
    total = np.zeros(1 << bits, np.uint64)
    step = (1 << bits) // SKETCH_PARTS
    for row in parts:
        total[row["part"] * step : (row["part"] + 1) * step] = np.frombuffer(bytes(row["counts"]), np.uint64)
    # A counter holds its rare shingles by about the mean; what is beyond it is
    # one that occurs often. (Rare ones are ordered by noise, which does no harm.)
    excess = np.maximum(1.0, total.astype(float) - float(total.mean()))
    return np.floor(np.log2(excess)).astype(np.uint8)


def _ordered_prefixes(rows: DataFrame, classes: np.ndarray, size: int, bits: int, least: int, percent: int) -> DataFrame:
    """Per document of at least ``least`` shingles: n, digests of the set, and its
    first shingles from rare to frequent (class on top of 56 hash bits)."""
    shared = rows.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value.astype(np.uint64) << np.uint64(56)
        for part, texts in text_chunks(batches, 1):
            keys, offsets = shingle_sets(texts, size, lambda h: table[(h >> np.uint64(64 - bits)).astype(np.int64)] | (h & _LOW56))
            n = np.diff(offsets)
            d1, d2 = _digests(keys, offsets)
            first = np.where(n >= max(1, least), n - -(-percent * n // 100) + 1, 0)
            keep = pa.array(first > 0)
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(n, pa.int32()), pa.array(d1), pa.array(d2),
                _lists(keys[ragged(offsets[:-1], first)], np.concatenate([[0], np.cumsum(first)])),
            ], names=["doc_id", "n", "d1", "d2", "keys"]).filter(keep)

    return rows.mapInArrow(run, "doc_id bigint, n int, d1 bigint, d2 bigint, keys array<bigint>")


# --- light sets ----------------------------------------------------------------------


def _light_links(classes: DataFrame, boundary: int, percent: int) -> DataFrame:
    """Links (a, b) among the sets up to the boundary, as stars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            out: list[tuple] = []
            for rep, n, small in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                members = np.array(small, np.int64).view(np.uint64)
                for b in partner_sizes(n, percent):
                    if b > boundary:
                        continue
                    c = needed_overlap(n, b, percent)
                    chosen = np.array(list(combinations(range(n), c)), np.int64).reshape(-1, c)
                    h1, h2 = (mix64(members[chosen] ^ s).sum(axis=1, dtype=np.uint64).view(np.int64) for s in (np.uint64(1), np.uint64(2)))
                    out += [(rep, n, min(n, b), max(n, b), x, y) for x, y in zip(h1.tolist(), h2.tolist(), strict=True)]
                if len(out) > 100_000:
                    yield _light_rows(out)
                    out = []
            yield _light_rows(out)

    listed = classes.where(F.col("n") <= boundary).select("rep", "n", "small").mapInArrow(run, "rep bigint, n int, lo int, hi int, h1 bigint, h2 bigint")
    subset = ["lo", "hi", "h1", "h2"]
    # Within a subset's list for sizes (lo, hi) all of one size are similar to
    # all of the other, so a star joins them, if both sizes are there.
    stars = listed.groupBy(*subset).agg(F.min("rep").alias("hub"), F.min("n").alias("least"), F.max("n").alias("most"), F.count("*").alias("k"))
    stars = stars.where((F.col("k") > 1) & ((F.col("lo") == F.col("hi")) | (F.col("least") < F.col("most")))).select(*subset, "hub")
    return listed.join(stars, subset).where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()


def _light_rows(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out, strict=True)) if out else [[]] * 6
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["rep", "n", "lo", "hi", "h1", "h2"])


# --- heavy sets ------------------------------------------------------------------------


def _postings(prefixes: DataFrame) -> DataFrame:
    """Lists with more than one class: key, rep, n, pos, and hub, hub_n, hub_pos
    of the smallest rep in the list, or in its part where the list is long.

    Rows are shuffled once and kept narrow: n and pos share a word, and only
    the keys of long lists travel beside the list they are dealt to."""
    classes = prefixes.groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep"), F.any_value("keys").alias("keys"))
    posted = classes.select("rep", "n", F.posexplode("keys").alias("pos", "key"))
    parts = F.expr(f"shiftright(shiftleft(1L, cast(shiftright(key, 56) as int)), {LIST_ROWS.bit_length() - 1})")
    rows = posted.select(
        F.when(parts > 1, F.xxhash64("key", F.pmod(F.xxhash64("rep"), parts))).otherwise(F.col("key")).alias("list"),
        F.when(parts > 1, F.col("key")).alias("long"),
        F.struct("rep", F.expr("shiftleft(cast(n as bigint), 32) + pos").alias("at")).alias("m"),
    ).select("list", "long", "m.rep", "m.at")
    whole = Window.partitionBy("list")
    met = rows.withColumns({"hub": F.min(F.struct("rep", "at")).over(whole), "met": F.count("*").over(whole)})
    unpack = lambda at: (F.shiftright(at, 32).cast("int"), at.bitwiseAND(0xFFFFFFFF).cast("int"))
    (n, pos), (hub_n, hub_pos) = unpack(F.col("at")), unpack(F.col("hub.at"))
    return met.where("met > 1 OR long IS NOT NULL").select(
        F.coalesce("long", "list").alias("key"), "rep", n.alias("n"), pos.alias("pos"),
        F.col("hub.rep").alias("hub"), hub_n.alias("hub_n"), hub_pos.alias("hub_pos"),
    )


def _may_be_similar(na: Column, nb: Column, pos_a: Column, pos_b: Column, percent: int) -> Column:
    """By the sizes, and for the first shingle that both share by its places:
    enough shingles must be left in both orders."""
    overlap = _overlap(na, nb, percent)
    sized = (100 * na >= percent * nb) & (100 * nb >= percent * na)
    return sized & (pos_a <= na - overlap) & (pos_b <= nb - overlap)


def _first_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """One pair per class: with the hub that it meets most often where they may be similar."""
    fits = _may_be_similar(F.col("n"), F.col("hub_n"), F.col("pos"), F.col("hub_pos"), percent)
    met = postings.where((F.col("rep") != F.col("hub")) & fits).groupBy("rep", "hub").agg(F.count("*").alias("k"))
    return met.groupBy("rep").agg(F.max_by("hub", F.struct(F.col("k"), -F.col("hub"))).alias("hub")).select(F.col("rep").alias("a"), F.col("hub").alias("b"))


def _open_pairs(postings: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes that share lists, are not connected and may be similar."""
    known = postings.join(labels.select(F.col("node").alias("rep"), "label"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    known = stored(known.select("key", "rep", "n", "pos", "label"), "postings")
    mixed = known.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key")
    rows = stored(known.join(mixed, "key", "left_semi"), "mixed")
    x, y = (rows.select("key", *[F.col(c).alias(f"{c}_{s}") for c in ("rep", "n", "pos", "label")]) for s in ("a", "b"))
    na, nb = F.col("n_a"), F.col("n_b")
    overlap = _overlap(na, nb, percent)
    apart = (F.col("label_a") != F.col("label_b")) & ((na < nb) | ((na == nb) & (F.col("rep_a") < F.col("rep_b"))))
    fits = _may_be_similar(na, nb, F.col("pos_a"), F.col("pos_b"), percent)
    met = x.join(y, "key").where(apart & fits).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct()
    # Of its required overlap a similar pair shares at least this many shingles in both prefixes.
    sizes = rows.select("rep", "n").distinct()
    met = met.join(sizes.select(F.col("rep").alias("a"), F.col("n").alias("n_a")), "a").join(sizes.select(F.col("rep").alias("b"), F.col("n").alias("n_b")), "b")
    least = F.least(_prefix(na, percent) - na + overlap, _prefix(nb, percent) - nb + overlap)
    lists = rows.groupBy("rep").agg(F.collect_list("key").alias("keys"))
    shared = F.size(F.array_intersect("keys_a", "keys_b"))
    met = met.join(lists.select(F.col("rep").alias("a"), F.col("keys").alias("keys_a")), "a").join(lists.select(F.col("rep").alias("b"), F.col("keys").alias("keys_b")), "b")
    return met.where(shared >= least).select("a", "b")


# --- verification ------------------------------------------------------------------------


def _id_filter(ids: DataFrame, n: int):
    """A broadcast bitmap of hashed ids, at most 2**FILTER_BITS bits (8 MB): it
    spares making sets of other documents; the join after it is exact."""
    bits = int(min(FILTER_BITS, max(16, np.ceil(np.log2(16 * n + 1)))))
    spot = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - bits)

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        cell = np.zeros(1 << 16, bool)
        cell[group["bit"].to_numpy()] = True
        return pd.DataFrame({"cell": [group["cell"].iloc[0]], "map": [np.packbits(cell, bitorder="little").tobytes()]})

    spots = ids.select(F.shiftright(spot, 16).alias("cell"), (spot.bitwiseAND((1 << 16) - 1)).cast("int").alias("bit")).distinct()
    found = spots.groupBy("cell").applyInPandas(fill, "cell bigint, map binary").collect()
    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    for row in found:
        bitmap[row["cell"] << 13 : (row["cell"] + 1) << 13] = np.frombuffer(bytes(row["map"]), np.uint8)
    return ids.sparkSession.sparkContext.broadcast(bitmap), spot


def _verified(rows: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar."""
    pairs = stored(pairs, "pairs")
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    n = ids.count()
    if not n:
        return pairs
    bitmap, spot = _id_filter(ids, n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(2).to_numpy()
            picked = batch.filter(pa.array((bitmap.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1))
            for part, texts in text_chunks([picked], 1):
                hashed, offsets = shingle_sets(texts, size)
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(hashed, offsets)], names=["doc_id", "members"])

    sets = stored(rows.withColumn("spot", spot).mapInArrow(run, "doc_id bigint, members array<bigint>"), "sets")
    # The side with hubs first, while rows are narrow.
    joined = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("members").alias("members_b")), "b")
    # A class with very many partners is dealt over several tasks.
    joined = skew_safe_join(joined, sets.select(F.col("doc_id").alias("a"), F.col("members").alias("members_a")), "a")
    both = F.size(F.array_intersect("members_a", "members_b"))
    rows_of = joined.select("a", "b", both.alias("both"), (F.size("members_a") + F.size("members_b")).alias("sum"))
    return rows_of.where(100 * F.col("both") >= percent * (F.col("sum") - F.col("both"))).select("a", "b").distinct()


def join_components(
    df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
    percent: int = SIMILARITY, sketch_bits: int = SKETCH_BITS,
) -> DataFrame:
    """Near-duplicate components of documents by exact shingle Jaccard similarity.

    Returns doc_id, n_shingles and component_id: the smallest doc_id reachable
    over links (100 * intersection >= ``percent`` * union).

    Defined cases: a null or empty text, or one without words, has no shingles
    and is linked with nothing; with fewer words than a shingle the whole
    sequence is the one shingle; rows that repeat a doc_id are the same
    document (its texts' links are joined); rows with a null id and equal texts
    are one document, which links others like any, and whose component_id is
    the smallest id that it reaches, null if it reaches none; a text of any
    length is read whole; other input columns are ignored; an empty table gives
    no rows. Ids beyond 2**63 - 2**40 leave no numbers for rows without one: a
    ValueError where a table has both.
    """
    node, unnamed = _nodes(df, id_col, text_col)
    labelled = _labelled(df.select(node.alias("doc_id"), F.col(text_col).cast("string").alias("text")), size, percent, sketch_bits)
    given = lambda c: F.when(F.col(c) < unnamed, F.col(c)) if unnamed else F.col(c)
    return labelled.select(given("doc_id").alias("doc_id"), "n_shingles", given("component_id").alias("component_id"))


def _nodes(df: DataFrame, id_col: str, text_col: str) -> tuple[Column, int | None]:
    """The number of every row's document: its id, or for rows without one a hash
    of the text above all ids (from the second result on)."""
    key = F.col(id_col).cast("bigint")
    nulls, top = df.agg(F.count(F.when(key.isNull(), 1)), F.max(key)).first()
    if not nulls:
        return key, None
    unnamed = max(1 << 62, (-1 if top is None else top) + 1)
    if unnamed > (1 << 63) - (1 << 40):
        raise ValueError(f"{id_col} goes up to {top}: no numbers are left for the rows without one")
    made = F.lit(unnamed) + F.pmod(F.xxhash64(F.col(text_col).cast("string")), F.lit((1 << 63) - unnamed))
    return F.coalesce(key, made), unnamed


def _labelled(rows: DataFrame, size: int, percent: int, sketch_bits: int) -> DataFrame:
    """doc_id, n_shingles and component_id of rows that all have a doc_id."""
    found = stored(_sets_and_sketch(rows, size, sketch_bits), "sketch")
    documents = found.where(F.col("part").isNull()).select("doc_id", "n", "d1", "d2", "small")
    real = documents.where("n > 0")
    classes = stored(real.groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep"), F.any_value("small").alias("small")), "classes")

    sizes = {r["n"]: r["count"] for r in classes.where(F.col("n") <= 2 * LIGHT_MOST).groupBy("n").count().collect()}
    boundary = boundary_by_cost(sizes, percent)
    links = _light_links(classes, boundary, percent)

    order = _frequency_classes(found, sketch_bits)
    prefixes = _ordered_prefixes(rows, order, size, sketch_bits, least_posted(boundary, percent), percent)
    postings = stored(_postings(prefixes), "postings")
    links = links.union(_same_id_links(real, classes)).union(_verified(rows, _first_pairs(postings, percent), size, percent))
    links = stored(links, "links")
    labels = components(links)
    late = _verified(rows, _open_pairs(postings, labels, percent), size, percent)
    labels = _relabelled(labels, late)

    return (
        _with_class(documents, classes)
        .select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), F.coalesce("rep", "doc_id").alias("node"))
        .join(labels, "node", "left")
        .select("doc_id", "n_shingles", F.coalesce("label", "node").alias("component_id"))
    )


def _with_class(documents: DataFrame, classes: DataFrame) -> DataFrame:
    mine = classes.select(F.col("n").alias("cn"), F.col("d1").alias("c1"), F.col("d2").alias("c2"), "rep")
    same = (F.col("n") == F.col("cn")) & (F.col("d1") == F.col("c1")) & (F.col("d2") == F.col("c2"))
    return documents.select("doc_id", "n", "d1", "d2").join(mine, same, "left")


def _same_id_links(real: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of a doc_id that several rows with different texts have."""
    twice = real.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id")
    again = _with_class(real.join(twice, "doc_id", "left_semi"), classes)
    hubs = again.groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("most")).where("b < most").select("doc_id", "b")
    return again.join(hubs, "doc_id").select(F.col("rep").alias("a"), "b").where("a <> b").distinct()


def _relabelled(labels: DataFrame, late: DataFrame) -> DataFrame:
    """Labels after the late links: components of components."""
    late = stored(late, "late")
    if not late.limit(1).count():
        return labels
    mine = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    other = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    merged = components(late.join(mine, "a", "left").join(other, "b", "left").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
    above = merged.select(F.col("node").alias("label"), F.col("label").alias("top"))
    old = labels.join(above, "label", "left").select("node", F.coalesce("top", "label").alias("label"))
    # Classes that had no link before are nodes of the merged graph themselves.
    return old.unionByName(merged.join(labels.select("node"), "node", "left_anti").select("node", "label"))


def keep_first(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", one_row: bool = False) -> DataFrame:
    """The rows of ``df`` whose document is its component's smallest, with all their
    columns. Documents with an id come before those without one (rows with a null
    id and equal texts are one document).

    Several rows of that document all stay; with ``one_row`` one of them does, the
    one with the smallest hash of its columns. Other cases as for
    :func:`join_components`.
    """
    node, _ = _nodes(df, id_col, text_col)
    found = _labelled(df.select(node.alias("doc_id"), F.col(text_col).cast("string").alias("text")), SIZE, SIMILARITY, SKETCH_BITS)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct()
    left = df.join(gone, node == F.col("__gone"), "left_anti")
    if not one_row:
        return left
    twice = df.groupBy(node.alias("__twice")).agg(F.count("*").alias("__rows")).where("__rows > 1").select("__twice")
    twice = stored(twice, "repeated")
    if not twice.limit(1).count():
        return left
    again = left.join(twice, node == F.col("__twice"), "left_semi")
    # The partial aggregate leaves one row per document and task, however often a row occurs.
    picked = again.groupBy(node.alias("__key")).agg(F.min_by(F.struct(*df.columns), F.xxhash64(*df.columns)).alias("__row"))
    return left.join(twice, node == F.col("__twice"), "left_anti").unionByName(picked.select("__row.*"))
