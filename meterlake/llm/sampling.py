"""Bounded samples of labelled rows for fitting, and the fold that stays out of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 4
HELD_OUT_FOLD = 2


def held_out(id_col: Column) -> Column:
    """True for the ids whose crc32 (of the id as text) is in the held-out fold; false for null ids."""
    fold = F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(FOLDS))
    return F.coalesce(fold == HELD_OUT_FOLD, F.lit(False))


def sample_per_label(df: DataFrame, label: str, id_col: str, rows: int) -> DataFrame:
    """About ``rows`` rows of every label: those with the smallest id hashes.

    Which rows are taken depends on their ids alone. The labels and their
    counts reach the driver (one row per label), nothing else does.
    """
    counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect() if r[label] is not None}
    keep = F.lit(False)
    for value, n in counts.items():
        # Of 63 hash bits: fine enough for a share of a few rows in any table.
        small = F.shiftrightunsigned(F.xxhash64(F.col(id_col)), 1) <= min((1 << 63) - 1, (1 << 63) * rows // n)
        keep = keep | ((F.col(label) == F.lit(value)) & small)
    return df.where(keep)
