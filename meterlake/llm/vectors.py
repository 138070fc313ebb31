"""Quantised vectors and exact inner products, shared by the vector operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

LONG = 2**63 - 1


def takes_part(vector: Column) -> Column:
    """Neither the vector nor a component is null, and every component is finite."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component as a double, which holds it exactly.
    (Beyond 2**53 every double is whole, and so is its product.)"""
    scaled = F.transform(vector, lambda x: x * F.lit(float(scale)))
    return F.transform(scaled, lambda x: F.when(F.abs(x) < float(2**53), F.floor(x).cast("double")).otherwise(x))


def matrix(column: pa.ChunkedArray | pa.Array, width: int | None = None) -> np.ndarray:
    """The rows of a list column side by side, shorter ones padded with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), max([width or 1, *sizes.tolist()])))
    values = column.values.to_numpy()
    inside = np.arange(out.shape[1])[None, :] < sizes[:, None]
    out[inside] = values[offsets[0] : offsets[-1]]
    return out


class Exact:
    """Exact integer products of two sets of whole-numbered rows.

    They are floats while every sum fits a float's mantissa, then 64-bit, then
    unbounded integers; a product beyond 64 bits becomes the nearest of them."""

    def __init__(self, left: np.ndarray, right: np.ndarray):
        most = left.shape[1] * float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0))
        kind = np.float64 if most < 2.0**53 else np.int64 if most < 2.0**62 else object
        self.left, self.right = (np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) if kind is object
                                 else m.astype(kind, copy=False) for m in (left, right))

    def products(self, rows, others) -> np.ndarray:
        got = self.left[rows] @ self.right[others].T
        if got.dtype == object:
            return np.array([min(max(int(x), -LONG - 1), LONG) for x in got.ravel()], np.int64).reshape(got.shape)
        return got.astype(np.int64)
