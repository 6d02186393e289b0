"""Column expressions over spectra (ARRAY<DOUBLE>).

Row-wise filters are matrix products over Arrow batches, since Spark interprets nested
array lambdas value by value; everything else stays in the JVM.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .kernels import savgol_matrix


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def doubles(x: Column) -> Column:
    """Cast up before any arithmetic."""
    return x.cast("array<double>")


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + v)


def dot(x: Column, y: Column | Sequence[float]) -> Column:
    y = y if isinstance(y, Column) else F.lit([float(v) for v in y])
    return total(F.zip_with(x, y, lambda a, b: a * b))


def _row_wise(kernel: Callable[[np.ndarray], np.ndarray]) -> Callable[[Column], Column]:
    """A column function that applies ``kernel`` to matrices whose rows are spectra of one length.

    Arrow hands whole batches over, so a batch of equal lengths is one matrix and one call. A null
    spectrum, and one that holds a null, gives null; an empty one stays empty.
    """

    @F.arrow_udf("array<double>")
    def run(x: pa.Array) -> pa.Array:
        starts = x.offsets.to_numpy()
        values = x.values.to_numpy(zero_copy_only=False)
        lengths = np.diff(starts)
        good = x.is_valid().to_numpy(zero_copy_only=False)
        if x.values.null_count:
            gaps = np.r_[0, np.cumsum(x.values.is_null().to_numpy(zero_copy_only=False))]
            good = good & (gaps[starts[1:]] == gaps[starts[:-1]])
        out: list = [None] * len(x)
        for width in np.unique(lengths[good]):
            rows = np.nonzero(good & (lengths == width))[0]
            block = values[starts[rows][:, None] + np.arange(width)] if width else np.zeros((len(rows), 0))
            made = kernel(block) if width else block
            if len(rows) == len(x):
                ends = np.arange(len(x) + 1, dtype=np.int32) * made.shape[1]
                return pa.ListArray.from_arrays(pa.array(ends), pa.array(made.ravel()))
            for row, values_ in zip(rows, made, strict=True):
                out[row] = values_
        return pa.array(out, pa.list_(pa.float64()))

    return lambda x: run(doubles(x))


def _standardised(block: np.ndarray) -> np.ndarray:
    centred = block - block.mean(1, keepdims=True)
    deviation = np.sqrt((centred * centred).mean(1, keepdims=True))
    flat = ~(deviation > 1e-12)
    return np.where(flat, 0.0, centred / np.where(flat, 1.0, deviation))


def snv(x: Column) -> Column:
    """(x - mean) / population deviation of the row; zeros for a constant row."""
    return _row_wise(_standardised)(x)


def is_constant(x: Column) -> Column:
    """Diagnostic: the row has no spread."""
    return F.array_max(x) == F.array_min(x)


def linear(x: Column, matrix: np.ndarray, offset: np.ndarray | None = None) -> Column:
    """O x + c; a spectrum of another width than the matrix takes is an error."""
    turned = np.ascontiguousarray(np.asarray(matrix, float).T)
    shift = np.zeros(turned.shape[1]) if offset is None else np.asarray(offset, float)

    def kernel(block: np.ndarray) -> np.ndarray:
        if block.shape[1] != len(turned):
            raise ValueError(f"{block.shape[1]} values; the filter takes {len(turned)}")
        return block @ turned + shift

    return _row_wise(kernel)(x)


def savgol(x: Column, *params) -> Column:
    """A filter by its parameters, for spectra of any width; the matrix of a width is made once a worker."""

    def kernel(block: np.ndarray) -> np.ndarray:
        matrix, offset = _filter(block.shape[1], params)
        return block @ matrix.T + offset

    return _row_wise(kernel)(x)


@functools.lru_cache(maxsize=32)
def _filter(width: int, params: tuple) -> tuple[np.ndarray, np.ndarray]:
    return savgol_matrix(width, *params)


def all_finite(x: Column) -> Column:
    """No null, NaN or infinity; false for a null array."""
    return F.coalesce(
        F.forall(doubles(x), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))), F.lit(False)
    )


def finite(v: Column) -> Column:
    return F.coalesce(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), F.lit(False))


def take(x: Column, places: Sequence[int]) -> Column:
    """The values at 0-based ``places``, in that order."""
    return F.transform(F.lit([int(p) for p in places]), lambda i: F.get(x, i))


def round12(x: Column) -> Column:
    """Half-even rounding to 12 places."""
    return F.transform(doubles(x), lambda v: F.bround(v, 12))


def max_abs_diff(a: Column, b: Column) -> Column:
    """max |a - b| of two arrays, 0 for empty ones; null when their lengths differ."""
    gap = F.array_max(F.zip_with(doubles(a), doubles(b), lambda x, y: F.abs(x - y)))
    return F.when(F.size(a) == F.size(b), F.coalesce(gap, F.lit(0.0)))


def even_places(n: int, limit: int) -> list[int]:
    """``limit`` evenly spaced places of 0..n-1: truncated, distinct, filled up from the start, ascending."""
    if limit >= n:
        return list(range(n))
    if limit <= 0:
        return []
    if limit == 1:
        return [0]
    step = (n - 1) / (limit - 1)
    places = {n - 1 if i == limit - 1 else int(i * step) for i in range(limit)}
    for i in range(n):
        if len(places) >= limit:
            break
        places.add(i)
    return sorted(places)
