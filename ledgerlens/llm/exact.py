"""Exact integer arithmetic on vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F


def whole_and_finite(vector: Column) -> Column:
    """Whether a vector is there and holds neither nulls nor non-finite components."""
    return F.coalesce(vector.isNotNull() & ~F.exists(vector, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))),
                      F.lit(False))


def floors(column: pa.Array, scale: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(components, offsets) of a column of float lists: floor(scale * x), x as double."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    values = np.floor(scale * values)
    if len(values) and np.abs(values).max() >= limit:
        raise OverflowError(f"a component times {scale} reaches {limit}")
    offsets = column.offsets.to_numpy().astype(np.int64)
    return values.astype(np.int64), offsets - offsets[0]


def dot(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x @ y of integers, exactly: in doubles where every partial sum fits into one, else in 64-bit integers."""
    if not x.size or not y.size:
        return np.zeros(x.shape[:-1] + y.shape[1:], np.int64)
    bound = int(np.abs(x).max()) * int(np.abs(y).max()) * x.shape[-1]
    if bound < 2 ** 53:
        return (x.astype(np.float64) @ y.astype(np.float64)).astype(np.int64)
    if bound >= 2 ** 63:
        raise OverflowError("an inner product may not fit into 64 bits")
    return x.astype(np.int64) @ y.astype(np.int64)


def pack(x: np.ndarray) -> bytes:
    """Integers in as few bytes each as hold them all; their number tells :func:`unpack` the width."""
    low, high = (int(x.min()), int(x.max())) if x.size else (0, 0)
    for kind in (np.int8, np.int16, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return x.astype(kind).tobytes()
    return x.astype(np.int64).tobytes()


def unpack(raw: bytes, n: int) -> np.ndarray:
    """The ``n`` integers of :func:`pack`."""
    return np.frombuffer(raw, f"<i{len(raw) // n if n else 8}").astype(np.int64)
