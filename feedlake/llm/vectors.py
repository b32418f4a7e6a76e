"""Whole-number vectors: conversion from Arrow lists, a packed form for tables, exact products.

A component ``x`` becomes the integer ``floor(scale * x)``. Ordinary vectors are held as 64-bit
integers; one with a component of :data:`ORDINARY` or more in size is *long* and held as Python
integers, so that every sum below stays exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ORDINARY = 1 << 24  # products and squared distances over up to 4,096 components fit 64 bits
_LONGEST = 1 << 63


def scaled(column: pa.Array, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Usable vectors of a list column of doubles as ``(places, matrix)``, one per length and kind.

    Null and empty vectors and such with a null or non-finite component are left out.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    ends = np.cumsum(sizes, dtype=np.int64)
    starts = ends - sizes
    finite = np.isfinite(values)

    def counts(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags)))
        return total[ends] - total[starts]

    usable = (counts(~finite) == 0) & (sizes > 0)
    with np.errstate(over="ignore", invalid="ignore"):
        whole = np.floor(values * scale)
        wide = counts(~(np.abs(whole) < ORDINARY)) > 0
    for size in np.unique(sizes[usable]):
        for long in (False, True):
            places = np.flatnonzero(usable & (sizes == size) & (wide == long))
            if not len(places):
                continue
            own = starts[places, None] + np.arange(size)
            if not long:
                yield places, whole[own].astype(np.int64)
                continue
            matrix = np.empty(own.shape, object)
            matrix.ravel()[:] = [_floor(x, scale) for x in values[own].ravel().tolist()]
            yield places, matrix


def _floor(x: float, scale: int) -> int:
    # From 2**53 on a double is a whole number, and its product might overflow.
    return int(x) * scale if abs(x) >= 2.0**53 else math.floor(x * scale)


def packed(matrix: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary cells: 32-bit integers, or decimal text for long vectors."""
    if matrix.dtype == object:
        return pa.array([",".join(map(str, row)).encode() for row in matrix], pa.binary())
    data = np.ascontiguousarray(matrix, "<i4")
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * (4 * matrix.shape[1])
    return pa.Array.from_buffers(
        pa.binary(), len(matrix), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    )


def unpacked(cells: pa.Array, long: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(places, matrix)`` of the ordinary rows and of the long ones; all of one length."""
    ordinary = np.flatnonzero(~long)
    if len(ordinary):
        own = cells.take(pa.array(ordinary)) if long.any() else cells
        _, offsets, data = own.buffers()
        bounds = np.frombuffer(offsets, np.int32)[own.offset : own.offset + len(own) + 1]
        whole = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]].view("<i4")
        yield ordinary, whole.reshape(len(ordinary), -1).astype(np.int64)
    wide = np.flatnonzero(long)
    if len(wide):
        rows = [list(map(int, cells[int(k)].as_py().split(b","))) for k in wide]
        yield wide, np.array(rows, object)


def squared_distances(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    """Exact squared Euclidean distances of all rows to one centre."""
    apart = points - center
    if apart.dtype == object:
        return (apart * apart).sum(1)
    return np.einsum("ij,ij->i", apart, apart)


def fits_long(values: np.ndarray) -> np.ndarray:
    """Which whole numbers a 64-bit column can hold."""
    if values.dtype != object:
        return np.ones(values.shape, bool)
    return ((values < _LONGEST) & (values >= -_LONGEST)).astype(bool)
