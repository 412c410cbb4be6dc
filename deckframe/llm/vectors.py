"""Vectors of a list column as exact integers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# components from this size on are no 64-bit integers with room for a sign and a difference
BEYOND = 2.0 ** 62


def whole_numbers(column: pa.Array, scale: int, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rows, values): the places of the vectors that take part, and floor(scale * x)
    of their components as int64.

    A vector takes no part if it is null, holds a null, a NaN, an infinity or a
    component beyond 64-bit integers, or has another length than ``width``.
    Without ``width`` vectors may differ in length, and shorter ones are filled
    with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros((0, width or 0), np.int64)
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    whole = np.floor(flat * float(scale))
    usable = np.abs(whole) < BEYOND  # false for NaN as well
    starts = np.concatenate([[0], np.cumsum(lengths)])
    bad = np.concatenate([[0], np.cumsum(~usable)])
    fine = (bad[starts[1:]] == bad[starts[:-1]]) & column.is_valid().to_numpy(zero_copy_only=False)
    if width is not None:
        fine &= lengths == width
    rows = np.flatnonzero(fine)
    longest = width if width is not None else int(lengths[rows].max(initial=0))
    places = np.arange(longest)
    inside = places < lengths[rows, None]
    at = np.where(inside, starts[rows, None] + places, 0)
    values = np.where(inside, whole[at], 0).astype(np.int64) if longest and len(whole) else np.zeros((len(rows), longest), np.int64)
    return rows, values


def narrow(values: np.ndarray) -> np.ndarray:
    """The same integers in the smallest signed type that holds them all."""
    most = int(np.abs(values).max(initial=0))
    return values.astype(next(t for t in (np.int16, np.int32, np.int64) if most <= np.iinfo(t).max))
