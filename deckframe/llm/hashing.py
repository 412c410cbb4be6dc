"""Vectorised hashes of words and byte windows inside Arrow batches.

All arithmetic is on unsigned 64-bit integers and wraps.  A batch is worked in
runs of whole documents of about ``RUN_BYTES``, so memory follows the longest
document and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

RUN_BYTES = 1 << 19
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(1, 257, dtype=np.uint64)
_FOLD[ord("A"):ord("Z") + 1] = _FOLD[ord("a"):ord("z") + 1]
_POWERS = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1)."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        _POWERS[base] = have = np.multiply.accumulate(have)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of ``h`` over the whole word."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and the len + 1 offsets of a column of strings or binaries without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    return data, offsets


def runs(offsets: np.ndarray, limit: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of documents of about ``limit`` bytes, one document at least."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last
        first = last


class Words(NamedTuple):
    """Of a run of documents: a hash for each word, the bytes where words start
    and end, and the number of words before each document."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray


def words(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = _SPACE) -> Words:
    """Words are runs of bytes outside ``breaks`` (a flag for each byte value);
    A-Z counts as a-z.  ``offsets`` are those of the run and start at any byte
    of ``data``."""
    base, data = offsets[0], data[offsets[0]:offsets[-1]]
    at = offsets - base
    n = len(data)
    space = np.ones(n + 2, bool)
    space[1:-1] = breaks[data]
    inner = ~space[1:-1]
    opens, closes = space[:-2].copy(), space[2:].copy()
    edge = at[at < n]
    opens[edge] = True
    closes[edge[edge > 0] - 1] = True
    starts, ends = np.flatnonzero(inner & opens), np.flatnonzero(inner & closes) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_FOLD[data] * powers(BASE, n), out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * powers(BASE_INVERSE, n + 1)[starts] + (ends - starts).astype(np.uint64))
    return Words(hashes, starts + base, ends + base, np.searchsorted(starts, at))


def shingles(found: Words, size: int) -> list[np.ndarray]:
    """Per document the sorted distinct hashes of its ``size``-word shingles;
    with fewer words one hash of them all, without words none."""
    h = found.hashes
    n = max(0, len(h) - size + 1)
    whole = np.zeros(n, np.uint64)
    for k in range(size):
        whole = whole * np.uint64(BASE) + h[k:k + n]
    whole = mix(whole)
    out = []
    for a, b in zip(found.bounds[:-1].tolist(), found.bounds[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(whole[a:b - size + 1]))
        elif b > a:
            short = np.array([b - a], np.uint64)
            for k in range(a, b):
                short = mix(short * np.uint64(BASE) + h[k:k + 1])
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
    return out
