"""Vectorised text work inside tasks: Arrow strings as byte arrays, word bounds and hashes without a loop over rows.

Hashes are prefix sums of ``byte * P^i`` modulo 2^64, mixed at the end; every use compares the bytes or accepts a 64-bit
collision as stated there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19  # bytes worked on at once; the tables of powers hold as many entries, however long a row is
U = np.uint64
P = U(0x9E3779B97F4A7C15)
P_INV = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def _table(base: np.uint64) -> np.ndarray:
    """base^i for i < CHUNK."""
    if int(base) not in _powers:
        a = np.full(CHUNK, base, U)
        a[0] = 1
        np.multiply.accumulate(a, out=a)
        _powers[int(base)] = a
    return _powers[int(base)]


def inverse_powers(i: np.ndarray) -> np.ndarray:
    """P^-i."""
    near = _table(P_INV)
    if not len(i) or int(i.max()) < CHUNK:
        return near[i]
    far = np.array([pow(int(P_INV), CHUNK * k, 1 << 64) for k in range(int(i.max()) // CHUNK + 1)], U)
    return near[i % CHUNK] * far[i // CHUNK]


def released(run):
    """run, giving freed memory back to the system after each batch of results: workers live on through stages, and the next may have another use for it."""

    def each(batches):
        import ctypes

        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
        for out in run(batches):
            yield out
            pa.default_memory_pool().release_unused()
            if trim:
                trim(0)

    return each


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(31))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(29))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(32))


def strings(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        import pyarrow.compute as pc

        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    b = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return b[o[0] : o[-1]], o - o[0]


def chunks(batch: pa.RecordBatch, text: str, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about `size` bytes."""
    data, offs = strings(batch.column(text))
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + size, side="right")) - 1)
        yield i, j, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def prefix(data: np.ndarray) -> np.ndarray:
    c = np.zeros(len(data) + 1, U)
    for i in range(0, len(data), CHUNK):
        part = data[i : i + CHUNK].astype(U) + U(1)
        part *= _table(P)[: len(part)]
        if i:
            part *= U(pow(int(P), i, 1 << 64))
        np.cumsum(part, out=c[i + 1 : i + 1 + len(part)])
        if i:
            c[i + 1 : i + 1 + len(part)] += c[i]
    return c


def span_hash(c: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """The hash of data[s:e], from prefix(data)."""
    return mix((c[e] - c[s]) * inverse_powers(np.asarray(s)) + (e - s).astype(U) * U(0xD6E8FEB86659FD93))


def runs(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, cut at the offsets."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    inner = offs[(offs > 0) & (offs < len(inside))]
    first[inner] = inside[inner]
    last[inner - 1] = inside[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def counts(items: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """How many of the sorted positions fall into each row."""
    return np.diff(np.searchsorted(items, offs, side="left"))


def gram_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k consecutive values; len(h) - k + 1 of them (0 at least)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    g = h[:n].copy()
    for j in range(1, k):
        g *= P
        g += h[j : j + n]
    return mix(g + U(k))


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """The minimum of each window of w values."""
    m, p = h.copy(), 1
    while p * 2 <= w:
        m = np.minimum(m[: len(m) - p], m[p:])
        p *= 2
    r = w - p
    return np.minimum(m[: len(m) - r], m[r:]) if r else m


def sliding_max(h: np.ndarray, w: int) -> np.ndarray:
    return ~sliding_min(~h, w)


def winnowed(h: np.ndarray, w: int) -> np.ndarray:
    """Positions whose value is the minimum of some window of w values (ties all count)."""
    if len(h) < w:
        return np.zeros(0, np.int64)
    m = sliding_min(h, w)
    wide = np.concatenate([np.zeros(w - 1, h.dtype), m, np.zeros(w - 1, h.dtype)])
    return np.flatnonzero(sliding_max(wide, w)[: len(h)] == h)
