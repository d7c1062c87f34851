"""Vectorised hashing of texts inside Arrow batches: bytes, words, shingles.

Texts are taken straight from the Arrow buffers, as many rows at a time as make about ``SLICE``
bytes, so that memory stays small whatever the batch size; a text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEPS = np.random.default_rng(20240602).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = {"n": 0}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse; what is kept grows with what was asked for."""
    if _powers["n"] < n:
        size = max(n, 2 * _powers["n"])
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
        _powers["n"] = size
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """``p`` of length n + 1, so that ``span_hashes`` can hash any span of ``data`` in one step."""
    up, _ = powers(len(data) + 1)
    p = np.empty(len(data) + 1, np.uint64)
    p[0] = 0
    np.cumsum(_BYTES[data] * up[: len(data)], out=p[1:])
    return p


def span_hashes(p: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of the bytes of each span; equal spans have equal hashes wherever they stand."""
    _, down = powers(len(p))
    return (p[end] - p[start]) * down[start]


def text_slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows: (first row, row after the last, their bytes, start of each text and the end of the last)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(ends, ends[low] + limit, "right")) - 1)
        high = min(high, n)
        yield low, high, raw[ends[low] : ends[high]], ends[low : high + 1] - ends[low]
        low = high


def portions(batch: pa.RecordBatch, name: str = "text", limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of ``batch``, one portion for each of the ``text_slices`` of column ``name``."""
    for low, high, _, _ in text_slices(batch.column(name), limit):
        yield batch.slice(low, high - low)


def words(data: np.ndarray, bounds: np.ndarray, between: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts of a slice, and the number of the first word of each text (and the end)."""
    if not len(data):
        empty = np.empty(0, np.int64)
        return empty, empty, np.zeros(len(bounds), np.int64)
    solid = ~between[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = solid[edges]
    last[edges - 1] = solid[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each lower-cased word (A-Z only)."""
    hashed = span_hashes(prefix_hashes(LOWER[data]), starts, ends)
    return mix(hashed ^ (ends - starts).astype(np.uint64) * _STEPS[63])


def shingles(hashes: np.ndarray, firsts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``n``-word shingles, and the number of the first shingle of each text (and the end).

    A text with fewer words has its whole sequence as its one shingle; without words it has none.
    """
    counts = np.diff(firsts)
    whole = np.zeros(max(len(hashes) - n + 1, 0), np.uint64)
    for k in range(n if len(whole) else 0):
        whole += hashes[k : len(hashes) - n + 1 + k] * _STEPS[k]
    kept = np.maximum(counts - n + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < n))
    kept[short] = 1
    out_first = np.concatenate(([0], np.cumsum(kept)))
    at = np.repeat(firsts[:-1] - out_first[:-1], kept) + np.arange(out_first[-1])
    out = np.zeros(out_first[-1], np.uint64)
    is_short = np.zeros(len(counts), bool)
    is_short[short] = True
    long_rows = ~np.repeat(is_short, kept)
    out[long_rows] = whole[at[long_rows]]
    for row in short:
        run = hashes[firsts[row] : firsts[row + 1]]
        length = np.array([len(run)], np.uint64)
        out[out_first[row]] = ((run * _STEPS[: len(run)]).sum(dtype=np.uint64, keepdims=True) + length * _STEPS[32:33])[0]
    return mix(out), out_first


def sets(column: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingles) of every text of a batch."""
    for low, _, data, bounds in text_slices(column):
        starts, ends, firsts = words(data, bounds)
        found, at = shingles(word_hashes(data, starts, ends), firsts, n)
        for i in range(len(at) - 1):
            yield low + i, np.unique(found[at[i] : at[i + 1]])
