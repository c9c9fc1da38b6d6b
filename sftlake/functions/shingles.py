"""Distinct hashed word shingles of Arrow text columns.

A word is a run of bytes outside space and 0x09-0x0D. Hashes of words and of runs of words are
differences of one running sum, so the work follows the bytes of text whatever its words are.
Texts are handled in slices of about ``SLICE_BYTES``; one text is always whole inside its slice."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_P = 0x9E3779B97F4A7C15
_PINV = pow(_P, -1, 1 << 64)
_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * _C1
    x ^= x >> np.uint64(27)
    x *= _C2
    return x ^ (x >> np.uint64(31))


def _runs(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of values[start:end] for each start and end; equal runs have equal hashes."""
    global _powers
    if len(_powers[0]) <= len(values):
        made = []
        for base in (_P, _PINV):
            p = np.full(max(len(values) + 1, 2 * SLICE_BYTES), base, np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p, out=p))
        _powers = tuple(made)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers[0][: len(values)], out=sums[1:])
    return _mix((sums[end] - sums[start]) * _powers[1][start] + (end - start).astype(np.uint64) * _C2)


def _buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (null: none) end to end, and the offsets of each text in them."""
    col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    off = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str):
    """Row slices of a batch holding about SLICE_BYTES of text each (at least one row)."""
    if not batch.num_rows:
        return
    _, off = _buffer(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(off, off[at] + SLICE_BYTES, "right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def shingle_sets(col: pa.Array, size: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``size`` words; fewer words are one
    shingle, and a text without words has none."""
    data, off = _buffer(col)
    space = _SPACE[data]
    first, last = np.ones(len(data), bool), np.ones(len(data), bool)
    first[1:], last[:-1] = space[:-1], space[1:]
    inner = off[(off > 0) & (off < len(data))]
    first[inner] = True
    last[inner - 1] = True
    start, end = np.flatnonzero(~space & first), np.flatnonzero(~space & last) + 1
    word = _runs(data.astype(np.uint64), start, end)
    at = np.searchsorted(start, off)
    n = np.arange(max(len(word) - size + 1, 0))
    run = _runs(word, n, n + size)
    out = []
    for lo, hi in zip(at[:-1], at[1:], strict=True):
        many = run[lo : hi - size + 1] if hi - lo >= size else _runs(word[lo:hi], np.array([0]), np.array([hi - lo])) if hi > lo else run[:0]
        out.append(np.unique(many).view(np.int64))
    return out


def set_hash(s: np.ndarray) -> int:
    """A 64-bit name of a sorted set of hashes."""
    x = s.view(np.uint64)
    size = np.array([len(x)], np.uint64)
    return int(_mix(_mix(x).sum(dtype=np.uint64, keepdims=True) + _mix(size) ^ np.bitwise_xor.reduce(x)).view(np.int64)[0])
