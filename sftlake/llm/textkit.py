"""Vectorised word and shingle hashing over Arrow text columns, shared by several operators.

A word is a run of bytes outside space and 0x09-0x0D. A null text counts as empty. Texts are
handled in slices of about ``SLICE_BYTES`` so a task's memory does not follow its batch size;
one text is always whole inside its slice."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
_MASK = (1 << 64) - 1
_P = 0x9E3779B97F4A7C15
_PINV = pow(_P, -1, 1 << 64)
_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_WS = np.zeros(256, bool)
_WS[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_pw = _ipw = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * _C1
    x ^= x >> np.uint64(27)
    x *= _C2
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pw, _ipw
    if len(_pw) < n:
        size = max(n, SLICE_BYTES + (1 << 16))
        _pw = np.full(size, _P, np.uint64)
        _ipw = np.full(size, _PINV, np.uint64)
        _pw[0] = _ipw[0] = 1
        np.multiply.accumulate(_pw, out=_pw)
        np.multiply.accumulate(_ipw, out=_ipw)
    return _pw, _ipw


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and the offsets of each text in them."""
    col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    off = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str = "text"):
    """Row slices of a batch holding about SLICE_BYTES of text each (at least one row)."""
    if not batch.num_rows:
        return
    _, off = text_buffer(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(off, off[at] + SLICE_BYTES, "right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


class Words:
    """Words of a run of texts: ``start``/``end`` byte positions, ``hash``, and ``off``, the
    index of each text's first word (length texts + 1)."""

    def __init__(self, data: np.ndarray, off: np.ndarray, lower: bool = False, apart: np.ndarray = _WS):
        """``apart``: which byte values separate words."""
        n = len(data)
        ws = apart[data]
        before = np.ones(n + 1, bool)
        before[1:] = ws
        after = before[1:].copy()
        inner = off[(off > 0) & (off < n)]
        before = before[:n]
        before[inner] = True
        after[:-1] = ws[1:]
        if n:
            after[-1] = True
        after[inner - 1] = True
        word = ~ws
        self.start = np.flatnonzero(word & before)
        self.end = np.flatnonzero(word & after) + 1
        self.off = np.searchsorted(self.start, off)
        pw, ipw = _powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((_LOWER[data] if lower else data).astype(np.uint64) * pw[:n], out=sums[1:])
        h = (sums[self.end] - sums[self.start]) * ipw[self.start]
        self.hash = mix(h + (self.end - self.start).astype(np.uint64) * _C2)

    def doc(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.off) - 1), np.diff(self.off))

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every window of k consecutive words inside one text."""
        h = window_hash(self.hash, k)
        at = np.arange(len(h))
        doc = self.doc()
        keep = doc[: len(h)] == doc[k - 1 :] if len(h) else np.zeros(0, bool)
        return at[keep], h[keep]


def window_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive items of ``h``; equal sequences have equal hashes."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    pw, ipw = _powers(len(h) + 1)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * pw[: len(h)], out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * ipw[:n] + np.uint64(k))
