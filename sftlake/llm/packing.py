"""Hierarchical multi-length packing of tokenised documents.

A document's tokens are its ids plus one end id. Pieces are routed to context tiers (128 to
1024 tokens here) by length. The longest piece opens a window of its tier; the gap that is left
is filled with the longest shorter pieces that fit, and at last with a cut of the shortest piece
that is longer than the gap, so every window is full. What a task has left at its end (less than
one long window) goes out in windows of powers of two, so nothing is padded at all. Windows are
dealt to step groups of about ``step_tokens`` tokens, the longest first, always to the group
with the fewest tokens.

Each task packs its own partition as a stream: no shuffle, memory bounded by ``FLUSH_TOKENS``
plus one document, and a lost task gives the same windows again. ``sequence_id`` and
``step_id`` hold the partition number in their upper bits.

Null and empty texts are packed as their end id alone. Repeated rows are packed each for
itself; other columns are not returned; an empty table gives no rows."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from sftlake.llm.common import ship_package

FLUSH_TOKENS = 1 << 20
SCHEMA = (
    "doc_id {0}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier int, step_id long"
)
SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256
_encoders: dict[str, object] = {}


def encoder(json_path: str):
    """Text -> uint32 ids, the ids that ``tokenizers`` gives for this file.

    The byte-level BPE runs on the same vocabulary written as ranks (the file beside it), which
    is about four times as fast; the first use in a process compares both on a probe and fails
    when they differ. The special token's string gives its id, as it does in ``tokenizers``."""
    if json_path not in _encoders:
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(json_path.replace(".json", ".tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        plain = Tokenizer.from_file(json_path)

        def encode(text: str) -> np.ndarray:
            if SPECIAL not in text:
                return fast.encode_to_numpy(text, disallowed_special=())
            parts: list[np.ndarray] = []
            for k, part in enumerate(text.split(SPECIAL)):
                if k:
                    parts.append(np.array([SPECIAL_ID], np.uint32))
                parts.append(fast.encode_to_numpy(part, disallowed_special=()))
            return np.concatenate(parts)

        probe = "It's  a  probe:\n\n\tüber çà 12345 ñandú 漢字 🙂 !! | 　x" + SPECIAL + " y's  "
        if encode(probe).tolist() != plain.encode(probe, add_special_tokens=False).ids:
            raise RuntimeError(f"{json_path} and its ranks give different ids")
        _encoders[json_path] = encode
    return _encoders[json_path]


def fill_windows(pool: list[tuple], tiers: tuple[int, ...]) -> tuple[list[list[tuple]], list[tuple]]:
    """Full windows out of ``pool``, pieces (length, key, start), and the pieces of the one
    window that could not be filled. A piece is cut at most where a gap needs it."""
    pool = sorted(pool)
    top = tiers[-1]
    windows: list[list[tuple]] = []
    while pool:
        n, key, start = pool.pop()
        if n >= top:
            windows.append([(top, key, start)])
            if n > top:
                bisect.insort(pool, (n - top, key, start + top))
            continue
        size = next(t for t in tiers if t >= n)
        window, gap = [(n, key, start)], size - n
        while gap and pool:
            k = bisect.bisect_left(pool, (gap + 1,))
            if k:
                piece = pool.pop(k - 1)
                window.append(piece)
                gap -= piece[0]
            else:
                n, key, start = pool.pop(0)
                window.append((gap, key, start))
                bisect.insort(pool, (n - gap, key, start + gap))
                gap = 0
        if gap:
            return windows, window
        windows.append(window)
    return windows, []


def powers_of_two(rest: list[tuple]) -> list[list[tuple]]:
    """The last pieces as windows whose sizes are the binary digits of their total."""
    total, windows = sum(p[0] for p in rest), []
    rest = list(rest)
    for bit in reversed(range(total.bit_length())):
        if not total >> bit & 1:
            continue
        window, gap = [], 1 << bit
        while gap:
            n, key, start = rest.pop(0)
            if n > gap:
                rest.insert(0, (n - gap, key, start + gap))
                n = gap
            window.append((n, key, start))
            gap -= n
        windows.append(window)
    return windows


def step_groups(sizes: list[int], step_tokens: int) -> list[int]:
    """A group for each window, so that groups hold nearly the same number of tokens."""
    import heapq

    heap = [(0, g) for g in range(max(1, round(sum(sizes) / step_tokens)))]
    group = [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        load, g = heapq.heappop(heap)
        group[k] = g
        heapq.heappush(heap, (load + sizes[k], g))
    return group


def pack(
    docs: DataFrame,
    tokenizer: str,
    tiers: tuple[int, ...] = (128, 256, 512, 1024),
    end_id: int = 0,
    step_tokens: int = 16_384,
) -> DataFrame:
    """One row per piece: doc_id, start and length in the document's tokens, ids (unsigned
    32-bit, little-endian), doc_tokens, sequence_id, offset, tier (the window's size), step_id."""
    ship_package(docs.sparkSession)
    tiers = tuple(sorted(tiers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        base = TaskContext.get().partitionId() << 36
        ids: dict[int, tuple] = {}  # of documents that still have a piece in the pool
        pool: list[tuple] = []
        held = serial = sequence = step = 0
        kind = pa.null()  # of the ids, known with the first batch

        def emit(windows: list[list[tuple]]) -> pa.RecordBatch:
            nonlocal sequence, step
            sizes = [sum(p[0] for p in w) for w in windows]
            groups = step_groups(sizes, step_tokens)
            cols: list[list] = [[] for _ in range(9)]
            for w, size, g in zip(windows, sizes, groups, strict=True):
                at = 0
                for n, key, start in w:
                    doc, tokens = ids[key]
                    row = (doc, start, n, tokens[start : start + n].tobytes(), len(tokens), base + sequence, at, size, base + step + g)
                    for c, v in zip(cols, row, strict=True):
                        c.append(v)
                    at += n
                sequence += 1
            step += max(groups, default=-1) + 1
            types = [kind] + [pa.int64()] * 2 + [pa.binary()] + [pa.int64()] * 3 + [pa.int32(), pa.int64()]
            names = [f.split()[0] for f in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

        for batch in batches:
            kind = batch.column(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tokens = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                ids[serial] = (doc, tokens)
                pool.append((len(tokens), serial, 0))
                held += len(tokens)
                serial += 1
                if held >= FLUSH_TOKENS:
                    windows, pool = fill_windows(pool, tiers)
                    yield emit(windows)
                    ids = {key: ids[key] for _, key, _ in pool}
                    held = sum(p[0] for p in pool)
        windows, pool = fill_windows(pool, tiers)
        windows += powers_of_two(pool)
        if windows:
            yield emit(windows)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA.format(docs.schema["doc_id"].dataType.simpleString()))
