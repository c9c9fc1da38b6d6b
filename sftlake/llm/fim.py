"""Fill-in-middle arrangement of documents with piece tables.

A document is a row of descriptors (buffer, start, stop) over two immutable buffers: its own text
as UTF-8 and the sentinels. Nothing is copied while it is worked on. Cutting splits a descriptor,
an arrangement permutes descriptors, digests stream over them, and the bytes are joined once, for
the output column.

``arrange`` cuts a text of n units (lines with their line feeds) into prefix, middle and suffix at
two of its n + 1 unit borders and arranges them as ``psm`` (<P>prefix<S>suffix<M>middle) or
``spm`` (<S>suffix<P>prefix<M>middle). ``restore`` finds the sentinels in an output, cuts it there
and applies the inverse permutation: the exact text comes back from output and form alone. The
borders and the form are drawn from sha256 of ``seed:doc_id``, so they depend on the row only.

Both are narrow: one pass in each task, no shuffle. Texts are handled in slices of about
``textkit.SLICE_BYTES`` (a text is always whole), so memory follows the longest text.

Results for odd rows: a null or empty text is an empty ``plain`` output with 0 units, and
``restore`` gives an empty text for it. A text that holds a sentinel stays ``plain``, as it could
not be restored; so does one left out by ``rate``. Plain rows have null prefix_chars and
middle_chars. A null doc_id draws as an empty id, rows alike in doc_id and text get like results.
Columns of the table named as one that is added are replaced, all others are kept, and an empty
table gives no rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftlake.llm import textkit
from sftlake.llm.common import ship_package

SENTINELS = ("<P>", "<S>", "<M>")
#: Where each part of an arrangement stands: 0-2 prefix, middle, suffix; 3-5 the sentinels.
ORDERS = {"psm": (3, 0, 4, 2, 5, 1), "spm": (4, 2, 3, 0, 5, 1)}
_MARKS = (3, 4, 5)


class Piece(NamedTuple):
    buffer: int
    start: int
    stop: int


class PieceTable:
    """Descriptors over buffers that never change."""

    def __init__(self, buffers: tuple[bytes, ...], pieces: list[Piece]):
        self.buffers, self.pieces = buffers, pieces

    def cut(self, k: int, at: int) -> None:
        """Split descriptor k in two, ``at`` bytes from its start."""
        b, lo, hi = self.pieces[k]
        if not 0 <= at <= hi - lo:
            raise ValueError("a cut lies inside its piece")
        self.pieces[k : k + 1] = [Piece(b, lo, lo + at), Piece(b, lo + at, hi)]

    def permuted(self, order: tuple[int, ...]) -> PieceTable:
        return PieceTable(self.buffers, [self.pieces[k] for k in order])

    def stream(self) -> Iterator[memoryview]:
        for b, lo, hi in self.pieces:
            if hi > lo:
                yield memoryview(self.buffers[b])[lo:hi]

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for view in self.stream():
            digest.update(view)
        return digest.hexdigest()

    def bytes(self) -> bytes:
        return b"".join(self.stream())


def inverse(order: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(order.index(k) for k in range(len(order)))


def _marks(sentinels: tuple[str, str, str]) -> list[bytes]:
    """The sentinels as bytes. Beside text that holds none of them, they must be found only where
    they were put: none may begin with what another, or it itself, ends with."""
    marks = [s.encode() for s in sentinels]
    for a in marks:
        for b in marks:
            if any(a.endswith(b[:k]) for k in range(1, len(b) + (a is not b))) or (a is not b and b in a):
                raise ValueError("sentinels must not be empty, overlap or hold each other")
    if len(marks) != 3 or not all(marks):
        raise ValueError("three sentinels are needed")
    return marks


def arrange_text(data: bytes, lo: int, hi: int, first: int, second: int, form: str, marks: list[bytes]) -> PieceTable:
    """data[lo:hi] cut at byte offsets first <= second of it, as ``form``."""
    ends = np.cumsum([0, *map(len, marks)])
    table = PieceTable((data, b"".join(marks)), [Piece(0, lo, hi)])
    table.cut(0, first)
    table.cut(1, second - first)
    table.pieces += [Piece(1, int(ends[k]), int(ends[k + 1])) for k in range(3)]
    return table.permuted(ORDERS[form])


def restore_text(data: bytes, lo: int, hi: int, form: str, marks: list[bytes]) -> PieceTable:
    """The pieces of the text that data[lo:hi] was made of; an output that does not have the
    sentinels of its form is an error."""
    if form == "plain":
        return PieceTable((data,), [Piece(0, lo, hi)])
    order = ORDERS[form]
    table = PieceTable((data,), [Piece(0, lo, hi)])
    for k in order:
        if k in _MARKS:
            mark = marks[k - 3]
            b, start, stop = table.pieces[-1]
            at = data.find(mark, start, stop)
            if at < 0:
                raise ValueError(f"no {mark!r} in an output of form {form}")
            table.cut(len(table.pieces) - 1, at - start)
            table.cut(len(table.pieces) - 1, len(mark))
    # Before the first sentinel there is nothing; then sentinels and parts take turns, as in order.
    table.pieces = table.pieces[1:]
    back = table.permuted(inverse(order))
    return PieceTable(back.buffers, back.pieces[:3])


def _mapped(df: DataFrame, text: str, helpers: list[str], added: list[tuple[str, str, pa.DataType]], run) -> DataFrame:
    """``df`` without ``helpers``, with the columns that ``run`` returns for each slice of rows.
    Texts come back as bytes and are strings again in the JVM, so no byte of them is judged."""
    names = [n for n, _, _ in added]
    keep = [c for c in df.columns if c not in helpers]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    schema = ", ".join([*(f"`{c}` {kinds[c].simpleString()}" for c in keep), *(f"`{n}` {k}" for n, k, _ in added)])

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for part in textkit.slices(batch, text):
                new = run(part)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *(pa.array(new[n], t) for n, _, t in added)], [*keep, *names])

    ship_package(df.sparkSession)
    out = df.mapInArrow(batches, schema)
    return out.withColumns({n: F.col(n).cast("string") for n, k, _ in added if k == "binary"})


def arrange(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """All columns, with n_units, prefix_chars, middle_chars (long; code points), form, output and
    output_sha256 (string) added. ``rate`` percent of the texts are arranged, ``spm`` percent of
    those as spm."""
    marks = _marks(sentinels)
    kinds = {"n_units": ("long", pa.int64()), "form": ("string", pa.string()), "prefix_chars": ("long", pa.int64()), "middle_chars": ("long", pa.int64()),
             "output": ("binary", pa.binary()), "output_sha256": ("string", pa.string())}
    docs = docs.drop(*kinds)
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    docs = docs.withColumn("__draw", F.unhex(F.substring(draw, 1, 32)))

    def run(part: pa.RecordBatch) -> dict[str, list]:
        raw, off = textkit.text_buffer(part.column("text"))
        data = raw.tobytes()
        chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # code points before each byte
        feeds = np.flatnonzero(raw == 10) + 1
        out: dict[str, list] = {n: [] for n in kinds}
        for row, draws in enumerate(part.column("__draw")):
            lo, hi = int(off[row]), int(off[row + 1])
            ends = feeds[np.searchsorted(feeds, lo, "right") : np.searchsorted(feeds, hi, "right")]
            if hi > lo and (not len(ends) or ends[-1] != hi):
                ends = np.append(ends, hi)
            n = len(ends)
            h = np.frombuffer(draws.as_py(), ">u4").astype(np.int64)
            if n and h[2] % 100 < rate and not any(data.find(m, lo, hi) >= 0 for m in marks):
                form = "spm" if h[3] % 100 < spm else "psm"
                borders = np.concatenate([[lo], ends])
                first, second = (int(borders[k]) for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
                table = arrange_text(data, lo, hi, first - lo, second - lo, form, marks)
                sizes = int(chars[first] - chars[lo]), int(chars[second] - chars[first])
            else:
                form, sizes, table = "plain", (None, None), PieceTable((data,), [Piece(0, lo, hi)])
            for name, value in zip(kinds, (n, form, *sizes, table.bytes(), table.sha256()), strict=True):
                out[name].append(value)
        return out

    return _mapped(docs, "text", ["__draw"], [(n, k, t) for n, (k, t) in kinds.items()], run)


def restore(arranged: DataFrame, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """All columns, with restored and restored_sha256 (string) added: the text that ``output`` and
    ``form`` were made of."""
    marks = _marks(sentinels)
    kinds = {"restored": ("binary", pa.binary()), "restored_sha256": ("string", pa.string())}
    arranged = arranged.drop(*kinds)

    def run(part: pa.RecordBatch) -> dict[str, list]:
        raw, off = textkit.text_buffer(part.column("output"))
        data = raw.tobytes()
        tables = [restore_text(data, int(lo), int(hi), form or "plain", marks) for lo, hi, form in zip(off[:-1], off[1:], part.column("form").to_pylist(), strict=True)]
        return {"restored": [t.bytes() for t in tables], "restored_sha256": [t.sha256() for t in tables]}

    return _mapped(arranged, "output", [], [(n, k, t) for n, (k, t) in kinds.items()], run)
