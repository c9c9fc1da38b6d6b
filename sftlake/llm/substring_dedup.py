"""Exact substring removal: words under a window of ``WINDOW`` words whose word sequence also
starts anywhere else in the corpus are removed.

Three passes over the texts, none of which moves a text through a shuffle before the last:

1. Count-min sketch. A window is counted by its least 20-gram hash: two equal windows have the
   same least 20-gram, at different places, so the count of selected places never falls short of
   the window's count. Each task counts its places into ``DEPTH`` rows of cells (saturating at
   two); the partition sketches are merged block by block, a task per share of the blocks, into
   the cells that hold two or more. The number of cells follows the bytes of text, counted first,
   so a cell holds ``LOAD`` places at most and a window met once seldom passes, at any size.
2. Exact grouping of the windows whose every cell holds two or more, by a 96-bit hash of the
   window (pre-aggregated, then joined back, so a passage found in a third of all rows is split
   over many tasks). Nothing repeated is lost, as the sketch only overestimates. Up to
   ``BROADCAST_BYTES`` the merged sketch is broadcast as a bitmap; a larger one stays a table of
   cells, the least hashes of each row's windows are looked up in it by one join a row of cells,
   and only what is left goes back to its texts. Both ways let the same windows through.
3. The positions found, one set per row, go back to their texts, and the words are cut.

Rows are told apart by a 64-bit hash of (doc_id, text). Null texts have no words; null ids and
repeated rows count as rows of their own (a repeated row's windows start elsewhere too, so they
go in all copies). Texts shorter than a window are kept whole. Columns beside doc_id are not
returned. An empty table gives no rows."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftlake.llm import textkit
from sftlake.llm.common import checkpointed, ship_package

WINDOW = 35
GRAM = 20
DEPTH = 3
LOAD = 0.25
#: Bytes of text a selected place stands for, at least, in usual text (about 50 in the given tables).
PLACE_BYTES = 32
LEAST_CELLS = 1 << 20  # a multiple of BLOCK
BROADCAST_BYTES = 1 << 26
BLOCK = 1 << 18
_FLUSH = 1 << 21
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _slide(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Minimum or maximum of every ``width`` consecutive values."""
    pick = np.minimum if least else np.maximum
    done = 1
    while done < width:
        step = min(done, width - done)
        x = pick(x[: len(x) - step], x[step:])
        done += step
    return x


def selected(words: textkit.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window starts, least gram hash of each window, hashes of the selected places)."""
    reach = WINDOW - GRAM + 1
    none = np.zeros(0, np.uint64)
    at, _ = words.windows(WINDOW)
    if not len(at):
        return at, none, none
    grams = textkit.window_hash(words.hash, GRAM)
    least = _slide(grams, reach, True)
    inside = np.zeros(len(least), np.uint64)
    inside[at] = least[at]
    # A place is selected when some window over it has its hash as the least.
    pad = np.zeros(reach - 1, np.uint64)
    most = _slide(np.concatenate([pad, inside, pad]), reach, False)
    return at, least[at], grams[(most == grams) & (most > 0)]


def cell_count(texts: DataFrame) -> int:
    """Cells a row of the sketch, a power of two, for the counted bytes of text."""
    n = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return 1 << math.ceil(math.log2(max(LEAST_CELLS, n / (PLACE_BYTES * LOAD))))


def cells(h: np.ndarray, row: int, size: int) -> np.ndarray:
    """The cells of a row; rows follow each other, so a cell's number names its row too."""
    return ((textkit.mix(h + np.uint64(row + 1)) if row else h) & np.uint64(size - 1)) + np.uint64(row * size)


def _partial_sketch(batches: Iterator[pa.RecordBatch], cells_of) -> Iterator[pa.RecordBatch]:
    """Rows (block, once, twice): the cells of a block that this task met once, or more often."""
    held: list[np.ndarray] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        h = np.concatenate(held) if held else np.zeros(0, np.uint64)
        for row in range(DEPTH if len(h) else 0):
            cell, n = np.unique(cells_of(h, row), return_counts=True)
            block = cell // np.uint64(BLOCK)
            first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
            out: list[list] = [[], [], []]
            for a, b in zip(first, [*first[1:], len(cell)], strict=True):
                inner, twice = (cell[a:b] % np.uint64(BLOCK)).astype("<u4"), n[a:b] > 1
                out[0].append(int(block[a]))
                out[1].append(inner[~twice].tobytes())
                out[2].append(inner[twice].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())], ["block", "once", "twice"])

    for batch in batches:
        for part in textkit.slices(batch):
            places = selected(textkit.Words(*textkit.text_buffer(part.column("text"))))[2]
            held.append(places)
            size += len(places)
            if size >= _FLUSH:
                yield from flush()
                held, size = [], 0
    yield from flush()


def _merge_sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the partial sketches, which come block after block, as a stream; the state is one
    block, a byte a cell. Gives each block's bitmap of cells met twice or more."""
    at, n = None, np.zeros(BLOCK, np.uint8)

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([np.packbits(n >= 2).tobytes()], pa.binary())], ["block", "bits"])

    for batch in batches:
        for block, once, twice in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if block != at:
                if at is not None:
                    yield done()
                at, n = block, np.zeros(BLOCK, np.uint8)
            met = np.frombuffer(once, "<u4")
            n[met] = np.minimum(n[met] + 1, 2)
            n[np.frombuffer(twice, "<u4")] = 2
    if at is not None:
        yield done()


def _merged(texts: DataFrame, size: int) -> DataFrame:
    """(block, bits): the merged sketch of ``size`` cells a row."""
    parts = texts.select("text").mapInArrow(lambda b: _partial_sketch(b, lambda h, row: cells(h, row, size)), "block long, once binary, twice binary")
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return parts.repartition(n, "block").sortWithinPartitions("block").mapInArrow(_merge_sketch, "block long, bits binary")


def _bitmap(merged: DataFrame, size: int) -> np.ndarray:
    """The merged sketch as one bitmap of at most ``BROADCAST_BYTES``."""
    bits = np.zeros(DEPTH * size // 8, np.uint8)
    for r in merged.collect():
        at = r["block"] * (BLOCK // 8)
        bits[at : at + BLOCK // 8] = np.frombuffer(r["bits"], np.uint8)
    return bits


def _cell_table(merged: DataFrame) -> DataFrame:
    """(cell) of every cell met twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, bits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                cell = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8))) + block * BLOCK
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int64))], ["cell"])

    return checkpointed(merged.mapInArrow(run, "cell long"))


def _passing(texts: DataFrame, merged: DataFrame, size: int) -> DataFrame:
    """(rk, hs): the least hashes of a row's windows whose every cell is in the table."""

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textkit.slices(batch):
                words = textkit.Words(*textkit.text_buffer(part.column("text")))
                at, h, _ = selected(words)
                doc = words.doc()[at] if len(at) else at
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                rk = np.array(part.column("rk"), np.int64)[doc[new].astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(rk), pa.array(h[new].astype(np.int64))], ["rk", "h"])

    def cell_of(row: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                c = cells(np.array(batch.column("h"), np.int64).astype(np.uint64), row, size)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(c.astype(np.int64))], ["rk", "h", "c"])

        return run

    table = _cell_table(merged)
    left = texts.select("rk", "text").mapInArrow(least, "rk long, h long")
    for row in range(DEPTH):
        named = left.mapInArrow(cell_of(row), "rk long, h long, c long")
        of = table.where(F.col("cell").between(row * size, (row + 1) * size - 1)).hint("shuffle_merge")
        left = named.join(of, F.col("c") == F.col("cell"), "left_semi").select("rk", "h")
    return checkpointed(left.groupBy("rk").agg(F.collect_set("h").alias("hs")))


def _windows(texts: DataFrame, passes) -> DataFrame:
    """(rk, w, vp): every window that passes the sketch. Its 96-bit hash is w and the upper half
    of vp; the lower half is the position of its first word. ``passes`` tells of a slice and its
    windows' least hashes which those are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textkit.slices(batch):
                words = textkit.Words(*textkit.text_buffer(part.column("text")))
                at, least, _ = selected(words)
                at = at[passes(part, least)]
                if not len(at):
                    continue
                doc = words.doc()[at]
                w = textkit.window_hash(words.hash, WINDOW)[at]
                v = textkit.window_hash(textkit.mix(words.hash), WINDOW)[at]
                rk = np.array(part.column("rk"), np.int64)[doc]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rk), pa.array(w.astype(np.int64)), pa.array((v >> np.uint64(32) << np.uint64(32) | (at - words.off[doc]).astype(np.uint64)).astype(np.int64))],
                    ["rk", "w", "vp"],
                )

    return texts.mapInArrow(run, "rk long, w long, vp long")


def candidates(texts: DataFrame) -> DataFrame:
    """(rk, w, vp) of the windows that the sketch estimates repeated."""
    size = cell_count(texts)
    merged = _merged(texts, size)
    if DEPTH * size // 8 <= BROADCAST_BYTES:
        bits = texts.sparkSession.sparkContext.broadcast(_bitmap(merged, size))

        def by_bitmap(_, least: np.ndarray) -> np.ndarray:
            keep, b = np.ones(len(least), bool), bits.value
            for row in range(DEPTH):
                c = cells(least, row, size)
                keep &= (b[c >> np.uint64(3)] >> (np.uint64(7) - (c & np.uint64(7))).astype(np.uint8)) & 1 == 1
            return keep

        return _windows(texts.select("rk", "text"), by_bitmap)
    known = _passing(texts, merged, size).withColumnRenamed("rk", "__rk").hint("shuffle_merge")

    # A hash passes or not wherever it stands, so the hashes of a slice's rows can be put together.
    def by_hashes(part: pa.RecordBatch, least: np.ndarray) -> np.ndarray:
        hs = part.column("hs").flatten()
        return np.isin(least, np.array(hs, np.int64).astype(np.uint64))

    return _windows(texts.join(known, F.col("rk") == F.col("__rk")).select("rk", "text", "hs"), by_hashes)


def repeated_windows(texts: DataFrame) -> DataFrame:
    """(rk, pos) of every window whose sequence starts at two places or more. ``texts`` has rk
    and text. The candidates are computed from the texts for the count and again for the join,
    which is cheaper than keeping them. The repeated hashes are written out first, so that both
    sides of the join are plain shuffles and a hot window is split."""
    found = candidates(texts)
    v = F.shiftright("vp", 32)
    many = found.groupBy("w", v.alias("v")).agg(F.count("*").alias("n")).where("n > 1")
    many = checkpointed(many.select(F.col("w").alias("mw"), F.col("v").alias("mv"))).hint("shuffle_merge")
    hit = found.join(many, (F.col("w") == F.col("mw")) & (v == F.col("mv")), "left_semi")
    return hit.select("rk", F.col("vp").bitwiseAND(F.lit((1 << 31) - 1)).cast("int").alias("pos"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept (the words left, joined by one space)."""
    ship_package(docs.sparkSession)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("rk", F.xxhash64(F.col("doc_id"), F.lit(1), F.col("text")))
    found = repeated_windows(texts.select("rk", "text")).groupBy("rk").agg(F.collect_set("pos").alias("pos"))
    found = found.withColumnRenamed("rk", "__rk")
    joined = texts.join(found.hint("shuffle_merge"), F.col("rk") == F.col("__rk"), "left").select("doc_id", "text", "pos")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textkit.slices(batch):
                total, removed, kept = [], [], []
                for text, pos in zip(part.column("text").cast(pa.large_binary()), part.column("pos"), strict=True):
                    words = _WORD.findall(text.as_py())
                    total.append(len(words))
                    if pos.is_valid:
                        edge = np.zeros(len(words) + 1, np.int32)
                        p = np.array(pos.values)
                        edge[p] += 1
                        edge[p + WINDOW] -= 1
                        words = [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
                    removed.append(total[-1] - len(words))
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "n_removed", "kept"],
                )

    return joined.mapInArrow(cut, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_removed long, kept string")
