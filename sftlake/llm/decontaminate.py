"""Benchmark decontamination: passages of documents within a few word edits of a benchmark item.

Words are runs of letters and digits, lower-cased. The CGK embedding walks over a word sequence:
in each step it writes the word it stands on, and a random bit of (step, word) says whether it
moves on. Two sequences at a small edit distance fall into step again after each edit, so their
embeddings differ in few places. A table samples ``SAMPLED`` steps; items are filed under what
they wrote there, and every window of the documents that writes the same meets the item. The
number of tables is set by measurement: items with as many random edits as are allowed must be
met at ``RECALL`` or better, or building the tables fails.

The chance that a table meets an edited item falls with its length. So an item of more than
``PIECE_WORDS`` words is looked for by its pieces: of equal pieces, one at least holds no more
edits than its own share, or the item would hold more than are allowed. A met piece leads to the
stretch where the whole item would stand, and only that is verified.

Windows are piece-sized: pieces are grouped by size, and every word of every text starts a window
of each group's size. A window with more words outside its group's vocabulary than edits are
allowed cannot match (each edit brings one such word at most) and isn't walked; that bound loses
nothing. What meets is verified exactly, by bit-parallel edit distance over words around the
window; an item leaks into a text when the distance is at most ``RATE`` of its words.

One pass over the documents for each ``PIECES_A_PASS`` pieces (whose tables are the bounded
broadcast); no shuffle. Items of fewer than ``MIN_WORDS`` words may hold no edit: they are
looked up by the hash of their words. Null and empty texts hold nothing; items without words or
text are in none; null ids, equal items and repeated rows are all reported. Without items, or documents, there are no leaks. All columns pass through."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftlake.llm import textkit
from sftlake.llm.common import ship_package

RATE = 0.2
RECALL = 0.95
SAMPLED = 3
MAX_TABLES = 400  # tables that don't reach RECALL by then are an error
MIN_WORDS = 5  # shorter items may hold no edit and are looked up exactly
MEASURED = 400  # edited pieces of a size group that its recall is measured on
PIECE_WORDS = 64
GROWTH = 1.35
PIECES_A_PASS = 20_000
LEAK = "array<struct<item_id:{0},distance:int,item_words:int,first_word:int,last_word:int>>"
_APART = np.ones(256, bool)
_APART[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_VOCABULARY_BITS = 22


def words_of(col: pa.Array) -> textkit.Words:
    return textkit.Words(*textkit.text_buffer(pc.utf8_lower(col.cast(pa.large_string()).fill_null(""))), apart=_APART)


def allowed(n: int) -> int:
    return int(RATE * n)


class Walk:
    """Random bits and sampled steps of one table, for sequences of at least ``size`` words."""

    def __init__(self, size: int, seed: int):
        rng = np.random.default_rng([size, seed])
        steps = max(SAMPLED, int(1.6 * size))  # a walk of 2 n steps passes n words on average
        self.sample = np.sort(rng.choice(steps, SAMPLED, replace=False))
        self.odd = rng.integers(0, 1 << 63, steps, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def keys(self, h: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        """What the walks from positions ``at`` write at the sampled steps. ``h`` has a zero
        after its last word; a walk at its sequence's ``end`` writes a blank."""
        key = np.zeros(len(at), np.uint64)
        at = at.copy()
        blank = len(h) - 1
        for j in range(int(self.sample[-1]) + 1):
            word = h[np.where(at < end, at, blank)]
            if j in self.sample:
                key = textkit.mix(key + word)
            at += ((word * self.odd[j]) >> np.uint64(63)).astype(np.int64)
        return key


def pieces(n: int) -> list[tuple[int, int]]:
    """(first word, end) of the pieces of an item of n words, alike in size."""
    p = -(-n // PIECE_WORDS)
    return [(k * n // p, (k + 1) * n // p) for k in range(p)]


class Group:
    """The pieces of one size group (least to most words) with their tables."""

    def __init__(self, items: list[np.ndarray], ids: list[int], least: int, most: int):
        self.least, self.edits = least, allowed(most)
        self.vocabulary = np.zeros(1 << _VOCABULARY_BITS, bool)
        for w in items:
            self.vocabulary[w & np.uint64((1 << _VOCABULARY_BITS) - 1)] = True
        h, at, end = _joined(items)
        rng = np.random.default_rng(len(items))
        # Recall is measured on pieces drawn at random, each at least once where there are few.
        own = rng.permutation(np.arange(len(items) * (1 + MEASURED // (2 * len(items)))) % len(items))[:MEASURED]
        changed = [_edited(items[k], allowed(len(items[k])), rng) for k in own]
        ch, cat, cend = _joined(changed)
        missed = np.ones(len(changed), bool)
        self.tables: list[tuple[Walk, np.ndarray, np.ndarray]] = []
        for seed in range(MAX_TABLES):
            walk = Walk(least, seed)
            keys = walk.keys(h, at, end)
            missed &= walk.keys(ch, cat, cend) != keys[own]
            order = np.argsort(keys, kind="stable")
            self.tables.append((walk, keys[order], np.array(ids)[order]))
            self.recall = 1 - missed.mean()
            if self.recall >= RECALL:
                break
        else:
            raise RuntimeError(f"{MAX_TABLES} tables meet only {self.recall:.3f} of the edited pieces of {least} to {most} words, not {RECALL}")

    def meet(self, words: textkit.Words, h: np.ndarray, starts: np.ndarray, end: np.ndarray) -> set[tuple[int, int]]:
        """(window start, piece) of every window that writes what a piece writes in some table."""
        strange = np.concatenate([[0], np.cumsum(~self.vocabulary[words.hash & np.uint64((1 << _VOCABULARY_BITS) - 1)], dtype=np.int32)])
        stop = np.minimum(starts + self.least, end)
        at = np.flatnonzero(strange[stop] - strange[starts] + (starts + self.least - stop) <= self.edits)
        found: set[tuple[int, int]] = set()
        if not len(at):
            return found
        for walk, keys, ids in self.tables:
            k = walk.keys(h, at, end[at])
            lo, hi = np.searchsorted(keys, k, "left"), np.searchsorted(keys, k, "right")
            for w in np.flatnonzero(hi > lo):
                found.update((int(at[w]), int(i)) for i in ids[lo[w] : hi[w]])
        return found


def _joined(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.array([len(s) for s in seqs])
    end = np.cumsum(size)
    return np.concatenate([*seqs, np.zeros(1, np.uint64)]), end - size, end


def _edited(w: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    out = list(w)
    for kind in rng.integers(0, 3, k):
        at = int(rng.integers(len(out)))
        new = np.uint64(rng.integers(1, 1 << 63))
        if kind == 0:
            out[at] = new
        elif kind == 1:
            out.insert(at, new)
        else:
            del out[at]
    return np.array(out, np.uint64)


def distances(item: list[int], text: list[int], anchored: bool = False) -> list[int]:
    """Least edits between the item and a stretch of the text that ends after each word; the
    stretch may start anywhere, or at the text's start if ``anchored``. One word of bits holds a
    whole column of differences."""
    n = len(item)
    full, last = (1 << n) - 1, 1 << (n - 1)
    place: dict[int, int] = {}
    for k, w in enumerate(item):
        place[w] = place.get(w, 0) | 1 << k
    up, down, score, out = full, 0, n, []
    for w in text:
        same = place.get(w, 0)
        flat = (((same & up) + up) ^ up) | same | down
        right = down | ~(flat | up) & full
        left = flat & up
        score += bool(right & last) - bool(left & last)
        right = (right << 1 | anchored) & full
        left = left << 1 & full
        up = (left | ~(flat | right)) & full
        down = right & flat & full
        out.append(score)
    return out


class Index:
    """Pieces of items by size group. Built on the driver from the items of one pass."""

    def __init__(self, items: list[np.ndarray]):
        self.items = items
        self.groups: list[Group] = []
        self.pieces = [(k, a, b) for k, w in enumerate(items) if len(w) >= MIN_WORDS for a, b in pieces(len(w))]
        size = {j: b - a for j, (_, a, b) in enumerate(self.pieces)}
        least = MIN_WORDS
        while size and least <= max(size.values()):
            most = max(least, int(GROWTH * least))
            ids = [j for j, n in size.items() if least <= n <= most]
            if ids:
                self.groups.append(Group([items[k][a:b] for k, a, b in (self.pieces[j] for j in ids)], ids, least, most))
            least = most + 1
        self.short: dict[int, dict[int, list[int]]] = {}  # words: hash of the sequence: items
        for k, w in enumerate(items):
            if 0 < len(w) < MIN_WORDS:
                self.short.setdefault(len(w), {}).setdefault(int(textkit.window_hash(w, len(w))[0]), []).append(k)

    def leaks(self, words: textkit.Words) -> dict[int, dict[int, tuple[int, int, int]]]:
        """By text: by item: (distance, first word, last word) of the best passage."""
        out: dict[int, dict[int, tuple[int, int, int]]] = {}
        doc = words.doc()
        starts, end = np.arange(len(doc)), words.off[1:][doc]
        h = np.append(words.hash, np.uint64(0))
        tried: set[tuple[int, int, int]] = set()
        for n, held in self.short.items():
            at, keys = words.windows(n)
            for j in np.flatnonzero(np.isin(keys, np.array(list(held), np.uint64))):
                d = int(doc[at[j]])
                first = int(at[j] - words.off[d])
                for k in held[int(keys[j])]:
                    out.setdefault(d, {}).setdefault(k, (0, first, first + n - 1))
        for group in self.groups:
            for met, j in sorted(group.meet(words, h, starts, end)):
                k, before, _ = self.pieces[j]
                item = self.items[k].tolist()
                slack = allowed(len(item)) + 1
                d = int(doc[met])
                at = met - before  # where the item starts, up to the edits before the piece
                spot = (d, k, at // slack)  # windows that close look at the same stretch
                if spot in tried:
                    continue
                tried.add(spot)
                lo = max(int(words.off[d]), at // slack * slack - 2 * slack)
                text = words.hash[lo : min(int(words.off[d + 1]), at + len(item) + 3 * slack)].tolist()
                cost = distances(item, text)
                best = min(cost)
                if best > allowed(len(item)) or best >= out.get(d, {}).get(k, (1 << 30,))[0]:
                    continue
                to = cost.index(best)
                back = distances(item[::-1], text[: to + 1][::-1], anchored=True)
                first = to - back.index(min(back))
                base = lo - int(words.off[d])
                out.setdefault(d, {})[k] = (best, base + first, base + to)
        return out


def _passes(items: DataFrame) -> Iterator[list]:
    """The items' (id, text) in blocks of about PIECES_A_PASS pieces; one block at a time is on the driver."""
    block: list = []
    held = 0
    for r in items.select("item_id", "text").where("text is not null").toLocalIterator():
        block.append(r)
        held += 1 + len(r["text"].split()) // PIECE_WORDS
        if held >= PIECES_A_PASS:
            yield block
            block, held = [], 0
    if block:
        yield block


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """All columns of ``docs`` (with text) and ``leaks``: for every item found in the text, its
    id, the distance, its size, and the passage's first and last word."""
    spark = docs.sparkSession
    ship_package(spark)
    id_type = items.schema["item_id"].dataType.simpleString()
    out = docs.drop("leaks").withColumn("leaks", F.array().cast(LEAK.format(id_type)))
    for block in _passes(items):
        block.sort(key=lambda r: (r["text"], str(r["item_id"])))
        w = words_of(pa.array([r["text"] for r in block], pa.string()))
        index = Index([w.hash[a:b] for a, b in zip(w.off[:-1], w.off[1:], strict=True)])
        held = spark.sparkContext.broadcast((index, [r["item_id"] for r in block]))
        out = _one_pass(out, held)
    return out


def _one_pass(docs: DataFrame, held) -> DataFrame:
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, ids = held.value
        for batch in batches:
            for part in textkit.slices(batch):
                words = words_of(part.column("text"))
                new = index.leaks(words)
                column = part.column("leaks")
                if new:
                    rows = column.to_pylist()
                    for d, by in new.items():
                        rows[d] = rows[d] + [
                            {"item_id": ids[k], "distance": e, "item_words": len(index.items[k]), "first_word": a, "last_word": b} for k, (e, a, b) in sorted(by.items())
                        ]
                    column = pa.array(rows, column.type)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names[:-1]), column], schema=part.schema)

    return docs.mapInArrow(run, docs.schema)
