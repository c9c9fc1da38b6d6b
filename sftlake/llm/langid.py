"""Language identification by prediction by partial matching.

Each language has a byte context tree of order ``ORDER``: for every context of up to ORDER
bytes, how often each byte followed. A text's code length under a tree is exact for the frozen
counts: from the longest context that was seen, an unseen byte pays an escape (method C) and
goes on with the next shorter context, whose bytes known to the longer one are excluded; a byte
never seen is coded among the other byte values alike. The language with the shortest code wins.

Trees are fitted on about ``FIT_DOCS`` documents of each language (all when there are fewer);
their size is bounded by that sample, and they go to the tasks as one broadcast of at most
``MAX_GRAMS`` rows a language. Scoring reads every whole text: the code length is a sum over the
text's distinct (context, byte) pairs, counted by sorting, so a task's memory is bounded by a
slice of texts or the longest text.

Null texts and texts without a letter get ``und`` with score 0. Null ids, repeated rows and ties
are kept (equal code lengths: the first language in name order). Without any labelled text every
text is ``und``. Only doc_id, the prediction and the columns named in ``keep`` are returned."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftlake.llm import textkit
from sftlake.llm.common import ship_package, spread

ORDER = 3
FIT_DOCS = 3_000
MAX_GRAMS = 2_000_000
_PAD = 10  # every text is coded as if newlines stood before it


def grams(data: np.ndarray, off: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, gram, count), gram = the order bytes before a position and its byte, packed."""
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    padded = np.full(len(data) + order * (len(off) - 1), _PAD, np.uint64)
    at = np.arange(len(data)) + order * (doc + 1)
    padded[at] = data
    key = doc.astype(np.uint64)
    for k in range(order, -1, -1):
        key = (key << np.uint64(8)) | padded[at - k]
    key.sort()
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(key)))
    bits = np.uint64(8 * (order + 1))
    key = key[first]
    return (key >> bits).astype(np.int64), key & np.uint64((1 << int(bits)) - 1), count


class ContextTree:
    """Counts of one language by order, as sorted arrays, and exact code lengths from them."""

    def __init__(self, gram: np.ndarray, count: np.ndarray, order: int = ORDER):
        self.order = order
        self.keys, self.counts, self.ctx, self.total, self.distinct, self.below = [], [], [], [], [], []
        for j in range(order + 1):
            mask = np.uint64((1 << (8 * (j + 1))) - 1)
            key, inverse = np.unique(gram & mask, return_inverse=True)
            cnt = np.bincount(inverse, weights=count, minlength=len(key))
            ctx, inv = np.unique(key >> np.uint64(8), return_inverse=True)
            self.keys.append(key)
            self.counts.append(cnt)
            self.ctx.append(ctx)
            self.total.append(np.bincount(inv, weights=cnt, minlength=len(ctx)))
            self.distinct.append(np.bincount(inv, minlength=len(ctx)).astype(float))
            # Counts that the next shorter context has for the bytes known to this one.
            if j:
                shorter = self.counts[j - 1][np.searchsorted(self.keys[j - 1], key & np.uint64((1 << (8 * j)) - 1))]
                self.below.append(np.bincount(inv, weights=shorter, minlength=len(ctx)))
            else:
                self.below.append(np.zeros(len(ctx)))

    @staticmethod
    def _find(keys: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, q), len(keys) - 1)
        return at, keys[at] == q

    def bits(self, gram: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each gram after the bytes before it."""
        cost = np.zeros(len(gram))
        open_ = np.arange(len(gram))
        gone_t, gone_d = np.zeros(len(gram)), np.zeros(len(gram))  # excluded at this order
        for j in range(self.order, -1, -1):
            q = gram[open_] & np.uint64((1 << (8 * (j + 1))) - 1)
            c, seen = self._find(self.ctx[j], q >> np.uint64(8))
            t, d = self.total[j][c] - gone_t[open_], self.distinct[j][c] - gone_d[open_]
            k, hit = self._find(self.keys[j], q)
            hit &= seen
            with np.errstate(divide="ignore", invalid="ignore"):
                cost[open_[hit]] -= np.log2(self.counts[j][k[hit]] / (t + d)[hit])
                esc = seen & ~hit & (d > 0)
                cost[open_[esc]] -= np.log2((d / (t + d))[esc])
            gone_t[open_] = np.where(seen, self.below[j][c], 0)
            gone_d[open_] = np.where(seen, self.distinct[j][c], 0)
            open_ = open_[~hit]
            if not len(open_):
                return cost
        cost[open_] += np.log2(256 - self.distinct[0][0])
        return cost


def fit(labelled: DataFrame, fit_docs: int = FIT_DOCS, order: int = ORDER) -> dict[str, ContextTree]:
    """A tree for each language of ``labelled`` (text, lang, doc_id; null lang or text unused)."""
    ship_package(labelled.sparkSession)
    known = labelled.select("doc_id", "text", "lang").where("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return {}
    rate = F.lit(1.0)
    for lang, n in sorted(sizes.items()):
        rate = F.when(F.col("lang") == lang, F.lit(min(1.0, fit_docs / n))).otherwise(rate)
    chosen = known.where(spread("doc_id") < rate).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in textkit.slices(batch, "text"):
                langs = np.array(part.column(0).to_pylist(), object)
                doc, gram, n = grams(*textkit.text_buffer(part.column(1)), order)
                for lang in set(langs):
                    own = langs[doc] == lang
                    key, inv = np.unique(gram[own], return_inverse=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(key)), pa.array(key.astype(np.int64)), pa.array(np.bincount(inv, weights=n[own], minlength=len(key)).astype(np.int64))],
                        ["lang", "gram", "n"],
                    )

    table = chosen.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).collect()
    if len(table) > MAX_GRAMS * len(sizes):
        raise ValueError("the sample has more grams than the trees may hold; lower fit_docs")
    trees = {}
    for lang in sorted(sizes):
        rows = sorted((r["gram"], r["n"]) for r in table if r["lang"] == lang)
        if rows:
            g, n = zip(*rows, strict=True)
            trees[lang] = ContextTree(np.array(g, np.uint64), np.array(n, float), order)
    return trees


def identify(docs: DataFrame, trees: dict[str, ContextTree], keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns in ``keep``, lang_pred, score (the winner's posterior under equal
    priors) and bits_per_byte (the winner's code length)."""
    spark = docs.sparkSession
    ship_package(spark)
    held = spark.sparkContext.broadcast(trees)
    given = [c for c in ("doc_id", *keep) if c not in ("lang_pred", "score", "bits_per_byte")]
    source = docs.select(*given, F.coalesce(F.col("text"), F.lit("")).alias("__t"))
    source = source.withColumn("__l", F.col("__t").rlike(r"\p{L}"))
    schema = source.drop("__t", "__l").schema.add("lang_pred", "string").add("score", "double").add("bits_per_byte", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = held.value
        names = list(trees)
        for batch in batches:
            for part in textkit.slices(batch, "__t"):
                data, off = textkit.text_buffer(part.column("__t"))
                doc, gram, n = grams(data, off, next(iter(trees.values())).order if trees else ORDER)
                key, inv = np.unique(gram, return_inverse=True)
                size = len(off) - 1
                bits = np.array([np.bincount(doc, weights=trees[x].bits(key)[inv] * n, minlength=size) for x in names]).reshape(len(names), size)
                letter = np.array(part.column("__l").to_pylist(), bool) & bool(names)
                if names:
                    best = bits.argmin(0)
                    low = bits.min(0)
                    post = 1 / np.exp2(np.maximum(low - bits, -1000)).sum(0)
                    pred = np.where(letter, np.array(names, object)[best], "und")
                else:
                    low, post, pred = np.zeros(size), np.zeros(size), np.full(size, "und", object)
                cols = [part.column(c) for c in given]
                cols += [pa.array(pred.tolist(), pa.string()), pa.array(np.where(letter, post, 0.0)), pa.array(low / np.maximum(np.diff(off), 1))]
                yield pa.RecordBatch.from_arrays(cols, [*given, "lang_pred", "score", "bits_per_byte"])

    return source.mapInArrow(run, schema)
