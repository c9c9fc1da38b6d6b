"""MinHash near-duplicate classes by one-permutation hashing with optimal densification.

A document's set holds its distinct 5-word shingles (A-Z lower-cased; with fewer words, the whole
sequence). One hash of every shingle fills ``BANDS * ROWS`` bins, each with its least value; the
sketch takes one pass over the set however many bins there are. An empty bin borrows the value of
another, found along its own fixed random order of the bins, so two sets borrow independently for
each bin and agree in a bin with a probability of their similarity (optimal densification). Each
band of ROWS bins is one bucket key. At 85 % similarity two sets miss each other in all bands with
a probability of 2.6e-7, at 90 % of 3e-11.

Equal sets are one class from the start, so a group of exact copies is a single set, and buckets
hold classes. Candidate edges are stars: in each bucket every class is compared with the bucket's
hub, not with each other. What a hub is not linked to names a hub of its own in the next round,
until every class outside its bucket's largest linked class has been one
(``grouping.linked_classes``); so no link between classes that share a bucket is lost, and a
bucket of n copies costs n - 1 pairs. Each pair is confirmed on the full sets:
100 * intersection >= percent * union.

Before a pair is named, its sizes and parities must leave room for the link: bit i of the
``PARITY_BITS`` parities says whether an odd number of a set's hashes fall into residue i, so the
bits in which two sets differ are no more than the elements that one alone holds.

The sketches move (32 keys a class); sets are built again only for classes that share a bucket,
from one text each. The hashes of those texts are broadcast up to ``BROADCAST_TEXTS`` of them,
else joined. Shingles, sets and texts are told apart by 64-bit hashes.

Null, empty and wordless texts have the empty set and are a class by themselves, with their own
doc_id. Null ids are ignored when the smallest id of a class is taken; in a class of null ids alone
component_id is null and all are kept. Rows alike in doc_id and text are linked; both are kept if
their id is the class's. Very long texts are whole in one task's slice. Columns beside doc_id
are not returned; an empty table gives no rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftlake.llm import textkit
from sftlake.llm.common import checkpointed, ship_package
from sftlake.llm.grouping import linked_classes

GRAM = 5
ROWS = 6
BANDS = 32
BINS = ROWS * BANDS
PERCENT = 85
BROADCAST_TEXTS = 1_000_000  # hashes of 8 bytes
PARITY_BITS = 256
_SEEN = 200_000
_EDGES = (np.arange(1, BINS, dtype=np.uint64) * np.uint64((1 << 64) // BINS)).astype(np.uint64)
_rng = np.random.default_rng(20_17)
#: For each bin, all bins in an order of its own.
_DETOURS = np.argsort(_rng.random((BINS, BINS)), axis=1)
_ODD = _rng.integers(1, 1 << 62, (2, BINS), dtype=np.uint64) | np.uint64(1)


def shingle_sets(col: pa.Array) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text."""
    words = textkit.Words(*textkit.text_buffer(col), lower=True)
    at, h = words.windows(GRAM)
    first = np.searchsorted(at, words.off)
    for k in range(len(words.off) - 1):
        n = int(words.off[k + 1] - words.off[k])
        if n >= GRAM:
            yield np.unique(h[first[k] : first[k + 1]])
        else:
            yield textkit.window_hash(words.hash[words.off[k] : words.off[k + 1]], n) if n else np.zeros(0, np.uint64)


def sketch(s: np.ndarray) -> np.ndarray:
    """The least hash in each bin of a set that is not empty; empty bins borrow."""
    h = np.sort(textkit.mix(s + np.uint64(0x632BE59BD9B4E019)))
    first = np.concatenate([[0], np.searchsorted(h, _EDGES)])
    held = np.append(first[1:], len(h)) > first
    out = h[np.minimum(first, len(h) - 1)]
    if not held.all():
        empty = np.flatnonzero(~held)
        detours = _DETOURS[empty]
        out[empty] = out[detours[np.arange(len(empty)), held[detours].argmax(axis=1)]]
    return out


def band_keys(s: np.ndarray) -> np.ndarray:
    x = textkit.mix(sketch(s) * _ODD[0] + _ODD[1])  # another function of the value for each bin
    return textkit.mix(x.reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64)).view(np.int64)


def parities(s: np.ndarray) -> np.ndarray:
    """PARITY_BITS bits as 64-bit integers."""
    odd = np.bincount((s & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def class_of(s: np.ndarray) -> int:
    """A 64-bit name of a set that is not empty."""
    spread = textkit.mix(s ^ np.uint64(0xA0761D6478BD642F))
    return int(textkit.mix(np.array([spread.sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64)).view(np.int64)[0])


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n, id, th, keys, odd): size and class of each row's set, a hash of its text, and the
    band keys and parities, given once a class in most tasks."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in textkit.slices(batch):
                sizes, ids, keys, odd = [], [], [], []
                for s in shingle_sets(part.column("text")):
                    c = class_of(s) if len(s) else None
                    new = c is not None and c not in seen
                    sizes.append(len(s))
                    ids.append(c)
                    keys.append(band_keys(s) if new else None)
                    odd.append(parities(s) if new else None)
                    if c is not None and len(seen) < _SEEN:
                        seen.add(c)
                cols = [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), part.column("th"), *(pa.array(x, pa.list_(pa.int64())) for x in (keys, odd))]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n", "id", "th", "keys", "odd"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("th")).mapInArrow(run, f"doc_id {kind}, n long, id long, th long, keys array<long>, odd array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, s): the whole set of every class, from the texts whose hash (th) is wanted."""
    if wanted.count() <= BROADCAST_TEXTS:
        wanted = F.broadcast(wanted)
    texts = docs.select("text", F.xxhash64("text").alias("th")).join(wanted, "th", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in textkit.slices(batch):
                ids, found = [], []
                for s in shingle_sets(part.column("text")):
                    if len(s) and (c := class_of(s)) not in seen:
                        if len(seen) < _SEEN:
                            seen.add(c)
                        ids.append(c)
                        found.append(s.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.list_(pa.int64()))], ["id", "s"])

    return texts.select("text").mapInArrow(run, "id long, s array<long>").groupBy("id").agg(F.first("s").alias("s"))


def linked_sets(docs: DataFrame, table: DataFrame, percent: int) -> DataFrame:
    """(id, comp) of the classes of equal sets that are linked with another class."""
    firsts = [F.min("th").alias("th"), F.first("n").alias("n"), *(F.first(c, True).alias(c) for c in ("keys", "odd"))]
    classes = checkpointed(table.where("id is not null").groupBy("id").agg(*firsts))
    keys = checkpointed(classes.select("id", F.explode("keys").alias("k")))
    held = keys.groupBy("k").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo != hi").select("k")
    # Written, so that both sides of the join are plain shuffles and a hot key can be split.
    members = checkpointed(keys.join(checkpointed(held).hint("shuffle_merge"), "k", "left_semi"))
    marks = classes.join(checkpointed(members.select("id").distinct()), "id", "left_semi")
    marks = checkpointed(marks.select("id", "th", F.struct("n", *(F.get("odd", F.lit(i)).alias(f"o{i}") for i in range(PARITY_BITS // 64))).alias("x")))
    sets = checkpointed(full_sets(docs, marks.select("th").distinct()))

    def verify(pairs: DataFrame) -> DataFrame:
        """The hub's set goes to each of its candidates; a hot hub's rows are split by the join."""
        other = F.when(F.col("lead") == F.col("a"), F.col("b")).otherwise(F.col("a"))
        stars = pairs.select("lead", other.alias("id"))
        hubs = sets.select(F.col("id").alias("lead"), F.col("s").alias("hub"))
        both = stars.join(hubs, "lead").join(sets, "id")
        common = F.size(F.array_intersect("hub", "s"))
        linked = both.select("lead", "id", common.alias("i"), (F.size("hub") + F.size("s")).alias("both")).where(f"100 * i >= {percent} * (both - i)")
        return linked.select(F.least("lead", "id").alias("a"), F.greatest("lead", "id").alias("b"))

    def fits(a: Column, b: Column) -> Column:
        """100 i >= percent u, with i + u the sum of both sizes and u - i >= the bits that differ."""
        differ = sum((F.bit_count(a[f"o{i}"].bitwiseXOR(b[f"o{i}"])) for i in range(PARITY_BITS // 64)), F.lit(0))
        sizes = 100 * F.least(a["n"], b["n"]) >= percent * F.greatest(a["n"], b["n"])
        return sizes & ((100 + percent) * differ <= (100 - percent) * (a["n"] + b["n"]))

    return linked_classes(members.join(marks.select("id", "x"), "id"), verify, fits, leaders=1, growth=16)


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest doc_id reachable by links of at
    least ``percent``), kept (whether the row has that id). The bands are laid out for 85 % and
    more; a lower threshold would miss links, so it is an error."""
    if not PERCENT <= percent <= 100:
        raise ValueError(f"{BANDS} bands of {ROWS} rows are laid out for {PERCENT} percent or more")
    ship_package(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    table = checkpointed(sketches(docs))
    comps = linked_sets(docs, table, percent).withColumnRenamed("id", "i")
    known = table.where("id is not null").groupBy("id").agg(F.min("doc_id").alias("least"))
    known = checkpointed(known.join(comps, F.col("id") == F.col("i"), "left").select("id", "least", F.coalesce("comp", "id").alias("comp")))
    least = known.groupBy("comp").agg(F.min("least").alias("component_id"))
    names = known.select("id", "comp").join(least, "comp").select(F.col("id").alias("i"), "component_id")
    out = table.select("doc_id", "n", "id").join(names.hint("shuffle_merge"), F.col("id") == F.col("i"), "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
