"""Near-duplicate overlap between two splits by Jaccard similarity of 5-word shingles.

Texts with equal shingle sets are one class, so copies are compared once. Of two sets that reach
the threshold each holds at least 75 of 100 of its shingles together with the other, so classes of
the larger split keep only shingles that the other split has, and classes left with too few
go; then the same the other way round. What is left is ordered by how many classes hold a shingle (rare
first, exact counts), and two sets that reach the threshold share an element of their prefixes
(n - ceil(0.75 n) + 1 elements); rare elements rarely meet, and shingles of a passage that many
texts share lie behind the prefix. What meets is checked exactly. Shingles are hashed once a text,
by Arrow batches; everything else is a join or a partial aggregate, and a hot element's join is
split by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftlake.functions.shingles import set_hash, shingle_sets, slices
from sftlake.session import ship_package
from sftlake.sources.scratch import checkpointed

SHINGLE = 5
PERCENT = 75


def shingle_rows(split_df: DataFrame, text: Column, key: str = "row_id", side: str = "test", other: str = "train") -> DataFrame:
    """split, key, c, s of every row of the two splits, written: the sorted distinct hashes of the
    5-word shingles (lower case; fewer words are one shingle) and a hash of that set; both null
    for a text without words."""
    rows = split_df.where(F.col("split").isin(side, other)).select("split", key, F.lower(text).alias("text"))
    ship_package(split_df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [s if len(s) else None for s in shingle_sets(part.column("text"), SHINGLE)]
                c = pa.array([None if s is None else set_hash(s) for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("split"), part.column(key), c, pa.array(sets, pa.list_(pa.int64()))], ["split", key, "c", "s"])

    kind = rows.schema[key].dataType.simpleString()
    return checkpointed(rows.mapInArrow(run, f"split string, `{key}` {kind}, c long, s array<long>"))


def _enough(held: DataFrame) -> DataFrame:
    """``held`` (c, n, g) without the classes that hold too few shingles to be linked."""
    held = checkpointed(held)
    many = held.groupBy("c", "n").agg(F.count(F.lit(1)).alias("k")).where(100 * F.col("k") >= PERCENT * F.col("n"))
    return checkpointed(held.join(many.select("c"), "c", "left_semi"))


def near_overlap(split_df: DataFrame, text: Column, key: str = "row_id", side: str = "test", other: str = "train", rows: DataFrame | None = None) -> DataFrame:
    """test_id, train_id, jaccard for every pair of classes across the two splits that reaches
    the threshold; a class is named by its smallest key in that split. ``rows``: what
    ``shingle_rows`` made of the same arguments, where it is at hand."""
    rows = shingle_rows(split_df, text, key, side, other) if rows is None else rows
    rows = rows.where("c is not null")
    classes = checkpointed(rows.groupBy("split", "c").agg(F.min(key).alias("id"), F.first("s").alias("s")))
    held = classes.select("split", "c", F.size("s").alias("n"), F.explode("s").alias("g"))
    a, b = (held.where(F.col("split") == s).drop("split") for s in (side, other))
    # A shingle of one split alone links nothing.
    b = _enough(b.join(a.select("g").distinct().hint("shuffle_hash"), "g", "left_semi"))
    a = _enough(a.join(b.select("g").distinct(), "g", "left_semi"))
    held = a.withColumn("split", F.lit(side)).unionByName(b.withColumn("split", F.lit(other)))
    ranked = held.join(held.groupBy("g").agg(F.count(F.lit(1)).alias("df")), "g")
    known = ranked.groupBy("split", "c", "n").agg(F.array_sort(F.collect_list(F.struct("df", "g"))).alias("r"))
    # The shingles of one split alone come first in the order: they use up the prefix without being in it.
    places = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1 - (F.col("n") - F.size("r"))
    prefix = known.where(places > 0).select("split", "c", "n", F.explode(F.slice("r", 1, places.cast("int"))["g"]).alias("g"))
    a = prefix.where(F.col("split") == side).select("g", F.col("c").alias("ca"), F.col("n").alias("na"))
    b = prefix.where(F.col("split") == other).select("g", F.col("c").alias("cb"), F.col("n").alias("nb"))
    fits = (100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb"))
    pairs = a.join(b, "g").where(fits).select("ca", "cb").distinct()
    x = classes.where(F.col("split") == side).select(F.col("c").alias("ca"), F.col("id").alias("test_id"), F.col("s").alias("sa"))
    y = classes.where(F.col("split") == other).select(F.col("c").alias("cb"), F.col("id").alias("train_id"), F.col("s").alias("sb"))
    both = pairs.join(x, "ca").join(y, "cb").withColumn("i", F.size(F.array_intersect("sa", "sb")))
    whole = F.size("sa") + F.size("sb") - F.col("i")
    return both.where(100 * F.col("i") >= PERCENT * whole).select("test_id", "train_id", (F.col("i") / whole).alias("jaccard"))


def overlap_links(split_df: DataFrame, text: Column, pairs: DataFrame, key: str = "row_id", side: str = "test", other: str = "train", rows: DataFrame | None = None) -> DataFrame:
    """split, key, class_id, links for every row of the two splits: its class (the smallest key
    with the same shingles in its split; a row without words is its own) and how many rows of the
    other split are linked to it by ``pairs`` of ``near_overlap``, copies counted. Links are
    counted by class with partial aggregates, so the result has a row a text however many
    near copies meet."""
    rows = (shingle_rows(split_df, text, key, side, other) if rows is None else rows).select("split", key, "c")
    sizes = rows.where(F.col("c").isNotNull()).groupBy("split", "c").agg(F.min(key).alias("class_id"), F.count(F.lit(1)).alias("copies"))
    sizes, pairs = checkpointed(sizes), checkpointed(pairs)
    one = pairs.select(F.lit(side).alias("split"), F.col("test_id").alias("class_id"), F.lit(other).alias("at"), F.col("train_id").alias("to"))
    two = pairs.select(F.lit(other).alias("split"), F.col("train_id").alias("class_id"), F.lit(side).alias("at"), F.col("test_id").alias("to"))
    far = sizes.select(F.col("split").alias("at"), F.col("class_id").alias("to"), "copies")
    links = one.unionByName(two).join(far, ["at", "to"]).groupBy("split", "class_id").agg(F.sum("copies").alias("links"))
    named = sizes.select("split", "c", "class_id").join(links, ["split", "class_id"], "left")
    return rows.join(named, ["split", "c"], "left").select("split", key, F.coalesce("class_id", key).alias("class_id"), F.coalesce("links", F.lit(0)).cast("long").alias("links"))


def overlap_members(split_df: DataFrame, text: Column, pairs: DataFrame, key: str = "row_id", side: str = "test", other: str = "train", rows: DataFrame | None = None) -> DataFrame:
    """split, key, class_id for every row, copies too, of the classes that ``pairs`` of
    ``near_overlap`` name: test_id or train_id of a pair is the class_id in its split."""
    rows = (shingle_rows(split_df, text, key, side, other) if rows is None else rows).where("c is not null").select("split", key, "c")
    pairs = checkpointed(pairs)
    named = pairs.select(F.lit(side).alias("split"), F.col("test_id").alias("class_id"))
    named = named.unionByName(pairs.select(F.lit(other).alias("split"), F.col("train_id").alias("class_id"))).distinct()
    linked = rows.join(named.withColumnRenamed("class_id", key), ["split", key]).select("split", "c", F.col(key).alias("class_id"))
    return rows.join(linked, ["split", "c"]).select("split", key, "class_id")
