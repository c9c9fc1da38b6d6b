"""Classes of near duplicates from candidate buckets, without emitting the pairs of a bucket.

``linked_classes`` takes members (k, id, x): two ids can only be linked when they share a k and
their x fit each other. Rounds of leaders replace all-pairs: in each round every bucket names a few leaders, members are
compared with the leaders of their buckets, and verified links merge classes. Who has led has been
compared with its whole bucket and leaves it; of those that are left, members of the bucket's
largest class need not lead, since links inside one class change nothing. The
rounds end when every member left is of its bucket's largest class. By then any two members
of different classes that share a bucket have been compared, so no link between classes is lost;
a group of n true copies costs about n comparisons instead of n squared.

Where it is enough that a member with the flag ``leads`` meets each other member (the holder of a
segment and those that probe for it), a bucket is also done when all its flagged members have
led, and names leaders from whichever side has fewer left.

Everything is a join or an aggregate over tables in the shared folder; nothing is collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sftlake.llm.common import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """(id, comp) for every id of ``edges`` (a, b): comp is the least id reachable. Alternates
    large-star and small-star steps until the edges stop changing; each step keeps one row per
    edge, and a hub's edges are split over tasks as the joins are skew-safe."""
    e = checkpointed(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    # Done when the edges are stars: no edge's lower end is the upper end of another.
    while not e.select("a").join(e.select(F.col("b").alias("a")), "a", "left_semi").isEmpty() or not _one_root_each(e):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("s"))
        e = checkpointed(small.select("s.*").where("a != b").distinct())
    roots = e.select(F.col("b").alias("id")).distinct()
    return e.select(F.col("a").alias("id"), F.col("b").alias("comp")).unionByName(roots.withColumn("comp", F.col("id")))


def _one_root_each(e: DataFrame) -> bool:
    return e.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def every_pair(met: DataFrame, leads: DataFrame) -> DataFrame:
    return met.select("id", F.explode("lead").alias("lead"))


def linked_classes(
    members: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    fits: Callable[[Column, Column], Column],
    narrow: Callable[[DataFrame, DataFrame], DataFrame] = every_pair,
    leaders: int = 4,
    growth: int = 15,
) -> DataFrame:
    """(id, comp) of the ids that have a link. x belongs to the id; ``fits`` is a cheap
    symmetric bound that no linked pair fails. ``members`` may have a fourth column, ``leads``
    (boolean): of two linked ids one has it in a bucket they share. ``narrow`` turns rows (id, lead), an id with the
    leaders it met, into pairs (id, lead) and may leave out pairs that can't be linked; it also
    gets the distinct leaders (id).
    ``verify`` gets pairs (a, b, lead), a < b, lead one of them, each pair at most once, and
    returns those that are linked."""
    flags = [c for c in ("leads",) if c in members.columns]
    if flags:
        members = checkpointed(members.groupBy("k", "id").agg(F.first("x").alias("x"), F.max("leads").alias("leads")))
    else:
        members = checkpointed(members.select("k", "id", "x").distinct())
    spark = members.sparkSession
    links = tried = comps = None
    order = F.struct(F.xxhash64("id"), "id")  # one order for all buckets, so they share their leaders
    while True:
        if comps is None:
            now = members.withColumn("comp", F.col("id")).withColumn("open", F.col("leads") if flags else F.lit(True))
        else:
            now = members.join(comps.withColumnRenamed("comp", "c"), "id", "left").select("k", "id", "x", *flags, F.coalesce("c", "id").alias("comp"))
            sizes = now.groupBy("k", "comp").agg(F.count("*").alias("n"), *(F.count_if(c).alias("flagged") for c in flags))
            sums = [F.max_by("comp", F.struct("n", "comp")).alias("ref"), F.count("*").alias("parts"), (F.sum("n") - F.max("n")).alias("outside")]
            ref = sizes.groupBy("k").agg(*sums, *(F.sum("flagged").alias("flagged") for _ in flags)).where("parts > 1")
            now = now.join(ref, "k")
            # A bucket is done when its flagged members have led, or those outside its largest class.
            now = now.withColumn("open", F.expr("if(flagged <= outside, leads, comp != ref)" if flags else "comp != ref"))
            now = checkpointed(now.select("k", "id", "x", *flags, "comp", "open"))
        chosen = now.where("open").select("k", "id", "x", "comp").withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy(order)))
        chosen = checkpointed(chosen.where(F.col("rank") <= leaders).drop("rank"))
        if chosen.isEmpty():
            break
        ahead = chosen.groupBy("k").agg(F.collect_list(F.struct(F.col("id").alias("l"), "x", "comp")).alias("lead"))
        own = now.select("k", "id", "x", "comp").join(ahead, "k")
        apart = lambda s: (s["comp"] != F.col("comp")) & fits(s["x"], F.col("x"))
        own = own.select("id", F.filter("lead", apart)["l"].alias("lead")).where(F.size("lead") > 0)
        met = own.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("lead"))).alias("lead"))
        pairs = narrow(met, chosen.select("id").distinct()).groupBy(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b")).agg(F.min("lead").alias("lead"))
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = checkpointed(pairs)
        tried = pairs.select("a", "b") if tried is None else tried.unionByName(pairs.select("a", "b"))
        found = checkpointed(verify(pairs).select("a", "b"))
        # Known classes as stars, and the new links between them.
        links = found if comps is None else found.unionByName(comps.where("id != comp").select(F.col("id").alias("a"), F.col("comp").alias("b")))
        comps = checkpointed(components(links))
        # Who has led has met its whole bucket and leaves it; buckets without a leader to name are done.
        last = chosen.groupBy("k").agg(F.max(order).alias("last"))
        members = checkpointed(now.join(last, "k").where(~F.col("open") | (order > F.col("last"))).select("k", "id", "x", *flags))
        leaders = min(leaders * growth, 1000)
    return comps if comps is not None else spark.createDataFrame([], members.select("id", F.col("id").alias("comp")).schema)
