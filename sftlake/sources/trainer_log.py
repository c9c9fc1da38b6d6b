"""Trainer-state documents of any length: one JSON object a run, whose ``log_history`` is a list.

A JSON string holds no raw line end, so every line of a document can be looked at by itself: its
brackets outside strings change the depth by a known amount. Running totals of these over the
lines of a document (a chunk of a file's block at a time) say which line is at which depth, and so
where the list opens, where its elements start and where it ends. No task holds a document or a
block, and lines travel without their paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sftlake.operators.ranking import ordered_running_total
from sftlake.sources.jsonl import LOG_ENTRY, STATE_SCHEMA
from sftlake.sources.scratch import checkpointed

#: A chunk has at most 2 to this power lines.
CHUNK_BITS = 16
_KEY = r'"log_history"\s*:\s*'


def write_trainer_states(entries: DataFrame, path: str, run: str = "run", place: str = "pos") -> None:
    """One document a run under ``run=<name>``, entries in ``place`` order (0, 1, ... in each run)
    and indented as trainers write them; null fields stay absent. Part files in name order are
    the document, so a long one is written by several tasks."""
    fields = [c for c in entries.columns if c not in (run, place)]
    last = entries.groupBy(F.col(run).alias("run")).agg(F.max(place).cast("long").alias("last"))
    body = entries.select(F.col(run).alias("run"), F.col(place).cast("long").alias("k"), F.to_json(F.struct(*fields), {"pretty": "true"}).alias("e"))
    body = body.join(last, "run").select("run", "k", F.concat("e", F.when(F.col("k") < F.col("last"), F.lit(",")).otherwise(F.lit(""))).alias("value"))
    head = last.select("run", F.lit(-1).cast("long").alias("k"), F.lit('{\n  "best_metric": null,\n  "log_history": [').alias("value"))
    foot = last.select("run", F.col("last") + 1, F.lit('  ],\n  "global_step": 0\n}'))
    doc = head.union(body).union(foot).repartitionByRange("run", "k").sortWithinPartitions("run", "k")
    doc.select("value", "run").write.mode("overwrite").partitionBy("run").text(path)


def _change(value: Column) -> Column:
    """By how much a line's brackets outside strings change the depth."""
    bare = F.regexp_replace(F.regexp_replace(value, r"\\.", ""), '"[^"]*"', "")
    opened = F.length(F.regexp_replace(bare, r"[^\[{]", ""))
    return (opened - F.length(F.regexp_replace(bare, r"[^\]}]", ""))).cast("long")


def read_trainer_documents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """run_path, pos (from 0, in list order), entry (key -> text) of every log entry.

    A document is a file, or the part files of a folder in name order. It is on one line, or the
    line that opens ``log_history`` ends there and the line that closes it starts with the
    bracket, as any indenting writer has it; another layout fails the read. Without the key, or
    with an empty or null list, there are no entries."""
    files = spark.read.option("recursiveFileLookup", "true").text(paths)
    lines = checkpointed(
        files.select(
            F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
            F.monotonically_increasing_id().alias("m"), "value", _change(F.col("value")).alias("change"),
        )
    ).withColumns({"c": F.shiftright("m", CHUNK_BITS), "h": F.xxhash64("f", "b")})
    # The chunks of a document in order: paths stay here, lines carry the document's hash and the chunk's number.
    sums = lines.groupBy("c", "h", "f", "b").agg(F.sum("change").alias("s")).withColumn("doc", F.regexp_replace("f", "/part-[^/]*$", ""))
    inorder = Window.partitionBy("doc").orderBy("f", "b", "c")
    before = F.sum("s").over(inorder.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("s")
    chunks = checkpointed(sums.select("c", "h", "doc", F.xxhash64("doc").alias("d"), F.row_number().over(inorder).alias("r"), before.alias("off")))
    names = checkpointed(chunks.select("d", "doc").distinct())

    within = Window.partitionBy("c", "h").orderBy("m").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    deep = lines.select("c", "h", "m", "value", "change").join(chunks.drop("doc"), ["c", "h"])
    deep = deep.withColumn("after", F.col("off") + F.sum("change").over(within)).withColumn("before", F.col("after") - F.col("change"))
    keys = F.col("value").rlike(_KEY) & (F.col("before") < 2)
    whole = (F.col("before") == 0) & (F.col("after") == 0) & (F.trim("value") != "")
    opens = (F.col("before") == 1) & F.col("value").rlike(rf"^\s*{_KEY}\[\s*$")
    none = F.col("value").rlike(rf"{_KEY}(\[\s*\]|null)")
    part = F.when(whole, F.lit("whole")).when(opens, F.lit("open")).when(keys & ~none, F.lit("odd"))
    deep = checkpointed(deep.select("d", "r", "m", "value", "before", "after", part.alias("part"))).withColumn("p", F.struct("r", "m"))

    def refuse(odd: DataFrame, what: str) -> None:
        """Fails the read where ``odd`` has a line."""
        odd.join(names, "d").select(F.raise_error(F.concat(F.lit(f"log_history {what} within a line in "), F.col("doc")))).collect()

    refuse(deep.where("part = 'odd'").select("d"), "opens")
    # One row a document: where the list opens (of two lists the later one counts) and where it ends.
    opened = deep.where(F.col("part") == "open").groupBy("d").agg(F.max("p").alias("first"))
    ends = deep.where(F.col("after") == 1).join(opened, "d").where(F.col("p") > F.col("first"))
    ends = checkpointed(ends.groupBy("d", "first").agg(F.min("p").alias("last"), F.min_by("value", "p").alias("close")))
    refuse(ends.where(~F.col("close").rlike(r"^\s*\]")), "ends")
    inside = deep.join(ends.drop("close"), "d").where((F.col("p") > F.col("first")) & (F.col("p") < F.col("last")))

    # A line at the list's own depth starts an element; lines up to the next such line belong to it.
    inside = inside.withColumn("starts", (F.col("before") == 2).cast("long"))
    numbered = ordered_running_total(inside.select("d", "r", "m", "value", "starts"), ["d"], "r", ["m"], "n", "starts")
    element = numbered.groupBy("d", "n").agg(F.array_sort(F.collect_list(F.struct("r", "m", "value"))).alias("l"))
    text = F.regexp_replace(F.array_join(F.col("l")["value"], "\n"), r",\s*$", "")
    listed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<{LOG_ENTRY}>", {"mode": "FAILFAST"})
    # An element's lines may hold several objects, so places are counted over their numbers.
    element = checkpointed(element.select("d", F.col("l")[0]["r"].alias("r"), F.col("l")[0]["m"].alias("m"), listed.alias("es")).withColumn("size", F.size("es")))
    counted = ordered_running_total(element, ["d"], "r", ["m"], "upto", "size")
    many = counted.select("d", F.posexplode("es").alias("k", "entry"), (F.col("upto") - F.col("size")).alias("before"))
    many = many.select("d", (F.col("before") + F.col("k")).alias("pos"), "entry")

    one = deep.where(F.col("part") == "whole").select("d", F.from_json("value", STATE_SCHEMA, {"mode": "FAILFAST"}).alias("s"))
    one = one.select("d", F.posexplode(F.coalesce(F.col("s.log_history"), F.array())).alias("pos", "entry"))
    entries = many.unionByName(one.withColumn("pos", F.col("pos").cast("long")))
    return entries.join(F.broadcast(names), "d").select(F.col("doc").alias("run_path"), "pos", "entry")
