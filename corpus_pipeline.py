"""A corpus pipeline of five training-data operators. Each stage gets what the one before it
kept, as a table written and read again; all but the last return the columns of ``documents``.

quality classifier: rejected documents go. line dedup: repeated lines go, and documents of which
no line is left. n-gram Jaccard join: of each class one document stays, the one with the smallest
id. benchmark decontamination: documents that hold a benchmark item go. packing: the pieces of
full training windows.

A stage's result is read before the next stage begins, which removes what it was worked out from.

Each stage needs the five columns of ``documents``, leaves others out, and raises where one is
missing. Null and empty texts pass the stages that do not score them down; null and repeated ids
are told in each stage; a stage of an empty table gives an empty table."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sftlake.llm import decontaminate, jaccard_join, line_dedup, packing, pu_quality
from sftlake.llm.common import checkpointed, read
from sftlake.llm.queries import tokenizer_path
from sftlake.sources.scratch import recorded, remove_tables

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


_left: list[str] = []  # intermediate tables of the stages so far


def stage(f):
    """A stage gets what the one before it kept as a written table, so the tables that the earlier
    ones worked with go when it begins; any that its ``docs`` still read stay."""

    @functools.wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _left[:] = remove_tables(spark, _left, docs)
        with recorded() as paths:
            out = f(spark, docs, sf_dir)
        _left.extend(paths)
        return out

    return run_stage


@stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more by the classifier, fitted on these documents and the labels."""
    model = pu_quality.fit(docs, read(spark, sf_dir, "labels"))
    scored = pu_quality.score(docs, model, keep=COLUMNS)
    return scored.where("quality_score >= 0.5").select(*COLUMNS)


@stage
def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated lines; n_chars counts what is left. A document whose lines
    all went is a copy of others and goes; one that had no line from the start stays."""
    out = line_dedup.dedup_lines(docs.select(*COLUMNS))
    out = out.where((F.col("n_removed") < F.col("n_lines")) | (F.col("n_lines") == 0))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


@stage
def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of linked texts: that with the smallest id, of equal ids that with the
    smallest hash of its text. Rows go one by one, so a repeated id loses only its copies, and rows
    without an id (they come first) go as others do; of rows alike in id and text one stays."""
    docs = docs.select(*COLUMNS)
    named = docs.select(F.struct(F.col("doc_id").alias("d"), F.xxhash64("text").alias("h")).alias("doc_id"), "text")
    gone = jaccard_join.join_classes(named).where("doc_id != component_id").select("doc_id.*").distinct()
    gone = checkpointed(gone.withColumnsRenamed({"d": "__d", "h": "__h"}))
    out = docs.withColumn("__t", F.xxhash64("text"))
    out = out.join(gone.hint("shuffle_merge"), (F.col("__t") == F.col("__h")) & F.col("doc_id").eqNullSafe(F.col("__d")), "left_anti")
    same = Window.partitionBy("__t", "doc_id").orderBy("source", "lang")  # dealt by these already
    return out.withColumn("__n", F.row_number().over(same)).where("__n = 1").select(*COLUMNS)


@stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a leaked benchmark item."""
    return decontaminate.find_leaks(docs.select(*COLUMNS), read(spark, sf_dir, "benchmark")).where(
        ~F.exists("leaks", lambda x: x["item_words"] >= decontaminate.MIN_WORDS)
    ).select(*COLUMNS)


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with the digest of their ids."""
    return packing.pack(docs, tokenizer_path()).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_deduplication),
    ("n-gram Jaccard join", ngram_jaccard),
    ("benchmark decontamination", decontamination),
    ("packing", pack),
]
#: A trained classifier, linked classes and a tokenizer can't be written in SQL; the tests hold
#: the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder."""
    docs = read(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = checkpointed(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
