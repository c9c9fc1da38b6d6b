"""JSON Lines sinks and scans, partitioned split files, trainer logs, metric documents and
the report document. Every reader takes an explicit schema; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sftlake.functions.pytext import is_present, python_text, typed_fields

SPLITS = ("train", "val", "test")
SFT_SCHEMA = (
    "kind string, prompt string, response string, "
    "messages array<struct<role:string,content:string>>, row_id long"
)
PROMPT_SCHEMA = "id string, group string, prompt string"
BEFORE_AFTER_SCHEMA = "pos long, id string, group string, prompt string, base_output string, tuned_output string"
LOG_ENTRY = "map<string,string>"
STATE_SCHEMA = f"struct<log_history: array<{LOG_ENTRY}>>"
METRICS_STRUCT = "struct<num_texts:long,num_tokens:long,mean_nll:double,perplexity:double>"
SUMMARY_SCHEMA = f"num_samples long, base {METRICS_STRUCT}, oft {METRICS_STRUCT}, delta_mean_nll double"


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line, column order kept, UTF-8 unescaped, nulls written."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Blank lines are skipped; a malformed line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_typed(spark: SparkSession, path: str, fields: list[str], keep: list[Column] = ()) -> DataFrame:
    """JSON lines -> one string column a field, as Python's ``str`` writes the value, and
    ``has_<field>``, whether the line has the key (with null as its value too). A null or missing
    value is null. ``keep``: further columns of the scan, such as fields of ``_metadata``. Blank
    lines are skipped; a malformed line, or one key twice in a line, fails the read."""
    lines = spark.read.text(path).where(F.btrim("value", F.lit(" \t\r")) != "")
    rows = lines.select(*keep, "value", typed_fields("value", fields).alias("v"))
    out = []
    for f in fields:
        v = F.col("v").getField(f)
        out += [python_text(v, "value", f).alias(f), is_present(v).alias(f"has_{f}")]
    return rows.select(*[c for c in rows.columns if c not in ("value", "v")], *out)


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    """id, group, prompt of a prompt file. Values that aren't strings are read as Python's
    ``str`` writes them. The group of a line without that key is ``unknown``; an explicit null
    stays null."""
    p = read_typed(spark, path, ["id", "group", "prompt"])
    return p.select("id", F.when(F.col("has_group"), F.col("group")).otherwise(F.lit("unknown")).alias("group"), "prompt")


def write_splits(split_df: DataFrame, path: str, order: tuple[str, ...] = ("order_hash", "row_id")) -> dict[str, int]:
    """All splits in one job, ``split=<name>`` directories; returns the rows written to each.
    Files inside a split follow the seeded order: range partitioning on (split, order) plus a
    sort inside each partition, so part files concatenated by name are the shuffled split.

    The rows are counted as the writing tasks read them. That stage is the job's last, of which
    Spark counts every task once, however often one is run; below the shuffle the sampling of
    the ranges and repeated tasks would count too."""
    cols = ["kind", "prompt", "response", "messages", "row_id"]
    seen = Observation()
    counts = [F.count_if(F.col("split") == s).alias(s) for s in SPLITS]
    placed = split_df.repartitionByRange("split", *order).observe(seen, *counts)
    ordered = placed.sortWithinPartitions("split", *order)
    ordered.select(*cols, "split").write.mode("overwrite").partitionBy("split").option(
        "ignoreNullFields", "false"
    ).json(path)
    return {s: int(seen.get[s]) for s in SPLITS}


def read_splits(spark: SparkSession, path: str, splits: tuple[str, ...] | None = None) -> DataFrame:
    """The partitioned split directory; a ``splits`` filter prunes partitions (directories)."""
    df = spark.read.schema(SFT_SCHEMA + ", split string").option("mode", "FAILFAST").json(path)
    return df.where(F.col("split").isin(*splits)) if splits else df


def read_trainer_states(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Trainer-state documents (one JSON document per run) -> run_path, pos, entry.

    A run's document is a single JSON value, so it is read whole by one task; the log of
    one training run is bounded by its step count. A missing ``log_history`` is empty."""
    docs = spark.read.text(paths, wholetext=True).select(
        F.input_file_name().alias("run_path"), F.from_json("value", STATE_SCHEMA).alias("s")
    )
    return docs.select("run_path", F.posexplode(F.coalesce(F.col("s.log_history"), F.array())).alias("pos", "entry"))


def write_log_lines(entries: DataFrame, path: str) -> None:
    """Log entries as JSON lines in ``run=<name>`` directories (absent keys stay absent)."""
    payload = entries.select("run", F.to_json(F.struct(*[c for c in entries.columns if c != "run"])).alias("value"))
    payload.write.mode("overwrite").partitionBy("run").text(path)


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Splittable form of the trainer log: run, entry (one log entry per line)."""
    df = spark.read.text(path)
    return df.select(F.col("run").cast("string").alias("run"), F.from_json("value", LOG_ENTRY).alias("entry"))


def write_metric_doc(doc: DataFrame, path: str) -> None:
    """A one-row summary document."""
    doc.coalesce(1).write.mode("overwrite").json(path)


def read_metric_docs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Summary documents (pretty-printed or single-line) -> path + summary fields."""
    df = spark.read.schema(SUMMARY_SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(paths)
    return df.withColumn("path", F.input_file_name())


def write_report(blocks: DataFrame, path: str, title: str) -> None:
    """Title once, then each block in ``pos`` order; part files in name order form the document."""
    spark = blocks.sparkSession
    head = spark.createDataFrame([(None, title)], "pos long, block string")
    doc = head.unionByName(blocks.select(F.col("pos").cast("long"), "block"))
    ordered = doc.repartitionByRange(F.col("pos").asc_nulls_first()).sortWithinPartitions(F.col("pos").asc_nulls_first())
    # The text sink ends every row with "\n"; blocks already end with one, so it is dropped first.
    b = F.col("block")
    value = F.when(b.endswith("\n"), F.expr("substring(block, 1, length(block) - 1)")).otherwise(b)
    ordered.select(value.alias("value")).write.mode("overwrite").text(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of a report document, each from its heading on, without the line ends after
    it. The file is cut at its block headings by the reader, so a long report is split."""
    parts = spark.read.option("lineSep", "\n## ").text(path).select(F.rtrim(F.col("value"), F.lit("\n")).alias("value"))
    heading = F.col("value").startswith("## ")
    cut = F.when(heading, F.col("value")).otherwise(F.concat(F.lit("## "), F.col("value")))
    return parts.where(~F.col("value").startswith("# ") & (F.col("value") != "")).select(cut.alias("block"))


RAW_FIELDS = "kind string, input string, target string"


def read_raw_records(spark: SparkSession, path: str, fmt: str = "json", id_col: str | None = None) -> DataFrame:
    """A raw instruction dataset (JSON lines or parquet) -> row_id, kind, input, target.

    Fields are strings; a JSON value of another type is read as Python's ``str`` writes it
    (``read_typed``). Without an id column, row_id is the record's place in the dataset: files by name, then lines in order. The
    records are copied once to the shared folder together with the file block they came from,
    blocks are numbered in (file, offset) order, and a record's id is the number of records in
    earlier blocks plus its place in its own. So ids don't depend on how Spark packs or orders
    its input splits, and every later pass sees the same ones."""
    from pyspark.sql import Window

    from sftlake.sources.scratch import checkpointed

    place = [F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b")]
    fields = ["kind", "input", "target"]
    if fmt == "json":
        df = read_typed(spark, path, [*fields, *([id_col] if id_col else [])], place)
    else:
        df = spark.read.schema(RAW_FIELDS + (f", {id_col} long" if id_col else "")).format(fmt).load(path).select("*", *place)
    if id_col:
        return df.select(F.col(id_col).cast("long").alias("row_id"), *fields)
    rows = checkpointed(df.select("f", "b", F.monotonically_increasing_id().alias("m"), *fields))
    blocks = rows.groupBy("f", "b").agg(F.count(F.lit(1)).alias("n"), F.min("m").alias("m0"))
    # One row per input split, numbered in one task.
    before = Window.orderBy("f", "b").rowsBetween(Window.unboundedPreceding, -1)
    first = blocks.select("f", "b", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("m0")).alias("shift"))
    return rows.join(checkpointed(first), ["f", "b"]).select((F.col("m") + F.col("shift")).alias("row_id"), "kind", "input", "target")
