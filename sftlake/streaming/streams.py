"""The row-local operators on Structured Streaming frames.

Conversion, normalisation, chat rendering, tokenisation and loss-point routing are pure
column functions, so the batch code runs unchanged on ``readStream`` frames. The split is not
offered as a stream: its sizes need the final count of every stratum.

Checkpoint locations default to a fresh folder under the shared root (``spark.checkpoint.dir``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sftlake.functions.chat import render_chat
from sftlake.functions.tokens import tokenize
from sftlake.operators.curves import loss_points
from sftlake.operators.records import RAW_SCHEMA, convert_records
from sftlake.sources.jsonl import LOG_ENTRY
from sftlake.sources.scratch import fresh_dir


def record_stream(spark: SparkSession, raw_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw JSONL records arriving in ``raw_dir`` -> SFT records with rendered text and token count."""
    reader = spark.readStream.schema(RAW_SCHEMA).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    recs = convert_records(reader.json(raw_dir))
    return recs.withColumn("text", render_chat("messages")).withColumn("n_tokens", F.size(tokenize("text")))


def write_records(stream: DataFrame, out_dir: str, checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Append the converted records as JSON lines (exactly-once through the file sink log)."""
    ckpt = checkpoint or fresh_dir(stream.sparkSession, "stream-records-ckpt")
    w = stream.writeStream.format("json").option("path", out_dir).option("checkpointLocation", ckpt).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def log_point_stream(spark: SparkSession, log_dir: str) -> DataFrame:
    """Trainer-log lines appended under ``log_dir/run=<name>/`` -> run, series, step, loss."""
    lines = spark.readStream.schema("value string, run string").text(log_dir)
    entries = lines.select(F.col("run"), F.from_json("value", LOG_ENTRY).alias("entry"))
    return loss_points(entries)


def curve_progress(points: DataFrame) -> DataFrame:
    """Running per-run, per-series summary (state: one small row per run and series)."""
    return points.groupBy("run", "series").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("step").alias("last_step"),
        F.min_by("loss", "step").alias("first_loss"),
        F.max_by("loss", "step").alias("last_loss"),
    )


def write_progress(progress: DataFrame, out_dir: str, checkpoint: str | None = None) -> StreamingQuery:
    """Write the running summary after each batch (complete mode) as a table in ``out_dir``."""
    ckpt = checkpoint or fresh_dir(progress.sparkSession, "stream-progress-ckpt")

    def store(batch: DataFrame, _batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out_dir)

    w = progress.writeStream.outputMode("complete").option("checkpointLocation", ckpt)
    return w.foreachBatch(store).trigger(availableNow=True).start()
