"""Turn the driver's tables into the record shapes the operators consume.

A1 conversations -> raw pairs; A2 documents -> raw records; A3 dirty overlay of A2;
A4 events -> trainer-log entries; A5 benchmark/documents -> prompts;
A6 conversations -> message arrays. Every adapter is a plain projection, window over a
bounded key, or aggregation over the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftlake.operators.ranking import ordered_running_total, quantile_bucket


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: kind = lang/source, input = text before the first newline, target = the rest
    (null when there is no newline), row_id = doc_id."""
    d = table(spark, sf_dir, "documents")
    nl = F.instr("text", "\n")
    return d.select(
        F.col("doc_id").alias("row_id"),
        F.concat_ws("/", "lang", "source").alias("kind"),
        F.when(nl > 0, F.expr("substring(text, 1, instr(text, '\\n') - 1)")).otherwise(F.col("text")).alias("input"),
        F.when(nl > 0, F.expr("substring(text, instr(text, '\\n') + 1)")).alias("target"),
    )


def documents_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: A2 with nulls, blanks and exotic padding injected by row_id rule."""
    r = documents_raw(spark, sf_dir)
    rid = F.col("row_id")
    return r.select(
        "row_id",
        F.when(rid % 19 == 0, F.lit(None).cast("string"))
        .when(rid % 17 == 0, F.lit(" 　 "))
        .otherwise(F.col("kind"))
        .alias("kind"),
        F.when(rid % 11 == 0, F.lit(None).cast("string"))
        .when(rid % 7 == 0, F.concat(F.lit("　 "), F.col("input"), F.lit(" 　")))
        .otherwise(F.col("input"))
        .alias("input"),
        F.when(rid % 13 == 0, F.lit("　")).otherwise(F.col("target")).alias("target"),
    )


TURNS_A_BUCKET = 1024


def conversation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: a user turn directly followed by an assistant turn; kind = 't' || turn and row_id =
    conv_id || ':' || turn, which no two pairs share.

    "Directly followed" is the next turn in turn order within the conversation. Turns are
    ranked inside their conversation with the two-level running count and each turn is joined
    to the turn of rank + 1 on (conv_id, rank): a unique key. Ranks are counted per thousand
    turn numbers of a conversation, so a huge conversation is spread over many tasks."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    c = c.withColumn("__b", F.floor(F.col("turn") / TURNS_A_BUCKET))
    ranked = ordered_running_total(c, by=["conv_id"], bucket="__b", order=["turn"], out="rk").drop("__b")
    users = ranked.where(F.col("role") == "user")
    nxt = ranked.where(F.col("role") == "assistant").select(
        F.col("conv_id").alias("n_conv"), (F.col("rk") - 1).alias("n_rk"), F.col("text").alias("next_text")
    )
    pairs = users.join(nxt, (users["conv_id"] == nxt["n_conv"]) & (users["rk"] == nxt["n_rk"]), "inner")
    return pairs.select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("row_id"),
        F.concat(F.lit("t"), F.col("turn").cast("string")).alias("kind"),
        F.col("text").alias("input"),
        F.col("next_text").alias("target"),
    )


def conversation_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6: conv_id, messages ordered by turn (one row per conversation)."""
    c = table(spark, sf_dir, "conversations")
    agg = c.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )
    return agg.select(
        "conv_id",
        F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))).alias(
            "messages"
        ),
    )


def benchmark_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 (unique ids): pos, id, group, prompt from the benchmark table."""
    b = table(spark, sf_dir, "benchmark")
    return b.select(
        F.col("item_id").alias("pos"),
        F.col("item_id").cast("string").alias("id"),
        F.concat(F.lit("g"), (F.col("item_id") % 5).cast("string")).alias("group"),
        F.col("text").alias("prompt"),
    )


def document_prompts(spark: SparkSession, sf_dir: str, k: int = 50) -> DataFrame:
    """A5 (duplicate ids): id = doc_id % k, null when that is 0; pos = doc_id."""
    d = table(spark, sf_dir, "documents")
    m = F.col("doc_id") % k
    return d.select(
        F.col("doc_id").alias("pos"),
        F.when(m != 0, m.cast("string")).alias("id"),
        F.concat(F.lit("g"), (F.col("doc_id") % 5).cast("string")).alias("group"),
        F.col("text").alias("prompt"),
    )


# Event type -> which trainer-log keys the entry carries (adapter rule, ours).
TRAIN_KEY_EVENTS = ("purchase", "click")
EVAL_KEY_EVENTS = ("view", "click")
NO_STEP_EVENTS = ("signup",)


def event_log_entries(spark: SparkSession, sf_dir: str, runs: int = 3, place: str | None = None) -> DataFrame:
    """A4: events -> trainer-log entries (run, step, loss, eval_loss) with nulls for absent keys;
    with ``place`` named, also an entry's place in its run's log, from 0.

    run = 'r' || user_id % runs; step = 10 x rank by (ts, event_id) within the run. The rank is
    computed with the two-level running count, so a run holding most events is never sorted
    by a single task.
    """
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    e = e.withColumn("run", F.concat(F.lit("r"), (F.col("user_id") % runs).cast("string")))
    e = e.withColumn("_tsn", F.unix_micros(F.col("ts").cast("timestamp")).cast("double"))
    e = quantile_bucket(e, "_tsn", "_b")
    ranked = ordered_running_total(e, by=["run"], bucket="_b", order=["ts", "event_id"], out="rn")
    et = F.col("event_type")
    return ranked.select(
        "run",
        "event_id",
        *([(F.col("rn") - 1).alias(place)] if place else []),
        F.when(~et.isin(*NO_STEP_EVENTS), F.col("rn") * 10).alias("step"),
        F.when(et.isin(*TRAIN_KEY_EVENTS), F.col("value")).alias("loss"),
        F.when(et.isin(*EVAL_KEY_EVENTS), F.col("value")).alias("eval_loss"),
    )


def conversation_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 without gathering a conversation: one rendered block per turn, plus one default
    system header row for each conversation whose first turn is not a system turn.

    Output: conv_id, turn, role, seg. Concatenating ``seg`` in turn order gives the rendered
    chat; every block ends in a newline, so token counts add up over segments. The per-turn
    blocks are a projection and the header rows come from a partial aggregate (first role by
    turn), so no conversation is ever collected into one row."""
    from sftlake.functions.chat import DEFAULT_SYSTEM, IM_END, IM_START

    c = table(spark, sf_dir, "conversations")
    printed = F.col("role").isin("user", "system", "assistant")
    blocks = c.select(
        "conv_id", "turn", "role",
        F.when(
            printed, F.concat(F.lit(IM_START), F.col("role"), F.lit("\n"), F.coalesce(F.col("text"), F.lit("")), F.lit(IM_END + "\n"))
        ).otherwise(F.lit("")).alias("seg"),
    )
    firsts = c.groupBy("conv_id").agg(F.min("turn").alias("turn0"), F.min_by("role", "turn").alias("role0"))
    headers = firsts.where(F.col("role0") != "system").select(
        "conv_id",
        (F.col("turn0") - 1).alias("turn"),
        F.lit("system").alias("role"),
        F.lit(f"{IM_START}system\n{DEFAULT_SYSTEM}{IM_END}\n").alias("seg"),
    )
    return blocks.unionByName(headers)
