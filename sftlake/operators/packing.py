"""Sequence packing, assistant-only token mask and the training-sample budget.

Packing concatenates each shard's token sequences in key order and cuts the stream into
blocks of ``block_len`` tokens. A text's start offset is a running sum of lengths inside its
shard, computed with the two-level running total (ranking.py), so no single task walks a
shard; each text then emits only the blocks it touches (at most len/block_len + 1 rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftlake.functions.chat import message_blocks, system_header
from sftlake.functions.tokens import tokenize
from sftlake.operators.ranking import ordered_running_total, quantile_bucket

TURNS_A_BUCKET = 1024


def pack_spans(
    lengths: DataFrame, shard: str, key: str, length: str, block_len: int, buckets: int | None = None
) -> DataFrame:
    """lengths: shard, key (numeric), length -> shard, block, key, token_start, token_end: which
    tokens of which text each block holds. Tokens follow key order within the shard."""
    d = quantile_bucket(lengths.where(F.col(length) > 0), key, "__b", buckets)
    run = ordered_running_total(d, by=[shard], bucket="__b", order=[key], out="__end", value=length)
    L = F.lit(int(block_len))
    start, end = F.col("__end") - F.col(length), F.col("__end")
    at = run.select(
        shard, key, start.alias("__start"), "__end",
        F.explode(F.sequence(F.floor(start / L), F.floor((end - 1) / L))).alias("block"),
    )
    return at.select(
        shard, "block", key,
        (F.greatest("__start", F.col("block") * L) - F.col("__start")).cast("long").alias("token_start"),
        (F.least("__end", (F.col("block") + 1) * L) - F.col("__start")).cast("long").alias("token_end"),
    )


def pack_sequences(
    lengths: DataFrame, shard: str, key: str, length: str, block_len: int, buckets: int | None = None
) -> DataFrame:
    """lengths: shard, key, length -> shard, block, n_tokens (tokens of the block)."""
    spans = pack_spans(lengths, shard, key, length, block_len, buckets)
    return spans.groupBy(shard, "block").agg(F.sum(F.col("token_end") - F.col("token_start")).cast("long").alias("n_tokens"))


def segment_token_stats(segments: DataFrame, key: str = "conv_id") -> DataFrame:
    """Per conversation from rendered segments: n_tokens and n_assistant (partial aggregate)."""
    n = F.size(tokenize("seg"))
    return segments.groupBy(key).agg(
        F.sum(n).cast("long").alias("n_tokens"),
        F.sum(F.when(F.col("role") == "assistant", n).otherwise(0)).cast("long").alias("n_assistant"),
    )


def segment_offsets(segments: DataFrame, key: str) -> DataFrame:
    """Adds end (tokens of the conversation up to and with this segment) to key, turn, len, ...;
    counted per thousand turn numbers, so a long conversation is spread over tasks."""
    d = segments.withColumn("__b", F.floor(F.col("turn") / TURNS_A_BUCKET))
    return ordered_running_total(d, by=[key], bucket="__b", order=["turn"], out="end", value="len").drop("__b")


def assistant_spans(segments: DataFrame, key: str = "conv_id") -> DataFrame:
    """The assistant-only mask as token ranges: key, turn, token_start, token_end of every
    assistant block in its rendered conversation."""
    d = segments.select(key, "turn", "role", F.size(tokenize("seg")).cast("long").alias("len"))
    r = segment_offsets(d, key).where((F.col("role") == "assistant") & (F.col("len") > 0))
    return r.select(key, "turn", (F.col("end") - F.col("len")).alias("token_start"), F.col("end").alias("token_end"))


def truncation_report(stats: DataFrame, max_length: int) -> DataFrame:
    """n_texts, n_truncated and share of the texts longer than the limit (stats: n_tokens)."""
    over = F.col("n_tokens") > int(max_length)
    r = stats.agg(F.count(F.lit(1)).alias("n_texts"), F.count_if(over).alias("n_truncated"))
    return r.withColumn("share", F.col("n_truncated") / F.greatest(F.col("n_texts"), F.lit(1)))


def truncated_tail(segments: DataFrame, max_length: int, key: str = "conv_id") -> DataFrame:
    """Per conversation: n_kept = min(tokens, max_length) and the last kept token.

    Each segment is tokenised once and carries its first max_length tokens and its last one.
    Segment start offsets are a two-level running sum within the conversation; the last kept
    token is either the token at position max_length - 1 (in the one segment spanning it) or,
    for shorter conversations, the last token of the last non-empty segment."""
    L = int(max_length)
    toks = F.transform(F.array(tokenize("seg")), lambda t: F.struct(F.size(t).cast("long").alias("len"), F.slice(t, 1, L).alias("toks"), F.get(t, F.size(t) - 1).alias("last")))[0]
    d = segments.select(key, "turn", toks.alias("s")).select(key, "turn", "s.len", "s.toks", "s.last")
    r = segment_offsets(d, key)
    start = F.col("end") - F.col("len")
    at_limit = F.when((start <= L - 1) & (F.col("end") > L - 1), F.get("toks", (F.lit(L - 1) - start).cast("int")))
    seg_last = F.when(F.col("len") > 0, F.col("last"))
    agg = r.groupBy(key).agg(
        F.sum("len").alias("n"),
        F.max(at_limit).alias("at_limit"),
        F.max_by(seg_last, F.when(F.col("len") > 0, F.col("end"))).alias("tail"),
    )
    return agg.select(
        key,
        F.least(F.col("n"), F.lit(L)).cast("long").alias("n_kept"),
        F.coalesce(F.col("at_limit"), F.col("tail")).alias("last_token"),
    )


def assistant_mask_counts(convs: DataFrame, key: str, messages: str = "messages") -> DataFrame:
    """Per conversation: tokens of the rendered chat and tokens inside assistant turns.

    Every rendered block ends in a newline, so tokens never straddle two blocks and the
    token count of the whole text is the sum over blocks."""
    blocks = F.concat(F.array(system_header(messages)), message_blocks(messages))
    roles = F.concat(F.array(F.lit("system")), F.transform(messages, lambda m: m["role"]))
    counted = convs.select(
        key,
        F.transform(
            blocks, lambda b, i: F.struct(F.element_at(roles, i + 1).alias("r"), F.size(tokenize(b)).alias("n"))
        ).alias("c"),
    )
    return counted.select(
        key,
        F.aggregate("c", F.lit(0).cast("long"), lambda acc, x: acc + x["n"]).alias("n_tokens"),
        F.aggregate(
            "c", F.lit(0).cast("long"), lambda acc, x: acc + F.when(x["r"] == "assistant", x["n"]).otherwise(0)
        ).alias("n_assistant"),
    )


# The main run's optimiser budget (steps x per-device batch x devices x accumulation).
MAX_STEPS = 1200
PER_DEVICE_BATCH = 2
DEVICES = 2
GRAD_ACCUMULATION = 8


def train_budget(train_rows: DataFrame, max_steps: int = MAX_STEPS, per_device_batch: int = PER_DEVICE_BATCH,
                 devices: int = DEVICES, accumulation: int = GRAD_ACCUMULATION) -> DataFrame:
    """samples consumed by the optimiser, rows in the train split, and their ratio."""
    samples = int(max_steps) * int(per_device_batch) * int(devices) * int(accumulation)
    t = train_rows.agg(F.count(F.lit(1)).alias("train_rows"))
    return t.select(
        F.lit(samples).cast("long").alias("samples"),
        "train_rows",
        (F.lit(float(samples)) / F.greatest(F.col("train_rows"), F.lit(1))).alias("share"),
    )
