"""Scoring under a mask of token ranges, and batches in row order.

The mask is a table of spans (key, token_start, token_end). Positions and spans meet in an
interval merge: spans are cut at bucket borders, and inside each (key, bucket of ``BUCKET``
positions) one ordered pass carries the furthest end of the spans that have begun. So no
position is paired with the spans of its text, a text of any length is spread over tasks, and
spans may overlap, nest or be empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sftlake.functions.tokens import tokenize
from sftlake.operators.model import TokenModel
from sftlake.operators.packing import segment_offsets
from sftlake.operators.ranking import ordered_running_total, quantile_bucket
from sftlake.operators.score import exact_loss, metrics_from_sums

BUCKET = 4096


def token_positions(segments: DataFrame, key: str = "conv_id") -> DataFrame:
    """key, pos, token of the rendered conversations of ``segments`` (key, turn, seg)."""
    toks = tokenize("seg")
    ends = segment_offsets(segments.select(key, "turn", F.size(toks).cast("long").alias("len"), toks.alias("toks")), key)
    at = ends.select(key, (F.col("end") - F.col("len")).alias("start"), F.posexplode("toks").alias("i", "token"))
    return at.select(key, (F.col("start") + F.col("i")).alias("pos"), "token")


def inside(positions: DataFrame, spans: DataFrame, key: str = "conv_id") -> DataFrame:
    """The rows of ``positions`` (key, pos, ...) that lie in a span (key, token_start, token_end)
    of their key: from token_start on, before token_end."""
    names = [c for c in positions.columns if c not in (key, "pos")]
    places = positions.select(key, F.floor(F.col("pos") / BUCKET).alias("__b"), F.col("pos").alias("__at"), F.lit(1).alias("__kind"), F.lit(None).cast("long").alias("__end"), F.struct("pos", *names).alias("__row"))
    buckets = F.sequence(F.floor(F.col("token_start") / BUCKET), F.floor((F.col("token_end") - 1) / BUCKET))
    cut = spans.where("token_end > token_start").select(key, "token_start", "token_end", F.explode(buckets).alias("__b"))
    kind = places.schema["__row"].dataType
    cut = cut.select(key, "__b", F.greatest("token_start", F.col("__b") * BUCKET).alias("__at"), F.lit(0).alias("__kind"), F.col("token_end").alias("__end"), F.lit(None).cast(kind).alias("__row"))
    begun = Window.partitionBy(key, "__b").orderBy("__at", "__kind").rowsBetween(Window.unboundedPreceding, 0)
    met = places.unionByName(cut).withColumn("__far", F.max("__end").over(begun))
    return met.where((F.col("__kind") == 1) & (F.col("__far") > F.col("__at"))).select(key, "__row.*")


def masked_nll(segments: DataFrame, spans: DataFrame | None, model: TokenModel, key: str = "conv_id") -> DataFrame:
    """num_texts, num_tokens, mean_nll, perplexity of the positions inside the spans (None: all), but
    for the first of each text, which has nothing before it. Losses are summed over
    distinct tokens, so no token is hot."""
    at = token_positions(segments, key)
    texts = segments.select(key).distinct().agg(F.count(F.lit(1)).alias("num_texts"))
    at = at if spans is None else inside(at, spans, key)
    counts = at.where("pos >= 1").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    priced = counts.join(model.table(), "token", "left")
    loss = exact_loss(F.coalesce("p", F.lit(model.unk_p)), F.col("n"))
    sums = priced.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("num_tokens"), F.sum(loss).alias("s")).crossJoin(texts)  # one row each
    return metrics_from_sums(sums.withColumn("model", F.lit("model")), "model", "s").drop("model")


def batch_plan(lengths: DataFrame, key: str, length: str, batch_size: int) -> DataFrame:
    """Batches of ``batch_size`` rows in the order of the numeric column ``key`` (a total
    order): batch, first_row (its key), rows, width (the longest), tokens, padded (places that
    hold no token). Rows are numbered with two-level counts, so no task holds them all."""
    if batch_size < 1:
        raise ValueError(f"a batch holds one row at least, got {batch_size}")
    rows = quantile_bucket(lengths.select(F.lit(0).alias("__all"), key, F.coalesce(F.col(length), F.lit(0)).alias("__len")), key, "__b")
    ranked = ordered_running_total(rows, by=["__all"], bucket="__b", order=[key], out="__rk")
    batch = F.floor((F.col("__rk") - 1) / batch_size).cast("long")
    out = ranked.groupBy(batch.alias("batch")).agg(F.min(key).alias("first_row"), F.count(F.lit(1)).alias("rows"), F.max("__len").cast("long").alias("width"), F.sum("__len").cast("long").alias("tokens"))
    return out.withColumn("padded", F.col("width") * F.col("rows") - F.col("tokens"))
