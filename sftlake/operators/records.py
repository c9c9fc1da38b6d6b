"""Raw instruction records -> SFT records with a two-message chat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftlake.functions.text import kind_or_unknown, normalize_text

RAW_SCHEMA = "row_id long, kind string, input string, target string"
MESSAGE_TYPE = "array<struct<role:string,content:string>>"


def message(role: str | Column, content) -> Column:
    r = F.lit(role) if isinstance(role, str) else role
    c = F.col(content) if isinstance(content, str) else content
    return F.struct(r.alias("role"), c.alias("content"))


def normalized(raw: DataFrame, key: str = "row_id") -> DataFrame:
    """Normalise prompt/response/kind and flag whether the record is kept (all rows stay)."""
    return raw.select(
        F.col(key),
        kind_or_unknown("kind").alias("kind"),
        normalize_text("input").alias("prompt"),
        normalize_text("target").alias("response"),
    ).withColumn("kept", (F.col("prompt") != "") & (F.col("response") != ""))


def convert_records(raw: DataFrame, key: str = "row_id") -> DataFrame:
    """Drop records whose prompt or response is empty after normalisation and attach
    ``messages`` = [user prompt, assistant response]. Output: key, kind, prompt, response, messages."""
    kept = normalized(raw, key).where("kept").drop("kept")
    return kept.withColumn("messages", F.array(message("user", "prompt"), message("assistant", "response")))


def messages_only(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Column pruning down to ``messages`` (plus any key columns asked for)."""
    return records.select(*keep, "messages")


def explode_messages(df: DataFrame, key: str) -> DataFrame:
    """One row per message: key, pos, role, content."""
    return df.select(key, F.posexplode("messages").alias("pos", "m")).select(
        key, "pos", F.col("m.role").alias("role"), F.col("m.content").alias("content")
    )


def user_turn(prompt) -> Column:
    """Wrap a bare prompt as a one-message chat for generation."""
    return F.array(message("user", prompt))
