"""The evaluation job: a head slice of the shuffled test split, rendered and scored under a
base and an adapted bundled token model; the summary document is written once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftlake.functions.chat import render_chat
from sftlake.functions.tokens import DEFAULT_MAX_LENGTH
from sftlake.operators.model import TokenModel, adapt_token_model
from sftlake.operators.score import score_models, summary_document
from sftlake.operators.split import head_rows, seeded_hash
from sftlake.sources.jsonl import write_metric_doc


def test_slice(test_rows: DataFrame, max_samples: int | None, seed: int = 42, key: str = "row_id") -> DataFrame:
    """First ``max_samples`` rows of the shuffled test split (all rows when not > 0)."""
    if max_samples is not None and max_samples <= 0:
        max_samples = None
    t = test_rows.withColumn("__o", seeded_hash(seed, key, salt="order"))
    return head_rows(t, max_samples, ["__o", key]).drop("__o")


def token_loss_summary(
    test_rows: DataFrame,
    base: TokenModel,
    domain: TokenModel,
    lam: float = 0.5,
    max_length: int = DEFAULT_MAX_LENGTH,
    max_samples: int | None = 1000,
    seed: int = 42,
    output_path: str | None = None,
) -> DataFrame:
    """test rows (with ``messages``) -> one-row summary: num_samples, base, oft, delta_mean_nll."""
    rows = test_slice(test_rows, max_samples, seed)
    texts = rows.select(render_chat("messages").alias("text"))
    metrics = score_models(texts, "text", adapt_token_model(base, domain, lam), max_length)
    doc = summary_document(metrics)
    if output_path:
        write_metric_doc(doc, output_path)
    return doc


def flat_summary(doc: DataFrame) -> DataFrame:
    return doc.select(
        "num_samples",
        F.col("base.mean_nll").alias("base_nll"),
        F.col("oft.mean_nll").alias("tuned_nll"),
        "delta_mean_nll",
    )


def compare_on_splits(
    splits_dir: str,
    base_texts: DataFrame,
    lam: float = 0.5,
    max_length: int = DEFAULT_MAX_LENGTH,
    max_samples: int | None = 1000,
    seed: int = 42,
    output_path: str | None = None,
) -> DataFrame:
    """The token-loss evaluation on prepared split files, end to end.

    base model   <- ``base_texts`` (column ``text``), the stand-in for the pretrained model;
    domain model <- the rendered train split (the stand-in for fine-tuning);
    evaluation   <- the first ``max_samples`` rows of the shuffled test split, rendered.
    All three feed one token x tag count pass; both models are scored in one aggregate.
    Only the train and test directories are read (partition pruning)."""
    from sftlake.operators.model import token_count_matrix
    from sftlake.operators.score import score_count_matrix
    from sftlake.sources.jsonl import read_splits

    spark = base_texts.sparkSession
    train = read_splits(spark, splits_dir, ("train",)).select(render_chat("messages").alias("text"))
    test = test_slice(read_splits(spark, splits_dir, ("test",)), max_samples, seed)
    tagged = (
        base_texts.select(F.col("text"), F.lit("base").alias("tag"))
        .unionByName(train.select("text", F.lit("domain").alias("tag")))
        .unionByName(test.select(render_chat("messages").alias("text"), F.lit("eval").alias("tag")))
    )
    # Truncation is a rule of the training and the evaluation side; the base corpus is read whole.
    limits = {"base": None, "domain": max_length, "eval": max_length}
    mx = token_count_matrix(tagged, "text", "tag", ("base", "domain", "eval"), limits)
    doc = summary_document(score_count_matrix(mx, "eval", "base", "domain", lam))
    if output_path:
        write_metric_doc(doc, output_path)
    return doc
