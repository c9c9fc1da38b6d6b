"""Token-level NLL / perplexity, base-vs-tuned comparison, and the scorer plug-in.

Valid tokens of a text are the positions after the first within the truncated sequence.
The mean NLL is weighted by valid tokens (sum of NLL over all texts / number of tokens),
never a mean of per-text or per-batch means. Zero tokens give mean 0 and perplexity 1;
a mean of 20 or more gives perplexity +inf.

Losses are summed exactly: each token's loss is rounded to ``LOSS_DIGITS`` decimals and added up
as a decimal, so a sum doesn't depend on the order of rows, partitions or retries.

Bundled-model scoring never ships the model to the driver: valid tokens are first counted
per token (partial aggregation folds hot tokens map-side), then joined with the model table
on a unique key, so the join carries one row per distinct token on each side.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftlake.functions.tokens import DEFAULT_MAX_LENGTH, tokenize
from sftlake.operators.model import AdaptedModel, TokenModel

LOSS_DIGITS = 12


def exact_loss(p: Column, times: Column | None = None) -> Column:
    """-log(p), ``times`` over, as a decimal whose sums are the same in any order."""
    return _exact(-F.log(p), times)


def _exact(loss: Column, times: Column | None = None) -> Column:
    one = loss.cast(f"decimal(18,{LOSS_DIGITS})")
    return one if times is None else one * times.cast("decimal(19,0)")


def perplexity(mean_nll: Column) -> Column:
    return F.when(mean_nll < 20, F.exp(mean_nll)).otherwise(F.lit(float("inf")))


def valid_tokens(texts: DataFrame, text_col: str, max_length: int = DEFAULT_MAX_LENGTH) -> DataFrame:
    """One row per scored token position (1-based positions 2..max_length)."""
    return texts.select(F.explode(F.slice(tokenize(text_col), 2, max_length - 1)).alias("token"))


def valid_token_counts(texts: DataFrame, text_col: str, max_length: int = DEFAULT_MAX_LENGTH) -> DataFrame:
    return valid_tokens(texts, text_col, max_length).groupBy("token").agg(F.count(F.lit(1)).alias("cnt"))


def score_models(
    texts: DataFrame,
    text_col: str,
    model: AdaptedModel | TokenModel,
    max_length: int = DEFAULT_MAX_LENGTH,
) -> DataFrame:
    """Long-form metrics, one row per model: model, num_texts, num_tokens, mean_nll, perplexity.

    Both models of an AdaptedModel are scored in the same pass."""
    cnt = valid_token_counts(texts, text_col, max_length)
    per_text = texts.select(
        F.lit(1).cast("long").alias("texts"),
        F.lit(0).cast("long").alias("tokens"),
        F.lit(0).cast("decimal(38,12)").alias("s_base"),
        F.lit(0).cast("decimal(38,12)").alias("s_tuned"),
    )
    return _score(cnt, per_text, model)


def score_token_counts(counts: DataFrame, num_texts: int, model: AdaptedModel | TokenModel) -> DataFrame:
    """Same metrics from pre-aggregated (token, cnt) scored-token counts and a text count."""
    spark = counts.sparkSession
    per_text = spark.createDataFrame(
        [(int(num_texts), 0, Decimal(0), Decimal(0))], "texts long, tokens long, s_base decimal(38,12), s_tuned decimal(38,12)"
    )
    return _score(counts, per_text, model)


def _score(cnt: DataFrame, per_text: DataFrame, model: AdaptedModel | TokenModel) -> DataFrame:
    if isinstance(model, TokenModel):
        table = model.table().select("token", F.col("p").alias("p_base"), F.col("p").alias("p_tuned"))
        unk_b = unk_t = model.unk_p
        names = ("model",)
    else:
        table, unk_b, unk_t = model.table, model.unk_base, model.unk_tuned
        names = ("base", "tuned")
    # Both sides hold one row per distinct token: no key is hot, whatever the token frequencies.
    j = cnt.join(table, "token", "left")
    per_token = j.select(
        F.lit(0).cast("long").alias("texts"),
        F.col("cnt").cast("long").alias("tokens"),
        exact_loss(F.coalesce("p_base", F.lit(unk_b)), F.col("cnt")).alias("s_base"),
        exact_loss(F.coalesce("p_tuned", F.lit(unk_t)), F.col("cnt")).alias("s_tuned"),
    )
    tot = per_token.unionByName(per_text).agg(
        F.sum("texts").alias("texts"),
        F.sum("tokens").alias("tokens"),
        F.sum("s_base").alias("s_base"),
        F.sum("s_tuned").alias("s_tuned"),
    )
    sums = {"base": "s_base", "tuned": "s_tuned", "model": "s_base"}
    long = tot.select(
        F.explode(
            F.array(*[F.struct(F.lit(n).alias("model"), F.col(sums[n]).alias("s")) for n in names])
        ).alias("m"),
        F.coalesce(F.col("texts"), F.lit(0)).alias("num_texts"),
        F.coalesce(F.col("tokens"), F.lit(0)).alias("num_tokens"),
    )
    return metrics_from_sums(long, "m.model", "m.s")


def metrics_from_sums(df: DataFrame, model: str, total_nll: str) -> DataFrame:
    mean = F.coalesce(F.col(total_nll).cast("double"), F.lit(0.0)) / F.greatest(F.col("num_tokens"), F.lit(1))
    out = df.select(F.col(model).alias("model"), "num_texts", "num_tokens", mean.alias("mean_nll"))
    return out.withColumn("perplexity", perplexity(F.col("mean_nll")))


def compare(metrics: DataFrame) -> DataFrame:
    """Base/tuned long metrics -> one row: num_samples, base_nll, tuned_nll, delta_mean_nll,
    base_ppl, tuned_ppl (delta = tuned - base)."""
    w = metrics.groupBy().agg(
        F.max(F.when(F.col("model") == "base", F.col("num_texts"))).alias("num_samples"),
        F.max(F.when(F.col("model") == "base", F.col("mean_nll"))).alias("base_nll"),
        F.max(F.when(F.col("model") == "tuned", F.col("mean_nll"))).alias("tuned_nll"),
        F.max(F.when(F.col("model") == "base", F.col("perplexity"))).alias("base_ppl"),
        F.max(F.when(F.col("model") == "tuned", F.col("perplexity"))).alias("tuned_ppl"),
    )
    return w.withColumn("delta_mean_nll", F.col("tuned_nll") - F.col("base_nll"))


def relative_change(cmp: DataFrame) -> DataFrame:
    """Percent change of tuned vs base: 100 * (tuned / base - 1) for NLL and perplexity.
    Undefined (null) when the base is 0, e.g. when no token was scored."""
    return cmp.select(
        (F.lit(100.0) * (F.try_divide(F.col("tuned_nll"), F.col("base_nll")) - 1)).alias("nll_pct"),
        (F.lit(100.0) * (F.try_divide(F.col("tuned_ppl"), F.col("base_ppl")) - 1)).alias("ppl_pct"),
    )


def summary_document(metrics: DataFrame) -> DataFrame:
    """The nested summary record: num_samples, base{...}, oft{...}, delta_mean_nll."""
    def side(name: str) -> Column:
        pick = F.col("model") == name
        return F.struct(
            F.max(F.when(pick, F.col("num_texts"))).alias("num_texts"),
            F.max(F.when(pick, F.col("num_tokens"))).alias("num_tokens"),
            F.max(F.when(pick, F.col("mean_nll"))).alias("mean_nll"),
            F.max(F.when(pick, F.col("perplexity"))).alias("perplexity"),
        )

    doc = metrics.groupBy().agg(
        F.max(F.when(F.col("model") == "base", F.col("num_texts"))).alias("num_samples"),
        side("base").alias("base"),
        side("tuned").alias("oft"),
    )
    return doc.withColumn("delta_mean_nll", F.col("oft.mean_nll") - F.col("base.mean_nll"))


# ---------------------------------------------------------------- scorer plug-in (SCO1)

ScorerFactory = Callable[[], Callable[[list[str]], list[list[float]]]]

_WORKER_CACHE: dict = {}


def score_with_plugin(
    texts: DataFrame,
    text_id: str,
    text_col: str,
    factories: dict[str, ScorerFactory],
    cache_key: str,
    sort_by_length: bool = True,
) -> DataFrame:
    """Run user scorers over Arrow batches: text_id, model, num_tokens, sum_nll; all models in
    one pass over the texts.

    Each factory builds its scorer once per Python worker (a model load; a worker keeps the
    scorers of one ``cache_key``); a scorer maps a batch of texts to per-token NLL lists (already
    truncated and shifted by the scorer). With ``sort_by_length`` texts are ordered by length
    inside each partition (no shuffle), so a padded batch holds texts of similar length;
    per-text results do not depend on it."""
    import pandas as pd

    from sftlake.session import ship_package

    ship_package(texts.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from sftlake.operators import score as this  # the worker's module: one cache per process

        if this._WORKER_CACHE.get("key") != cache_key:
            this._WORKER_CACHE.clear()
            this._WORKER_CACHE.update(key=cache_key, scorers={name: make() for name, make in factories.items()})
        for pdf in batches:
            for name, scorer in this._WORKER_CACHE["scorers"].items():
                nlls = scorer(pdf[text_col].fillna("").tolist())
                yield pd.DataFrame(
                    {
                        text_id: pdf[text_id].values,
                        "model": name,
                        "num_tokens": [len(x) for x in nlls],
                        "sum_nll": [float(sum(x)) for x in nlls],
                    }
                )

    schema = f"{text_id} {dict(texts.dtypes)[text_id]}, model string, num_tokens long, sum_nll double"
    src = texts.select(text_id, text_col)
    if sort_by_length:
        src = src.sortWithinPartitions(F.length(text_col))
    return src.mapInPandas(run, schema)


def plugin_metrics(per_text: DataFrame, models: list[str]) -> DataFrame:
    """One row for each model, also when there is no text."""
    of = lambda c, m: F.when(F.col("model") == m, F.col(c))
    rows = [
        F.struct(
            F.lit(m).alias("model"),
            F.count(of("num_tokens", m)).alias("num_texts"),
            F.coalesce(F.sum(of("num_tokens", m)), F.lit(0)).alias("num_tokens"),
            F.sum(_exact(of("sum_nll", m))).alias("s"),
        )
        for m in models
    ]
    return metrics_from_sums(per_text.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*"), "model", "s")


class LengthScorerFactory:
    """A scorer without a table: a token of n characters costs ``scale`` * ln(1 + n). It stands
    for any self-contained model on the plug-in path; a fitted token table is scored by the
    aggregate (``score_count_matrix``), never shipped to workers."""

    def __init__(self, scale: float, max_length: int):
        self.scale, self.max_length = scale, max_length

    def __call__(self):
        import math

        from sftlake.functions.tokens import py_tokenize

        return lambda texts: [[self.scale * math.log1p(len(t)) for t in py_tokenize(x)[: self.max_length][1:]] for x in texts]


def score_count_matrix(matrix, eval_tag: str, base_tag: str, domain_tag: str, lam: float) -> DataFrame:
    """Base and adapted model metrics straight from the count matrix: each token row already
    holds its base, domain and evaluation counts, so scoring is one aggregate with no join."""
    v = F.col(f"v_{eval_tag}")
    rows = matrix.table.where(F.col("token").isNotNull() & (v > 0))
    tot = rows.agg(
        F.sum(v).alias("tokens"),
        F.sum(exact_loss(matrix.prob(base_tag), v)).alias("s_base"),
        F.sum(exact_loss(matrix.tuned_prob(base_tag, domain_tag, lam), v)).alias("s_tuned"),
    )
    long = tot.select(
        F.explode(
            F.array(
                F.struct(F.lit("base").alias("model"), F.col("s_base").alias("s")),
                F.struct(F.lit("tuned").alias("model"), F.col("s_tuned").alias("s")),
            )
        ).alias("m"),
        F.lit(int(matrix.texts[eval_tag])).cast("long").alias("num_texts"),
        F.coalesce(F.col("tokens"), F.lit(0)).cast("long").alias("num_tokens"),
    )
    return metrics_from_sums(long, "m.model", "m.s")
