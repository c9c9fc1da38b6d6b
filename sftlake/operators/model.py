"""Bundled token model fitted by Spark aggregation, and its adapted ("tuned") form.

fit:   counts c(t) of tokens over training texts; N = sum c, V = distinct tokens;
       p(t) = (c(t) + 1) / (N + V + 1), and every unseen token gets 1 / (N + V + 1).
adapt: p_tuned(t) = lam * p_domain(t) + (1 - lam) * p_base(t), both add-one smoothed.

Counting is an explode + partial/final hash aggregate, so hot tokens are combined map-side.
The count table is checkpointed to the shared folder (it is reused by every scoring pass);
only the two scalars N and V go to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftlake.functions.tokens import DEFAULT_MAX_LENGTH, tokenize, truncate
from sftlake.sources.scratch import checkpointed


@dataclass
class TokenModel:
    counts: DataFrame  # token string, n long
    total: int
    vocab: int

    @property
    def denom(self) -> float:
        return float(self.total + self.vocab + 1)

    @property
    def unk_p(self) -> float:
        return 1.0 / self.denom

    def prob(self, n: Column) -> Column:
        return (n.cast("double") + F.lit(1.0)) / F.lit(self.denom)

    def table(self) -> DataFrame:
        return self.counts.select("token", self.prob(F.col("n")).alias("p"))


@dataclass
class AdaptedModel:
    table: DataFrame  # token, p_base, p_tuned
    unk_base: float
    unk_tuned: float
    lam: float


def token_counts(texts: DataFrame, text_col: str, max_length: int | None = DEFAULT_MAX_LENGTH) -> DataFrame:
    toks = tokenize(text_col)
    if max_length:
        toks = truncate(toks, max_length)
    return texts.select(F.explode(toks).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def fit_token_model(texts: DataFrame, text_col: str = "text", max_length: int | None = DEFAULT_MAX_LENGTH) -> TokenModel:
    counts = checkpointed(token_counts(texts, text_col, max_length))
    row = counts.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("vocab")).first()
    return TokenModel(counts, int(row["total"] or 0), int(row["vocab"] or 0))


def adapt_token_model(base: TokenModel, domain: TokenModel, lam: float) -> AdaptedModel:
    if not 0.0 <= lam <= 1.0:
        raise ValueError(f"lam must be in [0, 1], got {lam}")
    b = base.counts.select("token", F.col("n").alias("n_base"))
    d = domain.counts.select("token", F.col("n").alias("n_dom"))
    j = b.join(d, "token", "full_outer")
    p_base = F.coalesce(base.prob(F.col("n_base")), F.lit(base.unk_p))
    p_dom = F.coalesce(domain.prob(F.col("n_dom")), F.lit(domain.unk_p))
    table = j.select(
        "token",
        p_base.alias("p_base"),
        (F.lit(float(lam)) * p_dom + F.lit(1.0 - float(lam)) * p_base).alias("p_tuned"),
    )
    unk_tuned = lam * domain.unk_p + (1.0 - lam) * base.unk_p
    return AdaptedModel(table, base.unk_p, unk_tuned, float(lam))


# ---------------------------------------------------------------- count matrix (join-free path)


@dataclass
class CountMatrix:
    """token x tag count matrix: one row per distinct token with ``n_<tag>`` (occurrences in
    the truncated sequence) and ``v_<tag>`` (occurrences at scored positions) for every tag.
    The row with a null token holds the number of texts of each tag. Checkpointed."""

    table: DataFrame
    tags: tuple[str, ...]
    totals: dict[str, int]
    vocab: dict[str, int]
    texts: dict[str, int]

    def denom(self, tag: str) -> float:
        return float(self.totals[tag] + self.vocab[tag] + 1)

    def prob(self, tag: str) -> Column:
        n = F.col(f"n_{tag}")
        d = F.lit(self.denom(tag))
        return F.when(n > 0, (n.cast("double") + F.lit(1.0)) / d).otherwise(F.lit(1.0) / d)

    def tuned_prob(self, base: str, domain: str, lam: float) -> Column:
        return F.lit(float(lam)) * self.prob(domain) + F.lit(1.0 - float(lam)) * self.prob(base)

    def model_table(self, base: str, domain: str, lam: float) -> DataFrame:
        """token, p_base, p_tuned over the union of both vocabularies."""
        t = self.table.where(F.col("token").isNotNull() & ((F.col(f"n_{base}") > 0) | (F.col(f"n_{domain}") > 0)))
        return t.select("token", self.prob(base).alias("p_base"), self.tuned_prob(base, domain, lam).alias("p_tuned"))


def token_count_matrix(
    texts: DataFrame,
    text_col: str,
    tag_col: str,
    tags: tuple[str, ...],
    max_length: int | None | dict[str, int | None] = DEFAULT_MAX_LENGTH,
) -> CountMatrix:
    """One tokenize/explode pass and one ``groupBy(token)`` (partial aggregation folds hot
    tokens map-side) for all tags at once; a null sentinel per text carries text counts.
    ``max_length`` is one limit, or one for each tag (None: whole texts)."""
    toks = tokenize(text_col)
    if isinstance(max_length, dict):
        whole = toks
        for tag, limit in max_length.items():
            if limit:
                toks = F.when(F.col(tag_col) == tag, truncate(whole, limit)).otherwise(toks)
    elif max_length:
        toks = truncate(toks, max_length)
    seq = F.concat(F.array(F.lit(None).cast("string")), toks)
    ex = texts.where(F.col(tag_col).isin(*tags)).select(
        F.col(tag_col).alias("__tag"), F.posexplode(seq).alias("pos", "token")
    )
    aggs = []
    for t in tags:
        is_t = F.col("__tag") == t
        aggs.append(F.count(F.when(is_t, F.lit(1))).alias(f"n_{t}"))
        aggs.append(F.count(F.when(is_t & (F.col("pos") >= 2), F.lit(1))).alias(f"v_{t}"))
    table = checkpointed(ex.groupBy("token").agg(*aggs))
    real = F.col("token").isNotNull()
    stats = table.agg(
        *[F.sum(F.when(real, F.col(f"n_{t}"))).alias(f"tot_{t}") for t in tags],
        *[F.count(F.when(real & (F.col(f"n_{t}") > 0), F.lit(1))).alias(f"voc_{t}") for t in tags],
        *[F.sum(F.when(~real, F.col(f"n_{t}"))).alias(f"txt_{t}") for t in tags],
    ).first()
    return CountMatrix(
        table,
        tuple(tags),
        {t: int(stats[f"tot_{t}"] or 0) for t in tags},
        {t: int(stats[f"voc_{t}"] or 0) for t in tags},
        {t: int(stats[f"txt_{t}"] or 0) for t in tags},
    )
