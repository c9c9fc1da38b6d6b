"""Bundled bigram model: fit, per-position losses, and greedy decoding.

fit:    counts n(u, v) of neighbouring tokens over whole training texts, each closed by ``END``
        (a line feed, which is never a token). Absolute discounting, interpolated with a
        continuation model:

            p(v | u) = max(n(u, v) - D, 0) / n(u) + D * t(u) / n(u) * c(v)
            c(v)     = (predecessors of v + 1) / (distinct pairs + distinct v + 1)

        where t(u) is the number of distinct successors of u. An unseen v has c = 1 / (pairs + v + 1),
        an unseen u has p(v | u) = c(v); the probabilities of a context, with one unseen token, sum to 1.
score:  nll of every position but the first, as (text_id, pos, nll). Distinct pairs are priced
        first (no pair is hot there); positions then fetch their price by pair. A pair that more
        than ``HOT_ROWS`` positions ask for has its price replicated, and its positions
        spread over the copies, so no task holds all positions of a hot pair.
decode: the most likely successor again and again. What follows depends on the last token alone,
        so the frontier holds distinct last tokens, not prompts: at most a row a vocabulary entry.

Everything is joins and partial aggregates; only three totals and one token reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftlake.functions.text import normalize_text
from sftlake.functions.tokens import DEFAULT_MAX_LENGTH, tokenize, truncate
from sftlake.sources.scratch import checkpointed

END = "\n"
DISCOUNT = 0.75
HOT_ROWS = 1 << 20
ROUNDS_A_TABLE = 8
BROADCAST_PAIRS = 100_000


def neighbours(tokens: DataFrame, *keep: str) -> DataFrame:
    """keep, pos (from 0), u, v for the neighbouring tokens of each row (keep, t). ``t`` is a column
    that was worked out before, so that a text is cut into tokens once."""
    n = F.greatest(F.size("t") - 1, F.lit(0))
    both = F.arrays_zip(F.slice("t", 1, n), F.slice("t", 2, n))
    at = tokens.select(*keep, F.posexplode(both).alias("pos", "x"))
    return at.selectExpr(*(f"`{c}`" for c in keep), "pos", "x.`0` as u", "x.`1` as v")


def token_rows(texts: DataFrame, text_col: str, make, *keep: str) -> DataFrame:
    """keep, t: what ``make`` makes of the tokens of a text."""
    # An exploded array stays apart from what reads it; projections would be merged and worked out again.
    return texts.select(*keep, F.explode(F.array(make(tokenize(text_col)))).alias("t"))


@dataclass
class BigramModel:
    pairs: DataFrame  # u, v, n
    contexts: DataFrame  # u, n_u, t_u
    continuation: DataFrame  # v, c
    n_pairs: int
    n_tokens: int
    top: str | None  # the most likely token after an unseen one

    @property
    def unseen(self) -> float:
        return 1.0 / float(self.n_pairs + self.n_tokens + 1)

    def price(self, pairs: DataFrame) -> DataFrame:
        """Adds p to rows (u, v, ...), each pair at most once or few times."""
        return self._priced(pairs.join(self.pairs.withColumnsRenamed({"n": "__n"}), ["u", "v"], "left"))

    def met(self) -> DataFrame:
        """u, v, n, p of every pair met in training, which is its own count."""
        return self._priced(self.pairs.withColumn("__n", F.col("n")))

    def _priced(self, counted: DataFrame) -> DataFrame:
        # The tables of contexts and tokens have a row a distinct token: hashed, the pairs aren't sorted.
        known = counted.join(self.contexts.hint("shuffle_hash"), "u", "left").join(self.continuation.hint("shuffle_hash"), "v", "left")
        p = probability(F.col("__n"), F.col("n_u"), F.col("t_u"), F.coalesce("c", F.lit(self.unseen)))
        return known.withColumn("p", p).drop("__n", "n_u", "t_u", "c")

    def table(self) -> DataFrame:
        """context, token, n, p of every pair met in training."""
        return self.met().select(F.col("u").alias("context"), F.col("v").alias("token"), "n", "p")


def probability(n: Column, n_u: Column, t_u: Column, c: Column) -> Column:
    seen = F.greatest(F.coalesce(n, F.lit(0)).cast("double") - DISCOUNT, F.lit(0.0)) / n_u
    return F.when(n_u.isNull(), c).otherwise(seen + F.lit(DISCOUNT) * t_u / n_u * c)


def fit_bigram_model(texts: DataFrame, text_col: str = "text") -> BigramModel:
    """The model of the whole texts. A null text has no tokens."""
    closed = token_rows(texts, text_col, lambda t: F.concat(F.coalesce(t, F.array().cast("array<string>")), F.array(F.lit(END))))
    pairs = checkpointed(neighbours(closed).groupBy("u", "v").agg(F.count(F.lit(1)).alias("n")))
    contexts = checkpointed(pairs.groupBy("u").agg(F.sum("n").alias("n_u"), F.count(F.lit(1)).alias("t_u")))
    before = checkpointed(pairs.groupBy("v").agg(F.count(F.lit(1)).alias("k")))
    row = before.agg(F.sum("k").alias("pairs"), F.count(F.lit(1)).alias("v"), F.min(F.struct(-F.col("k"), "v")).alias("top")).first()
    n_pairs, n_tokens = int(row["pairs"] or 0), int(row["v"])
    c = (F.col("k") + 1).cast("double") / F.lit(float(n_pairs + n_tokens + 1))
    return BigramModel(pairs, contexts, before.select("v", c.alias("c")), n_pairs, n_tokens, row["top"]["v"] if n_tokens else None)


def position_nll(texts: DataFrame, model: BigramModel, id_col: str, text_col: str = "text", max_length: int | None = DEFAULT_MAX_LENGTH) -> DataFrame:
    """id_col, pos, nll of every position but the first of each text, up to ``max_length`` tokens.
    Texts of fewer than two tokens, and null ones, have none."""
    toks = token_rows(texts, text_col, lambda t: truncate(t, max_length) if max_length else t, id_col)
    at = neighbours(toks, id_col).withColumn("pos", (F.col("pos") + 1).cast("long"))
    asked = checkpointed(at.groupBy("u", "v").agg(F.count(F.lit(1)).alias("asked")))
    priced = checkpointed(model.price(asked).select("u", "v", "asked", (-F.log("p")).alias("nll")))
    return fetch_prices(at, priced).select(id_col, "pos", "nll")


def fetch_prices(at: DataFrame, priced: DataFrame) -> DataFrame:
    """``at`` (u, v, pos, ...) with nll from ``priced`` (u, v, asked, nll). The copies of a hot
    pair are told apart by ``copy``; which pairs are hot is few (a row for HOT_ROWS positions)."""
    copies = F.ceil(F.col("asked") / F.lit(HOT_ROWS)).cast("int")
    hot = checkpointed(priced.where(copies > 1).select("u", "v", copies.alias("copies")))
    many = hot.count()
    if not many:
        return at.join(priced.select("u", "v", "nll"), ["u", "v"])
    hot = F.broadcast(hot) if many <= BROADCAST_PAIRS else hot
    spread = at.join(hot, ["u", "v"], "left").withColumn("copy", F.coalesce(F.pmod(F.xxhash64(*[c for c in at.columns]), F.col("copies")), F.lit(0)).cast("int"))
    prices = priced.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1))).select("u", "v", "copy", "nll")
    return spread.join(prices, ["u", "v", "copy"]).drop("copies", "copy")


def best_successors(model: BigramModel) -> DataFrame:
    """u, v: the most likely token after each context; of equals the first by bytes. No token that
    never followed u can beat the most continued one, so that one and the seen ones are all
    there is to compare."""
    top = model.continuation.where(F.col("v") == F.lit(model.top)).select(F.col("c").alias("top_c"))
    seen = model.met().groupBy("u").agg(F.min(F.struct((-F.col("p")).alias("q"), F.col("v").alias("v"))).alias("best"))
    both = seen.join(model.contexts, "u").crossJoin(F.broadcast(top))  # one row
    other = F.struct((-(F.lit(DISCOUNT) * F.col("t_u") / F.col("n_u") * F.col("top_c"))).alias("q"), F.lit(model.top).alias("v"))
    return both.select("u", F.least("best", other)["v"].alias("next"))


def last_token(text_col: str) -> Column:
    """The last token of a text, null without any. A token ends at white space, so only what
    stands after the last of it is cut into tokens."""
    apart = F.translate(F.col(text_col), "\t\n\x0b\x0c\r", "     ")
    return F.try_element_at(tokenize(F.substring_index(F.rtrim(apart), " ", -1)), F.lit(-1))


def generate_greedy(prompts: DataFrame, model: BigramModel, id_col: str, prompt_col: str, max_new_tokens: int = 256) -> DataFrame:
    """id_col, output: up to ``max_new_tokens`` tokens after each prompt, without the prompt, ended
    by END, joined by spaces and stripped. A prompt without tokens, or a model of no
    texts, gives an empty output."""
    last = prompts.select(F.col(id_col), last_token(prompt_col).alias("start"))
    if model.top is None:
        return last.select(id_col, F.lit("").alias("output"))
    best = checkpointed(best_successors(model))
    frontier = checkpointed(last.where("start is not null").select("start").distinct())
    frontier = frontier.select("start", F.col("start").alias("at"), F.array().cast("array<string>").alias("out"))
    for k in range(max_new_tokens):
        frontier = frontier.join(best.withColumnRenamed("u", "at"), "at", "left")
        over = F.col("at") == END
        following = F.when(over, F.lit(END)).otherwise(F.coalesce("next", F.lit(model.top)))
        frontier = frontier.select("start", following.alias("at"), F.when(following == END, F.col("out")).otherwise(F.concat("out", F.array(following))).alias("out"))
        if (k + 1) % ROUNDS_A_TABLE == 0:
            frontier = checkpointed(frontier)
            if frontier.where(F.col("at") != END).isEmpty():
                break
    said = frontier.select("start", normalize_text(F.array_join("out", " ")).alias("output"))
    return last.join(said, "start", "left").select(id_col, F.coalesce("output", F.lit("")).alias("output"))
