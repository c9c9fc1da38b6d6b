"""Quality rules: text statistics as Spark expressions, and a decision list learned from
labelled statistics by sequential covering (grow on two thirds, prune on one third), which is
emitted as one ordered conditional expression.

Null and empty texts have zero statistics. The whole text is always read. Rows stay as they
are: no join and no shuffle on the scoring path, so nulls, ties and repeated rows pass through.
Columns named as the base counts, rule, base_failed or kept are replaced, others stay.
Learning reads about ``FIT_ROWS`` labelled rows; without labels of both kinds the list is empty
and keeps every document."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftlake.llm.common import bounded_rows, bounded_sample

FIT_ROWS = 20_000
WINDOW = 8
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("n_words", "word_len", "symbols", "dup_lines", "repeats", "distinct", "upper", "marks", "line_words")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once. A plain reference could be replaced by its
    definition (a filter pushed below a projection does that) and then be computed again for
    every element of an inner lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _has_twin(pairs: Column, x: Column, k: Column) -> Column:
    """Whether a neighbour in the sorted (hash, position) pairs has the same hash."""
    before = (k > 0) & (F.element_at(pairs, F.greatest(k, F.lit(1)))["h"] == x["h"])
    return before | ((k + 1 < F.size(pairs)) & (F.element_at(pairs, F.least(k + 2, F.size(pairs)))["h"] == x["h"]))


def _covered(positions: Column) -> Column:
    """Words under windows that start at the sorted positions."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("last"))
    step = lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).cast("bigint").alias("n"), i.alias("last"))
    return F.aggregate(positions, start, step, lambda a: a["n"])


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the five base counts (long) and ``__f``, a struct of the features the rules test.

    ``n_repeat_words``: words inside a window of 8 words found twice or more in the text. A
    text whose windows are all different is settled by comparing two set sizes; only the
    others sort their (hash, position) pairs to find the positions of repeated windows."""
    t = F.coalesce(F.col(text), F.lit(""))
    out = df.withColumn("__words", F.filter(F.split(F.translate(t, "\t\n\x0b\x0c\r", "     "), " "), lambda w: w != ""))
    hashes = _let(
        F.col("__words"),
        lambda w: F.when(
            F.size(w) >= WINDOW,
            F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(F.slice(w, i + 1, WINDOW))),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    out = out.withColumn("__windows", hashes)
    repeats = F.when(
        F.size(F.array_distinct("__windows")) < F.size("__windows"),
        _let(
            F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
            lambda s: _covered(F.array_sort(F.filter(F.transform(s, lambda x, k: F.when(_has_twin(s, x, k), x["i"])), lambda i: i.isNotNull()))),
        ),
    )
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, " \t\x0b\x0c\r", "")) > 0)
    chars = F.length(F.translate(t, " \t\n\x0b\x0c\r", ""))
    out = out.withColumn("__lines", lines).withColumns(
        {
            "n_words": F.size("__words").cast("long"),
            "word_chars": chars.cast("long"),
            "n_symbols": (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "n_repeat_words": F.coalesce(repeats, F.lit(0)).cast("long"),
        }
    )
    n, c, m = (F.greatest(x, F.lit(1)) for x in (F.col("n_words"), F.col("word_chars"), F.size("__lines")))
    of = {
        "n_words": F.col("n_words").cast("double"),
        "word_len": F.col("word_chars") / n,
        "symbols": F.col("n_symbols") / c,
        "dup_lines": F.col("n_dup_lines") / m,
        "repeats": F.col("n_repeat_words") / n,
        "distinct": F.size(F.array_distinct("__words")) / n,
        "upper": (F.length(t) - F.length(F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))) / c,
        "marks": (F.length(t) - F.length(F.translate(t, "!?", ""))) / c,
        "line_words": F.col("n_words") / m,
    }
    out = out.withColumn("__f", F.struct(*[of[k].alias(k) for k in FEATURES]))
    return out.drop("__words", "__windows", "__lines")


@dataclass(frozen=True)
class Condition:
    feature: int
    at_least: bool
    cut: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, self.feature]
        return v >= self.cut if self.at_least else v < self.cut

    def column(self) -> Column:
        c = F.col(f"__f.{FEATURES[self.feature]}")
        return c >= F.lit(self.cut) if self.at_least else c < F.lit(self.cut)


def covers(rule: list[Condition], x: np.ndarray) -> np.ndarray:
    keep = np.ones(len(x), bool)
    for c in rule:
        keep &= c.holds(x)
    return keep


def _grow(x: np.ndarray, bad: np.ndarray, cuts: list[np.ndarray]) -> list[Condition]:
    rule: list[Condition] = []
    inside = np.ones(len(x), bool)
    while bad[inside].any() and not bad[inside].all() and len(rule) < 4:
        p, n = bad[inside].sum(), (~bad[inside]).sum()
        best, chosen = 1e-9, None
        for f, at in enumerate(cuts):
            v, y = x[inside, f], bad[inside]
            where = np.searchsorted(at, v, "right")  # cuts that are <= v
            pos = np.bincount(where[y], minlength=len(at) + 1)
            neg = np.bincount(where[~y], minlength=len(at) + 1)
            over_p, over_n = pos[::-1].cumsum()[::-1][1:], neg[::-1].cumsum()[::-1][1:]
            for at_least, pp, nn in ((True, over_p, over_n), (False, p - over_p, n - over_n)):
                gain = np.where(pp > 0, pp * (np.log2((pp + 1e-9) / (pp + nn + 1e-9)) - np.log2(p / (p + n))), -1)
                if len(gain) and gain.max() > best:
                    best, chosen = gain.max(), Condition(f, at_least, float(at[gain.argmax()]))
        if chosen is None:
            break
        rule.append(chosen)
        inside &= chosen.holds(x)
    return rule


def _prune(rule: list[Condition], x: np.ndarray, bad: np.ndarray) -> list[Condition]:
    def worth(r: list[Condition]) -> float:
        c = covers(r, x)
        p, n = bad[c].sum(), (~bad[c]).sum()
        return (p - n) / (p + n) if p + n else -1.0

    options = [rule[:k] for k in range(1, len(rule) + 1)]
    return max(options, key=lambda r: (worth(r), -len(r)))


def learn(x: np.ndarray, bad: np.ndarray, precision: float = 0.8, max_rules: int = 12, seed: int = 7) -> list[list[Condition]]:
    """Rules that each mark bad rows, found one after another; the rows a rule covers leave
    before the next is grown. A pruned rule whose precision on the pruning third is under
    ``precision`` ends the list."""
    rules: list[list[Condition]] = []
    order = np.random.default_rng(seed).permutation(len(x))
    x, bad = x[order], bad[order]
    while len(rules) < max_rules and bad.sum() >= 3 and (~bad).any():
        third = np.arange(len(x)) % 3 == 2
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, 129)[1:-1])) for f in range(x.shape[1])]
        cuts = [np.unique(np.concatenate([c, (c[1:] + c[:-1]) / 2])) for c in cuts]
        rule = _grow(x[~third], bad[~third], cuts)
        if not rule:
            break
        rule = _prune(rule, x[third], bad[third])
        c = covers(rule, x[third])
        if not c.any() or bad[third][c].mean() < precision:
            break
        rules.append(rule)
        left = ~covers(rule, x)
        x, bad = x[left], bad[left]
    return rules


def fit(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> list[list[Condition]]:
    """The decision list from about ``fit_rows`` labelled documents (their ids are bounded by
    that number, hence broadcast; so are their rows, whatever ids are repeated, whose statistics,
    nine numbers a row, come to the driver)."""
    known = labels.select(F.col("doc_id").alias("__id"), F.col("quality").alias("__q")).dropna()
    known = bounded_sample(known.groupBy("__id").agg(F.min("__q").alias("__q")), fit_rows, "__id")
    rows = documents.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("__id"))
    rows = bounded_rows(rows.select("doc_id", "text", "__q"), fit_rows, "doc_id", "text")
    rows = with_statistics(rows.select("text", "__q")).select("__q", "__f").collect()
    if not rows:
        return []
    x = np.array([list(r["__f"]) for r in rows], float)
    order = np.lexsort(x.T)
    return learn(x[order], np.array([r["__q"] == 0 for r in rows])[order])


def verdict(rules: list[list[Condition]]) -> Column:
    """One ordered conditional: the name of the first rule that rejects, else null."""
    out = None
    for k, rule in enumerate(rules):
        test = rule[0].column()
        for c in rule[1:]:
            test = test & c.column()
        out = (F if out is None else out).when(test, F.lit(f"rule{k + 1}"))
    return out if out is not None else F.lit(None).cast("string")


def quality_rules(documents: DataFrame, rules: list[list[Condition]]) -> DataFrame:
    """Adds the base counts, base_failed, rule (the learned rule that rejects, or null) and kept."""
    out = with_statistics(documents).withColumn("rule", verdict(rules))
    out = out.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()).drop("__f")
