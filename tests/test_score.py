from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from sftlake.functions.tokens import py_tokenize
from sftlake.operators.model import adapt_token_model, fit_token_model
from sftlake.operators.score import (
    LengthScorerFactory,
    compare,
    metrics_from_sums,
    perplexity,
    plugin_metrics,
    relative_change,
    score_models,
    score_with_plugin,
)

# Golden records of the published runs (token-weighted NLL, perplexity, delta).
BASE = (375810, 3.261898119194074, 26.099029225041793)
TUNED32 = (375810, 1.9769546440953707, 7.220719806274967)
TUNED16 = (375810, 1.9988173816264563, 7.380322830504613)
DELTA32, DELTA16 = -1.2849434750987034, -1.2630807375676179


def test_perplexity_guard_and_golden(spark):
    df = spark.createDataFrame([(3.261898119194074,), (19.999,), (20.0,), (0.0,)], "m double")
    out = [r.p for r in df.select(perplexity(F.col("m")).alias("p")).collect()]
    assert out[0] == BASE[2]
    assert math.isfinite(out[1]) and out[2] == float("inf") and out[3] == 1.0


def test_zero_tokens_mean_zero(spark):
    df = spark.createDataFrame([("m", 3, 0, None)], "model string, num_texts long, num_tokens long, s double")
    r = metrics_from_sums(df, "model", "s").first()
    assert (r.mean_nll, r.perplexity) == (0.0, 1.0)


def _golden_metrics(spark, tuned):
    return spark.createDataFrame(
        [("base", 2000, BASE[0], BASE[1], BASE[2]), ("tuned", 2000, tuned[0], tuned[1], tuned[2])],
        "model string, num_texts long, num_tokens long, mean_nll double, perplexity double",
    )


def test_golden_delta_and_relative_change(spark):
    c32 = compare(_golden_metrics(spark, TUNED32)).first()
    assert c32.delta_mean_nll == DELTA32 and c32.num_samples == 2000
    assert compare(_golden_metrics(spark, TUNED16)).first().delta_mean_nll == DELTA16
    r = relative_change(compare(_golden_metrics(spark, TUNED32))).first()
    assert round(r.nll_pct, 4) == -39.3925 and round(r.ppl_pct, 4) == -72.3334
    r16 = relative_change(compare(_golden_metrics(spark, TUNED16))).first()
    assert round(r16.nll_pct, 4) == -38.7223 and round(r16.ppl_pct, 4) == -71.7218


def _texts(spark):
    rows = [(i, t) for i, t in enumerate([
        "the cat sat on the mat", "the dog sat", "", "one", "a b c d e f g h i j k", "世界 hello 世界",
    ])]
    return spark.createDataFrame(rows, "row_id long, text string")


def _brute_force(train, dom, evals, lam, max_length):
    def counts(texts):
        c = {}
        for t in texts:
            for tok in py_tokenize(t)[:max_length]:
                c[tok] = c.get(tok, 0) + 1
        return c

    cb, cd = counts(train), counts(dom)
    db, dd = sum(cb.values()) + len(cb) + 1, sum(cd.values()) + len(cd) + 1

    def pb(t):
        return (cb[t] + 1) / db if t in cb else 1 / db

    def pd_(t):
        return (cd[t] + 1) / dd if t in cd else 1 / dd

    sb = st = 0.0
    n = 0
    for t in evals:
        for tok in py_tokenize(t)[:max_length][1:]:
            sb += -math.log(pb(tok))
            st += -math.log(lam * pd_(tok) + (1 - lam) * pb(tok))
            n += 1
    return n, sb / max(n, 1), st / max(n, 1)


def test_bundled_scoring_matches_brute_force(spark):
    base_txt = ["the cat and the dog", "hello world", "世界 世界 界"]
    dom_txt = ["a b c", "the mat", "sat sat sat"]
    evals = _texts(spark)
    b = fit_token_model(spark.createDataFrame([(t,) for t in base_txt], "text string"), "text", 4)
    d = fit_token_model(spark.createDataFrame([(t,) for t in dom_txt], "text string"), "text", 4)
    m = {r.model: r for r in score_models(evals, "text", adapt_token_model(b, d, 0.3), 4).collect()}
    n, mb, mt = _brute_force(base_txt, dom_txt, [r.text for r in evals.collect()], 0.3, 4)
    assert m["base"].num_tokens == n and m["base"].num_texts == 6
    assert m["base"].mean_nll == pytest.approx(mb, abs=1e-12)
    assert m["tuned"].mean_nll == pytest.approx(mt, abs=1e-12)


def test_plugin_is_batch_invariant_and_scores_all_models_in_one_pass(spark):
    import math

    from sftlake.functions.tokens import py_tokenize

    evals = _texts(spark)
    want = [math.log1p(len(t)) for r in evals.collect() for t in py_tokenize(r.text)[:16][1:]]
    for batch in ("1", "1000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        scorers = {"base": LengthScorerFactory(1.0, 16), "tuned": LengthScorerFactory(0.5, 16)}
        per_text = score_with_plugin(evals.withColumn("row_id", F.col("row_id").cast("string")), "row_id", "text", scorers, cache_key=f"t{batch}")
        assert per_text._jdf.queryExecution().executedPlan().toString().count("MapInPandas") == 1
        m = {r.model: r for r in plugin_metrics(per_text, ["base", "tuned"]).collect()}
        assert m["base"].num_tokens == len(want) and m["base"].mean_nll == pytest.approx(sum(want) / len(want))
        assert m["tuned"].mean_nll == pytest.approx(m["base"].mean_nll / 2)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_adapt_rejects_bad_lambda(spark):
    b = fit_token_model(spark.createDataFrame([("a b",)], "text string"), "text")
    with pytest.raises(ValueError):
        adapt_token_model(b, b, 1.5)


def test_count_matrix_scoring_matches_brute_force(spark):
    from sftlake.operators.model import token_count_matrix
    from sftlake.operators.score import score_count_matrix

    base_txt = ["the cat and the dog", "hello world", "世界 世界 界"]
    dom_txt = ["a b c", "the mat", "sat sat sat"]
    eval_txt = [r.text for r in _texts(spark).collect()]
    rows = [(t, "base") for t in base_txt] + [(t, "domain") for t in dom_txt] + [(t, "eval") for t in eval_txt]
    texts = spark.createDataFrame(rows + [("ignored text", "other")], "text string, tag string")
    mx = token_count_matrix(texts, "text", "tag", ("base", "domain", "eval"), 4)
    assert mx.texts == {"base": 3, "domain": 3, "eval": 6}
    m = {r.model: r for r in score_count_matrix(mx, "eval", "base", "domain", 0.3).collect()}
    n, mb, mt = _brute_force(base_txt, dom_txt, eval_txt, 0.3, 4)
    assert m["base"].num_tokens == n and m["tuned"].num_texts == 6
    assert m["base"].mean_nll == pytest.approx(mb, abs=1e-12)
    assert m["tuned"].mean_nll == pytest.approx(mt, abs=1e-12)
    plan = score_count_matrix(mx, "eval", "base", "domain", 0.3)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_score_token_counts_equals_texts_path(spark):
    from sftlake.operators.score import score_token_counts, valid_token_counts

    b = fit_token_model(spark.createDataFrame([("the cat and the dog",)], "text string"), "text", 8)
    ad = adapt_token_model(b, b, 0.5)
    evals = _texts(spark)
    a = {r.model: r for r in score_models(evals, "text", ad, 8).collect()}
    c = {r.model: r for r in score_token_counts(valid_token_counts(evals, "text", 8), evals.count(), ad).collect()}
    assert a["base"].num_tokens == c["base"].num_tokens and a["base"].num_texts == c["base"].num_texts
    assert a["tuned"].mean_nll == pytest.approx(c["tuned"].mean_nll, abs=1e-12)


def test_relative_change_of_zero_base_is_null(spark):
    m = spark.createDataFrame(
        [("base", 0, 0, 0.0, 1.0), ("tuned", 0, 0, 0.0, 1.0)],
        "model string, num_texts long, num_tokens long, mean_nll double, perplexity double",
    )
    r = relative_change(compare(m)).first()
    assert r.nll_pct is None and r.ppl_pct == 0.0


def test_sums_do_not_depend_on_the_order_of_rows(spark):
    from sftlake.operators.score import exact_loss, score_token_counts

    rows = [(f"t{k}", 1 + k * k % 97, (k + 1) / 7e5) for k in range(1000)]
    df = spark.createDataFrame(rows, "token string, cnt long, p double")
    sums = set()
    for n, by in [(1, "token"), (7, "token"), (13, "cnt"), (5, "p")]:
        part = df.repartition(n, by).sortWithinPartitions(by)
        sums.add(part.agg(F.sum(exact_loss(F.col("p"), F.col("cnt"))).alias("s")).first().s)
    assert len(sums) == 1
    want = math.fsum(-math.log(p) * c for _, c, p in rows)
    assert abs(float(sums.pop()) - want) < 1e-6
    texts = spark.createDataFrame([(" ".join(f"t{k % 37}" for k in range(j, 3 * j + 2)),) for j in range(60)], "text string")
    model = fit_token_model(texts, "text", None)
    counts = [texts.repartition(n).select(F.explode(F.split("text", " ")).alias("token")).groupBy("token").agg(F.count("*").alias("cnt")) for n in (1, 3, 11)]
    assert len({tuple(score_token_counts(c, 60, model).first()) for c in counts}) == 1
