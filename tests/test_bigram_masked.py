"""Bigram model, per-position losses, greedy decoding, masked scoring and batches against plain Python."""

import collections
import math
import random

import pytest
from pyspark.sql import functions as F

from sftlake.operators import bigram, masked
from sftlake.operators.model import fit_token_model

TEXTS = [(1, "the cat sat on the mat"), (2, "the dog sat on the cat"), (3, ""), (4, None), (5, "one"), (6, "the the the the"), (7, "漢字 and the cat")]


def tokens(text):
    from sftlake.functions.tokens import py_tokenize

    return py_tokenize(text or "")


class Plain:
    def __init__(self, texts):
        self.n = collections.Counter()
        for t in texts:
            seq = [*tokens(t), bigram.END]
            self.n.update(zip(seq, seq[1:], strict=False))
        self.succ, self.pred = collections.defaultdict(dict), collections.Counter()
        for (u, v), k in self.n.items():
            self.succ[u][v] = k
            self.pred[v] += 1
        self.den = len(self.n) + len(self.pred) + 1

    def c(self, v):
        return (self.pred.get(v, 0) + 1) / self.den

    def p(self, u, v):
        if u not in self.succ:
            return self.c(v)
        total = sum(self.succ[u].values())
        return max(self.succ[u].get(v, 0) - 0.75, 0) / total + 0.75 * len(self.succ[u]) / total * self.c(v)


def frame(spark, rows, names="id long, text string"):
    return spark.createDataFrame(rows, names)


def test_model_against_plain_counts_and_sums(spark):
    model = bigram.fit_bigram_model(frame(spark, TEXTS))
    plain = Plain([t for _, t in TEXTS])
    got = {(r.context, r.token): (r.n, r.p) for r in model.table().collect()}
    assert set(got) == set(plain.n)
    for (u, v), (n, p) in got.items():
        assert n == plain.n[u, v] and math.isclose(p, plain.p(u, v), rel_tol=1e-12)
    for u in plain.succ:  # all tokens, and one unseen
        assert math.isclose(sum(plain.p(u, v) for v in plain.pred) + plain.p(u, "nie gesehen"), 1.0, rel_tol=1e-9)


def test_positions_against_plain_and_unseen_tokens(spark):
    model, plain = bigram.fit_bigram_model(frame(spark, TEXTS)), Plain([t for _, t in TEXTS])
    rows = [*TEXTS, (8, "new words the cat"), (9, "cat new cat"), (9, "cat new cat")]
    for limit in (None, 3):
        got = sorted((r.id, r.pos, r.nll) for r in bigram.position_nll(frame(spark, rows), model, "id", max_length=limit).collect())
        want = sorted((d, i, -math.log(plain.p(*x))) for d, t in rows for s in [tokens(t)[:limit]] for i, x in enumerate(zip(s, s[1:], strict=False), 1))
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert all(math.isclose(g[2], w[2], rel_tol=1e-12) for g, w in zip(got, want, strict=True))


@pytest.mark.parametrize("few", [bigram.BROADCAST_PAIRS, 0])
def test_a_hot_pair_is_spread_over_copies(spark, monkeypatch, few):
    """One pair at a third of all positions: its price is copied, and no copy serves
    more than about its share of them."""
    monkeypatch.setattr(bigram, "HOT_ROWS", 50)
    monkeypatch.setattr(bigram, "BROADCAST_PAIRS", few)
    rng = random.Random(3)
    texts = [(k, " ".join("to be" if rng.random() < 0.4 else f"w{rng.randrange(400)}" for _ in range(30))) for k in range(60)]
    model, plain = bigram.fit_bigram_model(frame(spark, texts)), Plain([t for _, t in texts])
    seen = []
    whole = bigram.fetch_prices

    def spied(at, priced):
        out = whole(at, priced)
        seen.append(priced.where(f"asked > {bigram.HOT_ROWS}").count())
        return out

    monkeypatch.setattr(bigram, "fetch_prices", spied)
    out = bigram.position_nll(frame(spark, texts), model, "id")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert seen[0] > 0 and "pmod(xxhash64(" in plan and "explode(sequence(" in plan
    got = {(r.id, r.pos): r.nll for r in out.collect()}
    want = {(d, i): -math.log(plain.p(*x)) for d, t in texts for s in [tokens(t)] for i, x in enumerate(zip(s, s[1:], strict=False), 1)}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-12) for k in want)


def greedy(plain, start, n):
    out, at = [], start
    everything = sorted(plain.pred)
    for _ in range(n):
        if at in plain.succ:
            at = min(everything, key=lambda v: (-plain.p(at, v), v.encode()))
        else:
            at = min(everything, key=lambda v: (-plain.pred[v], v.encode()))
        if at == bigram.END:
            break
        out.append(at)
    return " ".join(out).strip()


@pytest.mark.parametrize("n", [0, 1, 5, 20])
def test_greedy_decoding(spark, n):
    rng = random.Random(n)
    texts = [(k, " ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(1, 25)))) for k in range(80)]
    model, plain = bigram.fit_bigram_model(frame(spark, texts)), Plain([t for _, t in texts])
    prompts = [(100, "say w3"), (101, "W3"), (102, "never met"), (103, ""), (104, None), (105, "w29\n"), (100, "w7")]
    got = sorted(tuple(r) for r in bigram.generate_greedy(frame(spark, prompts), model, "id", "text", n).collect())
    assert got == sorted((d, greedy(plain, tokens(t)[-1], n) if tokens(t) else "") for d, t in prompts)


def test_a_model_of_nothing(spark):
    for rows in ([], [(1, None), (2, "")]):
        model = bigram.fit_bigram_model(frame(spark, rows))
        assert model.table().count() == 0
        out = bigram.generate_greedy(frame(spark, [(1, "hello")]), model, "id", "text", 3).collect()
        assert [tuple(r) for r in out] == [(1, "")]
        got = bigram.position_nll(frame(spark, [(1, "a b")]), model, "id").collect()
        assert len(got) == 1 and got[0].nll == 0.0  # one unseen token holds all


# ------------------------------------------------------------------ masks


@pytest.mark.parametrize("bucket", [4, 7, 4096])
def test_interval_merge_against_plain_ranges(spark, monkeypatch, bucket):
    monkeypatch.setattr(masked, "BUCKET", bucket)
    rng = random.Random(bucket)
    positions = [(k, p, f"t{p}") for k in (1, 2, 3, None) for p in range(60)]
    spans = []
    for k in (1, 2, None):
        for _ in range(6):
            a = rng.randrange(60)
            spans.append((k, a, a + rng.randrange(0, 25)))
    got = masked.inside(frame(spark, positions, "conv_id long, pos long, token string"), frame(spark, spans, "conv_id long, token_start long, token_end long"))
    want = sorted(((k, p, t) for k, p, t in positions if any(s[0] == k and s[1] <= p < s[2] for s in spans)), key=str)
    assert got.columns == ["conv_id", "pos", "token"] and sorted(map(tuple, got.collect()), key=str) == want
    assert masked.inside(frame(spark, positions, "conv_id long, pos long, token string"), frame(spark, [], "conv_id long, token_start long, token_end long")).count() == 0


def test_masked_loss_and_the_mask_of_everything(spark):
    segs = [(1, 0, "system", "sys a\n"), (1, 1, "user", "a b c\n"), (1, 2, "assistant", "d e a\n"), (2, 0, "user", "a\n"), (2, 1, "assistant", "zz a\n"), (3, 5, "user", "")]
    segments = frame(spark, segs, "conv_id long, turn int, role string, seg string")
    model = fit_token_model(frame(spark, [(1, "a a b c d e")]), "text", None)
    n, den = collections.Counter("a a b c d e".split()), 6 + 5 + 1
    whole = {k: [t for s in segs if s[0] == k for t in s[3].split()] for k in (1, 2, 3)}
    loss = lambda t: -math.log((n[t] + 1) / den)
    every = [loss(t) for k in whole for t in whole[k][1:]]
    spans = [(1, 5, 8), (2, 0, 3)]
    part = [loss(t) for k, a, b in spans for i, t in enumerate(whole[k]) if a <= i < b and i]
    all_true = frame(spark, [(k, 0, 100) for k in (1, 2, 3)], "conv_id long, token_start long, token_end long")
    for mask, want in ((None, every), (all_true, every), (frame(spark, spans, "conv_id long, token_start long, token_end long"), part)):
        r = masked.masked_nll(segments, mask, model).first()
        assert (r.num_texts, r.num_tokens) == (3, len(want)) and math.isclose(r.mean_nll, sum(want) / len(want), rel_tol=1e-12)
        assert math.isclose(r.perplexity, math.exp(r.mean_nll), rel_tol=1e-9)
    assert masked.masked_nll(segments, all_true.limit(0), model).first().num_tokens == 0


@pytest.mark.parametrize("size", [1, 4, 7, 100])
def test_batches_in_row_order(spark, size):
    rng = random.Random(size)
    rows = [(3 * k, rng.randrange(0, 40) if k % 11 else None) for k in range(60)]
    got = sorted(map(tuple, masked.batch_plan(frame(spark, rows, "id long, n int").repartition(5), "id", "n", size).collect()))
    want = []
    for b in range(-(-len(rows) // size)):
        part = rows[b * size : (b + 1) * size]
        lens = [n or 0 for _, n in part]
        want.append((b, part[0][0], len(part), max(lens), sum(lens), max(lens) * len(part) - sum(lens)))
    assert got == want
    with pytest.raises(ValueError):
        masked.batch_plan(frame(spark, rows, "id long, n int"), "id", "n", 0)


def test_distinct_pairs_are_priced_once(spark):
    """Positions are shuffled to prices once; the model's tables meet distinct pairs alone."""
    model = bigram.fit_bigram_model(frame(spark, TEXTS))
    at = frame(spark, [(1, 1, "a", "b")], "id long, pos long, u string, v string")
    priced = frame(spark, [("a", "b", 1, 0.5)], "u string, v string, asked long, nll double")
    assert bigram.fetch_prices(at, priced).select("id", "pos", "nll").collect()[0].nll == 0.5
    assert model.pairs.groupBy("u", "v").count().where(F.col("count") > 1).isEmpty()


def test_met_pairs_are_priced_from_their_own_count(spark, capsys):
    """The table of met pairs needs the contexts and the tokens, not the pairs a second time, and
    gives what pricing them as asked pairs gives."""
    model = bigram.fit_bigram_model(frame(spark, [*TEXTS, (90, None), (91, ""), (91, "A a  a\tb")]))
    model.met().explain()
    plan = capsys.readouterr().out
    assert plan.count("Scan parquet") == 3 and "SortMergeJoin" not in plan
    asked = model.price(model.pairs.select("u", "v")).select("u", "v", "p")
    assert sorted(map(tuple, asked.collect())) == sorted(map(tuple, model.met().select("u", "v", "p").collect()))


def test_last_token_is_that_of_the_whole_text(spark):
    texts = ["", None, "  ", "a", "A b C ", "x\t\u4e2d\u6587\n", "\u4e2dab\x0b\r", "one two\u00a0THREE", "\u039f\u0394\u039f\u03a3 \u039f\u03a3.", "a\u2028b c\u4e2dd"]
    df = frame(spark, list(enumerate(texts)))
    whole = F.try_element_at(bigram.tokenize("text"), F.lit(-1))
    rows = df.select("text", bigram.last_token("text").alias("got"), whole.alias("want")).collect()
    assert [r.got for r in rows] == [r.want for r in rows] and rows[5].got == "\u6587"
