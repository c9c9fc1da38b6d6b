"""Property tests: each Hypothesis example is a whole batch, checked in one Spark job."""

from __future__ import annotations

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sftlake.functions.chat import DEFAULT_SYSTEM, render_chat
from sftlake.functions.text import normalize_text
from sftlake.functions.tokens import py_tokenize, tokenize
from sftlake.operators.split import split_sizes

WS = [chr(c) for c in range(0x110000) if chr(c).isspace()]
TEXT_ALPHABET = st.sampled_from(WS + list("abcXYZ019.,;!?-'\"éÉçàüßñ") + ["世", "界", "中", "文", "​"])
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.text(alphabet=TEXT_ALPHABET, max_size=30), min_size=1, max_size=40))
def test_normalize_equals_python_strip(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.n for r in df.select("i", normalize_text("t").alias("n")).collect()}
    assert got == {i: t.strip() for i, t in enumerate(texts)}


def _py_sizes(n, train, val):
    n_train, n_val = int(n * train), int(n * val)
    if n >= 3:
        n_train, n_val = max(n_train, 1), max(n_val, 1)
        if n_train + n_val >= n:
            n_val = max(1, n - n_train - 1)
    return n_train, n_val, n - n_train - n_val


@SETTINGS
@given(
    st.lists(st.integers(min_value=0, max_value=10**7), min_size=1, max_size=50),
    st.floats(min_value=0.01, max_value=0.98),
    st.floats(min_value=0.01, max_value=0.98),
)
def test_size_rule_equals_python(spark, ns, train, val):
    if train + val >= 1:
        val = (1 - train) / 2
    counts = spark.createDataFrame([(str(i), n) for i, n in enumerate(ns)], "kind string, n long")
    got = {int(r.kind): (r.n_train, r.n_val, r.n_test) for r in split_sizes(counts, train, val).collect()}
    assert got == {i: _py_sizes(n, train, val) for i, n in enumerate(ns)}


@SETTINGS
@given(st.lists(st.text(alphabet=TEXT_ALPHABET, max_size=60), min_size=1, max_size=30))
def test_jvm_tokenizer_equals_python_twin(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: list(r.k) for r in df.select("i", tokenize("t").alias("k")).collect()}
    assert got == {i: py_tokenize(t) for i, t in enumerate(texts)}


CONTENT = st.text(alphabet=st.sampled_from(list("ab c\n世界,.")), max_size=12)
MESSAGE = st.tuples(st.sampled_from(["user", "assistant", "system"]), CONTENT)


def _parse(text):
    blocks = re.findall(r"<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>\n", text, flags=re.S)
    return [(r, c) for r, c in blocks]


@SETTINGS
@given(st.lists(st.lists(MESSAGE, max_size=6), min_size=1, max_size=20))
def test_render_then_parse_round_trips(spark, convs):
    df = spark.createDataFrame([(i, m) for i, m in enumerate(convs)], "i int, m array<struct<role:string,content:string>>")
    got = {r.i: r.t for r in df.select("i", render_chat("m").alias("t")).collect()}
    for i, msgs in enumerate(convs):
        parsed = _parse(got[i])
        expect = list(msgs) if msgs and msgs[0][0] == "system" else [("system", DEFAULT_SYSTEM)] + list(msgs)
        assert parsed == expect


@SETTINGS
@given(
    st.lists(st.tuples(st.integers(0, 3), st.integers(0, 40)), min_size=1, max_size=40),
    st.integers(min_value=1, max_value=16),
)
def test_packing_equals_brute_force(spark, rows, block_len):
    from sftlake.operators.packing import pack_sequences

    data = [(shard, key, n) for key, (shard, n) in enumerate(rows)]
    df = spark.createDataFrame(data, "shard long, key long, n long")
    got = {(r.shard, r.block): r.n_tokens for r in pack_sequences(df, "shard", "key", "n", block_len, buckets=5).collect()}
    expect: dict = {}
    for shard in {s for s, _, _ in data}:
        total = sum(n for s, _, n in sorted(data, key=lambda x: x[1]) if s == shard)
        for pos in range(total):
            expect[(shard, pos // block_len)] = expect.get((shard, pos // block_len), 0) + 1
    assert got == expect


SEG_TEXT = st.text(alphabet=st.sampled_from(list("ab 世\n")), max_size=10)


@SETTINGS
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system"]), SEG_TEXT), max_size=5), min_size=1, max_size=15),
       st.integers(min_value=1, max_value=12))
def test_truncated_tail_equals_whole_text(spark, convs, max_length):
    from sftlake.operators.packing import segment_token_stats, truncated_tail

    rows = []
    for cid, msgs in enumerate(convs):
        for turn, (role, text) in enumerate(msgs):
            rows.append((cid, turn, role, f"<|im_start|>{role}\n{text}<|im_end|>\n"))
    if not rows:
        return
    seg = spark.createDataFrame(rows, "conv_id long, turn long, role string, seg string")
    tail = {r.conv_id: (r.n_kept, r.last_token) for r in truncated_tail(seg, max_length).collect()}
    stats = {r.conv_id: (r.n_tokens, r.n_assistant) for r in segment_token_stats(seg).collect()}
    for cid, msgs in enumerate(convs):
        if not msgs:
            continue
        whole = "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in msgs)
        toks = py_tokenize(whole)
        kept = toks[:max_length]
        assert tail[cid] == (len(kept), kept[-1] if kept else None)
        asst = sum(len(py_tokenize(f"<|im_start|>{r}\n{t}<|im_end|>\n")) for r, t in msgs if r == "assistant")
        assert stats[cid] == (len(toks), asst)
