from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sftlake.operators import split as spl
from sftlake.operators.ranking import (
    hash_bucket,
    ordered_running_total,
    quantile_bucket,
    window_running_total,
)


def py_sizes(n, train, val):
    n_train, n_val = int(n * train), int(n * val)
    if n >= 3:
        n_train, n_val = max(n_train, 1), max(n_val, 1)
        if n_train + n_val >= n:
            n_val = max(1, n - n_train - 1)
    return n_train, n_val, n - n_train - n_val


@pytest.mark.parametrize("train,val", [(0.9, 0.05), (0.1, 0.85), (0.05, 0.9), (0.34, 0.65), (0.8, 0.1)])
def test_size_rule_matches_python_for_n_up_to_200(spark, train, val):
    counts = spark.createDataFrame([(f"k{n}", n) for n in range(0, 201)], "kind string, n long")
    got = {r.kind: (r.n_train, r.n_val, r.n_test) for r in spl.split_sizes(counts, train, val).collect()}
    for n in range(0, 201):
        assert got[f"k{n}"] == py_sizes(n, train, val), n


def test_documented_sizes(spark):
    expect = {1: (0, 0, 1), 2: (1, 0, 1), 3: (2, 1, 0), 4: (3, 1, 0), 9: (8, 1, 0), 10: (9, 1, 0),
              11: (9, 1, 1), 20: (18, 1, 1), 21: (18, 1, 2), 40: (36, 2, 2), 100: (90, 5, 5)}
    counts = spark.createDataFrame([(str(n), n) for n in expect], "kind string, n long")
    got = {int(r.kind): (r.n_train, r.n_val, r.n_test) for r in spl.split_sizes(counts, 0.9, 0.05).collect()}
    assert got == expect
    skew = spark.createDataFrame([("a", 3), ("b", 5)], "kind string, n long")
    got = {r.kind: (r.n_train, r.n_val, r.n_test) for r in spl.split_sizes(skew, 0.1, 0.85).collect()}
    assert got == {"a": (1, 1, 1), "b": (1, 3, 1)}


@pytest.mark.parametrize("train,val", [(0, 0.05), (1, 0.05), (0.9, 0), (0.9, 1), (0.5, 0.5), (0.95, 0.05)])
def test_bad_ratios_raise(spark, train, val):
    with pytest.raises(ValueError):
        spl.check_ratios(train, val)


def _records(spark, sizes: dict[str, int]):
    rows, rid = [], 0
    for k, n in sizes.items():
        for _ in range(n):
            rows.append((rid * 7 + 3, k))
            rid += 1
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "row_id long, kind string")


def _window_split(records, train, val, seed):
    """Reference form: one window per stratum."""
    from pyspark.sql import Window

    sizes = spl.split_sizes(records.groupBy("kind").agg(F.count(F.lit(1)).alias("n")), train, val)
    d = records.join(sizes, "kind").withColumn("h", spl.seeded_hash(seed, "row_id"))
    rn = F.row_number().over(Window.partitionBy("kind").orderBy("h", "row_id"))
    d = d.withColumn("rn", rn)
    s = F.when(F.col("rn") <= F.col("n_train"), "train").when(F.col("rn") <= F.col("n_train") + F.col("n_val"), "val")
    return d.select("row_id", "rn", s.otherwise("test").alias("split"))


@pytest.mark.parametrize("cell_digits", [1, 2, 4])
def test_two_level_rank_equals_window_rank(spark, cell_digits):
    records = _records(spark, {"hot": 600, "a": 37, "b": 3, "c": 1, "d": 10, "e": 21})
    got = spl.stratified_split(records, 0.9, 0.05, seed=42, cell_digits=cell_digits)
    ref = _window_split(records, 0.9, 0.05, 42)
    a = {r.row_id: (r.stratum_rank, r.split) for r in got.collect()}
    b = {r.row_id: (r.rn, r.split) for r in ref.collect()}
    assert a == b


def test_split_is_partition_and_sizes_follow_rule(spark):
    sizes = {"hot": 500, "x": 3, "y": 11, "z": 2}
    records = _records(spark, sizes)
    got = spl.stratified_split(records, 0.9, 0.05, cell_digits=1)
    rows = got.collect()
    assert len(rows) == sum(sizes.values()) and len({r.row_id for r in rows}) == len(rows)
    for k, n in sizes.items():
        c = [sum(1 for r in rows if r.kind == k and r.split == s) for s in spl.SPLITS]
        assert tuple(c) == py_sizes(n, 0.9, 0.05)


def test_split_independent_of_partitioning(spark):
    records = _records(spark, {"a": 120, "b": 40})
    base = {r.row_id: r.split for r in spl.stratified_split(records, cell_digits=1).collect()}
    for k in (1, 3, 17):
        again = {r.row_id: r.split for r in spl.stratified_split(records.repartition(k), cell_digits=1).collect()}
        assert again == base


def test_seed_changes_split(spark):
    records = _records(spark, {"a": 200})
    s1 = {r.row_id: r.split for r in spl.stratified_split(records, seed=1).collect()}
    s2 = {r.row_id: r.split for r in spl.stratified_split(records, seed=2).collect()}
    assert s1 != s2


def test_order_within_splits_is_a_permutation(spark):
    records = _records(spark, {"a": 300, "b": 30})
    plan = spl.plan_split(records, 0.9, 0.05)
    split = spl.assign_splits(records, plan)
    o = spl.order_within_splits(split, cell_digits=2).collect()
    for s in spl.SPLITS:
        pos = sorted(r.order_pos for r in o if r.split == s)
        assert pos == list(range(1, len(pos) + 1))
        by_hash = [r.row_id for r in sorted((r for r in o if r.split == s), key=lambda r: (r.order_hash, r.row_id))]
        by_pos = [r.row_id for r in sorted((r for r in o if r.split == s), key=lambda r: r.order_pos)]
        assert by_hash == by_pos


def test_running_sum_two_level_equals_window(spark):
    rng = random.Random(5)
    rows = [(("hot" if rng.random() < 0.6 else f"g{rng.randrange(5)}"), i, rng.randrange(0, 50)) for i in range(800)]
    df = spark.createDataFrame(rows, "g string, k long, v long")
    b = quantile_bucket(df, "k", "b", 13)
    got = {r.k: r.s for r in ordered_running_total(b, ["g"], "b", ["k"], "s", value="v").collect()}
    ref = {r.k: r.s for r in window_running_total(df, ["g"], ["k"], "s", value="v").collect()}
    assert got == ref
    got_n = {r.k: r.n for r in ordered_running_total(b, [], "b", ["k"], "n").collect()}
    assert got_n == {k: k + 1 for k in range(800)}


def test_hash_bucket_monotone(spark):
    df = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("h"))
    rows = df.select("h", hash_bucket("h", 9).alias("b")).collect()
    rows.sort(key=lambda r: r.h)
    bs = [r.b for r in rows]
    assert bs == sorted(bs) and min(bs) >= 0 and max(bs) <= 8


def test_split_metadata_counts(spark):
    from sftlake.operators.records import normalized

    raw = spark.createDataFrame(
        [(i, "k" if i % 2 else "j", None if i % 5 == 0 else "p", "t") for i in range(40)],
        "row_id long, kind string, input string, target string",
    )
    plan = spl.plan_split(normalized(raw), 0.9, 0.05, kept="kept")
    m = spl.split_metadata(plan).first()
    assert plan.totals()["raw"] == 40 and plan.totals()["kept"] == 32
    assert (m.total_raw, m.total_kept, m.total_skipped) == (40, 32, 8)
    assert m.train_size + m.val_size + m.test_size == 32


def test_head_rows_small(spark):
    df = spark.range(100).select((F.col("id") * 13 % 100).alias("row_id"))
    assert sorted(r.row_id for r in spl.head_rows(df, 5, ["row_id"]).collect()) == [0, 1, 2, 3, 4]
    assert spl.head_rows(df, 0, ["row_id"]).count() == 100
    assert spl.head_rows(df, None, ["row_id"]).count() == 100
    assert spl.head_rows(df, 1000, ["row_id"]).count() == 100


@pytest.mark.parametrize("n", [1, 9_999, 10_001, 23_456, 29_999])
def test_head_rows_of_any_size_and_key_type(spark, n):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("k"), (F.col("id") % 11).cast("string"))).alias("kind"),
        ((F.col("id") * 7919) % 30_000).alias("row_id"),
        F.lit("text").alias("text"),
    )
    out = spl.head_rows(df, n, ["kind", "row_id"])
    rows = df.select("kind", "row_id").collect()
    want = sorted(((r.kind or "", r.row_id) for r in rows))[:n]
    assert sorted(((r.kind or "", r.row_id) for r in out.collect())) == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "TakeOrdered" not in plan  # a filter: no task gathers the head
    assert {r.row_id for r in spl.head_rows(df, n, ["row_id"]).collect()} == set(range(n))


def test_head_rows_needs_a_total_order(spark):
    df = spark.range(20_000).select(F.lit(1).alias("same"))
    with pytest.raises(ValueError):
        spl.head_rows(df, 10, ["same"])


def test_hot_stratum_is_spread_over_cells(spark):
    """A stratum with a third of all rows is ranked in many (kind, cell) windows, never in one
    task, and labels need no exchange of the records at all."""
    records = _records(spark, {"hot": 1600, **{f"k{i}": 100 for i in range(32)}})
    plan = spl.plan_split(records, 0.9, 0.05, cell_digits=1)
    assert plan.offsets.where("kind = 'hot'").count() == 16
    got = spl.rank_splits(records, plan)
    plan_text = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__at" in plan_text and "SinglePartition" not in plan_text
    ref = {r.row_id: (r.rn, r.split) for r in _window_split(records, 0.9, 0.05, 42).collect()}
    assert {r.row_id: (r.stratum_rank, r.split) for r in got.collect()} == ref
    labels = spl.assign_splits(records, plan)
    text = labels._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text
    assert {r.row_id: r.split for r in labels.collect()} == {k: s for k, (_, s) in ref.items()}


@pytest.mark.parametrize("cell_digits", [1, 3, 4])
def test_labels_equal_ranks(spark, cell_digits):
    records = _records(spark, {"hot": 700, "a": 37, "b": 3, "c": 1, "d": 10, "e": 2})
    plan = spl.plan_split(records, 0.9, 0.05, seed=42, cell_digits=cell_digits)
    ref = {r.row_id: r.split for r in _window_split(records, 0.9, 0.05, 42).collect()}
    assert {r.row_id: r.split for r in spl.assign_splits(records, plan).collect()} == ref
    assert {r.row_id: r.split for r in spl.rank_splits(records, plan).collect()} == ref


def test_null_strata_are_kept_and_null_keys_raise(spark):
    records = _records(spark, {"a": 30}).unionByName(spark.range(1000, 1010).select(F.col("id").alias("row_id"), F.lit(None).cast("string").alias("kind")))
    out = spl.stratified_split(records).collect()
    assert len(out) == 40 and sorted(r.split for r in out if r.kind is None) == ["train"] * 9 + ["val"]
    labels = spl.assign_splits(records, spl.plan_split(records)).collect()
    assert {(r.row_id, r.split) for r in labels} == {(r.row_id, r.split) for r in out}
    with pytest.raises(ValueError):
        spl.stratified_split(records.withColumn("row_id", F.when(F.col("row_id") > 5, F.col("row_id"))))


def test_running_totals_keep_null_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "g string, k long")
    b = df.withColumn("b", F.lit(0).cast("long"))
    assert sorted((str(r.g), r.k, r.n) for r in ordered_running_total(b, ["g"], "b", ["k"], "n").collect()) == [("None", 1, 1), ("None", 2, 2), ("a", 1, 1)]
    with pytest.raises(ValueError):
        quantile_bucket(df, "g", "b")


def test_test_slice_is_the_head_of_the_seeded_order(spark):
    from sftlake.plans.evaluate import test_slice as slice_of_test

    df = spark.range(5000).select(F.col("id").alias("row_id"))
    got = sorted(r.row_id for r in slice_of_test(df, 300).collect())
    order = df.withColumn("h", spl.seeded_hash(42, "row_id", salt="order")).orderBy("h", "row_id").limit(300)
    assert got == sorted(r.row_id for r in order.collect())


def test_near_overlap_names_every_copy(spark):
    from pyspark.sql import functions as F

    from sftlake.operators.overlap import near_overlap, overlap_members

    words = [f"w{k}" for k in range(40)]
    same, near, other = " ".join(words), " ".join([*words[:-1], "x"]), " ".join(f"o{k}" for k in range(20))
    rows = [(1, "test", same), (2, "test", same), (3, "test", same.upper()), (4, "train", near), (5, "train", near), (6, "test", other), (7, "val", same), (8, "train", "")]
    df = spark.createDataFrame(rows, "row_id long, split string, t string")
    pairs = near_overlap(df, F.col("t"))
    got = {tuple(r) for r in overlap_members(df, F.col("t"), pairs).collect()}
    assert got == {("test", 1, 1), ("test", 2, 1), ("test", 3, 1), ("train", 4, 4), ("train", 5, 4)}


def test_near_overlap_links_of_every_row(spark):
    from pyspark.sql import functions as F

    from sftlake.operators.overlap import near_overlap, overlap_links

    def words(t):
        w = t.lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())

    base = [f"w{k}" for k in range(60)]
    texts = [" ".join([*base[:k], f"x{k % 7}", *base[k + 1 :]]) for k in range(60)]  # near copies of one text
    texts += [" ".join(base), "", "a b", "A  b", " ".join(f"o{k}" for k in range(20)), " ".join(base[:30])]
    rows = [(k, "test" if k % 3 == 0 else "train", t) for k, t in enumerate(texts + texts[::4])]
    df = spark.createDataFrame(rows, "row_id long, split string, t string")
    got = {tuple(r) for r in overlap_links(df, F.col("t"), near_overlap(df, F.col("t"))).collect()}
    sets = [(k, s, words(t)) for k, s, t in rows]
    want = set()
    for k, s, a in sets:
        links = sum(1 for _, o, b in sets if o != s and a and b and 100 * len(a & b) >= 75 * len(a | b))
        want.add((s, k, min([j for j, o, b in sets if o == s and b == a and a] or [k]), links))
    assert got == want and sum(n > 0 for *_, n in want) > 40


def test_near_overlap_moves_shared_shingles_only(spark, monkeypatch):
    """Train texts that share too little with the test split are gone before shingles are ranked,
    and each text is hashed once for the pairs and the links."""
    from pyspark.sql import functions as F

    from sftlake.operators import overlap

    base = [f"w{k}" for k in range(40)]
    far = [" ".join([*base[:20], *(f"t{i}w{k}" for k in range(30))]) for i in range(30)]  # share 16 of 46 shingles
    texts = [("test", " ".join(base)), ("train", " ".join([*base[:-1], "x"])), ("train", None), *(("train", t) for t in far)]
    df = spark.createDataFrame([(None if k % 5 == 4 else k, s, t) for k, (s, t) in enumerate(texts)], "row_id long, split string, t string")
    made, write = [], overlap.checkpointed
    monkeypatch.setattr(overlap, "checkpointed", lambda d: made.append(write(d)) or made[-1])
    rows = overlap.shingle_rows(df, F.col("t"))
    pairs = overlap.near_overlap(df, F.col("t"), rows=rows)
    ranked = [d.count() for d in made if "g" in d.columns]
    assert [tuple(r) for r in pairs.collect()] == [(0, 1, 35 / 37)] and ranked == [515, 35, 35, 35]
    got = overlap.overlap_links(df, F.col("t"), pairs, rows=rows).collect()
    assert len(got) == len(texts) and sum(r.links for r in got) == 2
    assert sum("s" in d.columns for d in made) == 2  # the rows, the classes


def test_shingle_sets_against_plain_words():
    import pyarrow as pa

    from sftlake.functions.shingles import shingle_sets

    texts = ["", None, "a", " a  b ", "a b c d e f a b c d e", "é 中文  x y z\x0b1\r2 3", "a b c d e", "e d c b a " * 3, "ab c d e f", "a bc d e f"]
    names = {}
    for s, t in zip(shingle_sets(pa.array(texts + texts, pa.string()).slice(3, 12), 5), (texts + texts)[3:15], strict=True):
        w = (t or "").encode().split()
        want = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
        assert len(want) == len(s) == len(set(s.tolist()))
        names.setdefault(frozenset(want), set()).add(tuple(s.tolist()))
    assert all(len(v) == 1 for v in names.values()) and len(set(map(tuple, names.values()))) == len(names)
