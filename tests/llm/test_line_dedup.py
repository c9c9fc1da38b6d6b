import collections
import hashlib
import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from sftlake.llm import grouping, jaccard_join, line_dedup, queries
from sftlake.sources import scratch


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def noisy_pairs(n, seed=3):
    rng = random.Random(seed)
    for _ in range(n):
        a = "".join(rng.choice("abcé") for _ in range(rng.randint(9, 30)))
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            k, kind = rng.randrange(len(b)), rng.randrange(3)
            if kind == 0:
                b.insert(k, rng.choice("abcé"))
            elif kind == 1:
                b[k] = rng.choice("abcé")
            elif len(b) > 8:
                del b[k]
        yield a, "".join(b)


@pytest.mark.parametrize("t", [1, 2, 3, 5])
def test_banded_distance_and_shared_segments(spark, t):
    """The distance, with and without common ends, and the keys of lines within the threshold:
    the shorter holds one that the longer has, and of a finer deal all but t."""
    pairs = [(k, a, b) for k, (a, b) in enumerate(noisy_pairs(500))]
    df = spark.createDataFrame(pairs, "id long, a string, b string")
    cut = line_dedup.trimmed_pair(F.col("a"), F.col("b"), t + 1)
    out = df.select("id", line_dedup.within_edits(F.col("a"), F.col("b"), t).alias("w"), cut.alias("cut"))
    out = {r.id: r for r in out.withColumn("w2", line_dedup.within_edits(F.col("cut.a"), F.col("cut.b"), t)).collect()}

    def keys(column, fine):
        found = collections.defaultdict(lambda: (set(), set()))
        for r in line_dedup.segment_keys(df.select("id", F.col(column).alias("line")), t, None, fine).collect():
            found[r.id][0].add(r.k)
            if r.held:
                found[r.id][1].add(r.k)
        return found

    coarse, fine = (keys("a", 0), keys("b", 0)), (keys("a", line_dedup.FINE), keys("b", line_dedup.FINE))
    for k, a, b in pairs:
        if min(len(a), len(b)) <= t:
            continue
        d = edits(a, b)
        assert out[k].w == out[k].w2 == (d <= t) and edits(out[k].cut.a, out[k].cut.b) == d
        if d <= t:
            short, long = (0, 1) if len(a) <= len(b) else (1, 0)
            assert coarse[short][k][1] & coarse[long][k][0], (a, b)
            assert len(fine[short][k][1] - fine[long][k][0]) <= t, (a, b)


@pytest.mark.parametrize("t", [1, 3, 5])
def test_parities_leave_no_alike_pair_out(spark, t):
    rows = list(noisy_pairs(400, seed=t))
    texts = spark.createDataFrame([(2 * k + i, x[i]) for k, x in enumerate(rows) for i in (0, 1)], "id long, line string")
    x = line_dedup._pair_parities(texts)
    both = x.where("id % 2 = 0").select((F.col("id") / 2).cast("long").alias("k"), F.col("x").alias("a")).join(x.where("id % 2 = 1").select(F.floor(F.col("id") / 2).alias("k"), F.col("x").alias("b")), "k")
    may = {r.k: r.m for r in both.select("k", line_dedup._may_be_alike(F.col("a"), F.col("b"), t).alias("m")).collect()}
    assert len(may) == 400 and all(may[k] for k, (a, b) in enumerate(rows) if edits(a, b) <= t)
    assert sum(not v for v in may.values()) > 0 or t > 1


def test_number_of_keys():
    assert [len(line_dedup._slots(t)) for t in range(6)] == [1, 2, 5, 8, 13, 18]


def union(pairs, ids):
    top = {i: i for i in ids}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        top[b] = a
    return {i: find(i) for i in ids}


def test_components_and_leader_rounds(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, k) for k in range(8, 60)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)] + [(5, 5)]
    got = {r.id: r.comp for r in grouping.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    ids = {i for e in edges if e[0] != e[1] for i in e}
    assert got == union([e for e in edges if e[0] != e[1]], ids)
    assert grouping.components(spark.createDataFrame([], "a long, b long")).count() == 0
    # Numbers in buckets by tens, linked when they differ by one or by thirty: a group of all, and leaders that fail.
    members = spark.createDataFrame([(i // 10 % 3, i) for i in range(90)] + [(99, i) for i in range(300, 340)], "k long, id long").withColumn("x", F.col("id"))
    met = []

    def verify(pairs):
        met.extend((r.a, r.b) for r in pairs.collect())
        return pairs.where("b - a = 1 or b - a = 30")

    got = {r.id: r.comp for r in grouping.linked_classes(members, verify, lambda x, y: F.abs(x - y) < 60).collect()}
    same = collections.defaultdict(list)
    for i in range(90):
        same[i // 10 % 3].append(i)
    same[99] = list(range(300, 340))
    want = union([(a, b) for v in same.values() for a in v for b in v if b - a in (1, 30)], [i for v in same.values() for i in v])
    assert got == want and len(met) == len(set(met)) and all(a < b for a, b in met)
    assert grouping.linked_classes(members.limit(0), verify, lambda x, y: x == y).count() == 0


def test_who_has_led_leaves_its_buckets(spark, monkeypatch):
    """Of 70 members of a bucket, none linked, 4, 60 and 6 lead; each round reads those that are left."""
    rows = []

    def counted(df):
        out = real(df)
        rows.extend([out.count()] if {"ref", "open"} & set(out.columns) else [])
        return out

    real = grouping.checkpointed
    monkeypatch.setattr(grouping, "checkpointed", counted)
    members = spark.range(70).select(F.lit(1).cast("long").alias("k"), "id", F.col("id").alias("x"))
    met = []
    for flags in ([], [(F.col("id") < 40).alias("leads")]):
        rows.clear()
        met.clear()
        grouping.linked_classes(members.select("*", *flags), lambda p: met.extend((r.a, r.b) for r in p.collect()) or p.limit(0), lambda x, y: F.lit(True))
        assert sorted(met) == [(a, b) for a in range(70) for b in range(a + 1, 70) if not flags or a < 40]
        assert rows == ([66, 30] if flags else [66, 6, 0]), rows


def tables(spark):
    root = scratch.session_root(spark).removeprefix("file://")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_what_led_to_the_result_is_removed(spark):
    """Tables that the result doesn't read go before the texts move; the shuffle files behind a table
    go when it is written."""
    docs = spark.createDataFrame([(k, f"A line of some words that comes in every text.\nand one of number {k}" * 2) for k in range(30)], "doc_id long, text string")
    for work in (line_dedup.dedup_lines, jaccard_join.join_classes):
        before = tables(spark)
        out = work(docs)
        assert len(tables(spark) - before) <= 2 and out.count() == 30
    dirs = [str(d) for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f for d in dirs for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}
    before = files()
    out = scratch.checkpointed(docs.repartition(7, "text"))
    for _ in range(50):
        if not (left := {f for f in files() - before if f.endswith(".data")}):
            break
        time.sleep(0.2)
    assert not left and out.count() == 30
    assert spark.conf.get(scratch._CLEANUP, "false") == "false"


def within(a, b, t):
    """Plain edit distance in a band, against t."""
    if abs(len(a) - len(b)) > t:
        return False
    row = {j: j for j in range(min(t, len(b)) + 1)}
    for i, x in enumerate(a, 1):
        new = {}
        for j in range(max(0, i - t), min(len(b), i + t) + 1):
            best = row.get(j, t + 1) + 1
            if j:
                best = min(best, new.get(j - 1, t + 1) + 1, row.get(j - 1, t + 1) + (x != b[j - 1]))
            new[j] = best
        row = new
    return row.get(len(b), t + 1) <= t


def alike_pairs(kinds):
    """Every pair of lines within the rule of the module, by trying all whose characters' counts
    leave room for it."""
    least, per, top = line_dedup.MIN_CHARS, line_dedup.CHARS_AN_EDIT, line_dedup.MAX_EDITS
    kinds = [x for x in kinds if len(x) >= least]
    counts = np.zeros((len(kinds), 97), np.int64)
    for k, x in enumerate(kinds):
        np.add.at(counts[k], [ord(c) % 97 for c in x], 1)
    for k, b in enumerate(kinds):
        for i in np.flatnonzero(np.abs(counts[:k] - counts[k]).sum(axis=1) <= 2 * top):
            if within(kinds[i], b, min(top, min(len(kinds[i]), len(b)) // per)):
                yield kinds[i], b


def removed(rows):
    """(doc_id, line number) of the lines that go, and (doc_id, line number, line) of all."""
    lines = [(d, no, x.strip(" \t\x0b\x0c\r")) for d, text in rows if text is not None for no, x in enumerate(text.split("\n"))]
    lines = [x for x in lines if x[2]]
    kinds = sorted({x[2] for x in lines})
    at = union(alike_pairs(kinds), kinds)
    first: dict = {}
    for d, no, x in sorted(lines, key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        first.setdefault(at[x], (d, no))
    return {(d, no) for d, no, x in lines if first[at[x]] != (d, no)}, lines


def brute(rows):
    gone, lines = removed(rows)
    out = []
    for d, text in rows:
        n = sum(x[0] == d for x in lines)
        kept = None if text is None else "\n".join(x for no, x in enumerate(text.split("\n")) if (d, no) not in gone)
        out.append((d, n, sum(g[0] == d for g in gone), kept))
    return sorted(out, key=str)


def test_parities_of_pairs_are_for_lines_of_large_buckets(spark, monkeypatch):
    asked = []
    real = line_dedup._pair_parities
    monkeypatch.setattr(line_dedup, "_pair_parities", lambda texts: asked.append(texts.count()) or real(texts))
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(100)) for _ in range(20)]
    texts += [x + "z" for x in texts[:6]] + [texts[7][:50] + "".join(rng.choice("abcdefgh ") for _ in range(50)) for _ in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id for r in line_dedup.dedup_lines(docs).collect() if r.n_removed}
    assert got == set(range(20, 26)) and asked == [13]


@pytest.mark.parametrize("few,hot", [(line_dedup.BROADCAST_KEYS, line_dedup.HOT_BUCKET), (0, 3)])
def test_odd_rows_against_brute_force(spark, monkeypatch, few, hot):
    monkeypatch.setattr(line_dedup, "BROADCAST_KEYS", few)
    monkeypatch.setattr(line_dedup, "HOT_BUCKET", hot)
    base = "The quick brown fox jumps over the lazy dog, says line {} of the page, ünd mehr."
    rows = [
        (1, "a\n\nb\na\n" + base.format(1)), (2, base.format(2) + "\n  " + base.format(1) + "\t\n\n x"), (3, None), (4, ""), (5, "\n\n"),
        (6, base.format("x1") + "\n" + base.format("yy22")), (7, "\n".join(base.format(k) for k in range(30))), (None, "b\nnull id\n" + base.format(3)),
        (8, "short line 1\nshort line 2\nshort line 1"), (9, "é" * 3000), (10, "é" * 2999), (11, "é" * 2998 + "x"), (12, "a " * 2000),
        (13, "exactly twenty-four char\nexactly twenty-four chaR\nexactly twenty-four chXX"), (14, "Line of 24 letters or so\nline of 24 letters or so"),
    ]
    docs = spark.createDataFrame([(*r, 5, "h") for r in rows], "doc_id long, text string, n_lines int, h string")
    out = line_dedup.dedup_lines(docs)
    assert set(out.columns) == {"doc_id", "text", "n_lines", "n_removed", "h"}
    got = sorted(((r.doc_id, r.n_lines, r.n_removed, r.text) for r in out.collect()), key=str)
    assert got == brute(rows)
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0
    twice = line_dedup.dedup_lines(docs.where("doc_id = 1").unionByName(docs.where("doc_id = 1"))).collect()
    assert [r.n_removed for r in twice] == [1, 1]


def test_query_on_given_documents(spark, tmp_path):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()][:90]
    rows += [(1000 + d, t[:300].replace("e", "é", 1) + "\n" + t[300:]) for d, t in rows[:20]]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, queries.op10_line_dedup(spark, str(tmp_path)).collect()))
    assert got == sorted((d, n, r, hashlib.sha256(k.encode()).hexdigest()) for d, n, r, k in brute(rows))


def test_threshold_grows_with_the_length(spark):
    per, top = line_dedup.CHARS_AN_EDIT, line_dedup.MAX_EDITS
    rng = random.Random(8)
    texts, rows, near = [], [], 0
    for n in [*range(line_dedup.MIN_CHARS, 150), *range(150, 420, 7)]:
        a = [rng.choice("abcdefghij klmnop") for _ in range(n)]
        a[0] = a[-1] = "z"
        b = list(a)
        for _ in range(rng.randint(1, top + 1)):
            k, kind = rng.randrange(1, len(b) - 1), rng.randrange(3)
            if kind == 0:
                b.insert(k, rng.choice("qrs"))
            elif kind == 1:
                b[k] = rng.choice("qrs")
            else:
                del b[k]
        texts.append(("".join(a), "".join(b)))
    for k, (a, b) in enumerate(texts):
        rows += [(2 * k, a), (2 * k + 1, b)]
    got = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, (a, b) in enumerate(texts):
        short = min(len(a), len(b))
        alike = short >= line_dedup.MIN_CHARS and edits(a, b) <= min(top, short // per)
        near += alike and edits(a, b) > 1
        assert (got[2 * k], got[2 * k + 1]) == (0, int(alike)), (a, b)
    assert near > 50


def template(rng):
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    return f"Order {word(14)} was sent to customer {word(12)} in {word(9)} and paid with card {word(10)}."


@pytest.mark.parametrize("n", [500, 2000])
def test_pairs_of_a_template_follow_its_lines(spark, monkeypatch, n):
    """Lines of one template that are not alike: what is verified is in proportion to them."""
    rng = random.Random(n)
    lines = [template(rng) for _ in range(n)]
    lines += [x[:20] + "#" + x[21:] for x in lines[:25]]
    met = []

    def counted(members, verify, *rest):
        met.append(members.join(members.withColumnsRenamed({"id": "id2", "x": "x2", "leads": "leads2"}), "k").where("leads and id != id2").count())
        return grouping.linked_classes(members, verify, *rest)

    monkeypatch.setattr(line_dedup, "linked_classes", counted)
    docs = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(docs).collect()}
    assert sorted(k for k, x in got.items() if x) == list(range(n, n + 25))
    assert met[0] <= 60 * n, met
