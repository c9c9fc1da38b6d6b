import random
import re

import numpy as np
import pytest

from sftlake.llm import jaccard_join, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    s = [shingles(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for j in range(len(rows)):
        for i in range(j):
            both = len(s[i] & s[j])
            if both and 100 * both >= 75 * (len(s[i]) + len(s[j]) - both):
                top[find(j)] = find(i)
    least: dict = {}
    for k, (d, _) in enumerate(rows):
        if d is not None:
            least[find(k)] = min(d, least.get(find(k), d))
    return sorted(((d, len(s[k]), least.get(find(k))) for k, (d, _) in enumerate(rows)), key=str)


def test_trie_against_plain_sets():
    rng = np.random.default_rng(2)
    base = np.sort(rng.choice(10_000, 80, replace=False))
    found = [np.unique(np.concatenate([rng.choice(base, int(rng.integers(30, 80)), replace=False), rng.integers(0, 10_000, int(rng.integers(0, 9)))])) for _ in range(120)]
    found += [base, base[:60], base[:59], base[20:], found[0], np.array([3])]
    trie = jaccard_join.Trie(list(range(len(found))), found)
    for q in [*found[:40], base, np.array([3]), np.array([4])]:
        want = [k for k, s in enumerate(found) if 100 * (i := len(np.intersect1d(s, q))) >= 75 * (len(s) + len(q) - i)]
        assert sorted(trie.linked(q)) == want


def test_signatures_leave_no_linked_pair_out():
    rng = np.random.default_rng(3)
    pruned = 0
    for _ in range(600):
        base = rng.integers(0, 1 << 63, int(rng.integers(1, 700)), dtype=np.uint64)
        a = np.unique(np.concatenate([base, rng.integers(0, 1 << 63, int(rng.integers(0, 200)), dtype=np.uint64)]))
        b = np.unique(np.concatenate([base, rng.integers(0, 1 << 63, int(rng.integers(0, 200)), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        linked = 100 * both >= 75 * (len(a) + len(b) - both)
        may = jaccard_join.may_link(jaccard_join.signature(a), len(a), jaccard_join.signature(b), len(b))
        assert may or not linked
        pruned += not may
    assert pruned > 100


@pytest.mark.parametrize("leader_bytes", [8 << 20, 0])  # 0: leaders too many to broadcast
def test_odd_rows_and_a_large_group_against_brute_force(spark, monkeypatch, leader_bytes):
    monkeypatch.setattr(jaccard_join, "LEADER_BYTES", leader_bytes)
    rng = random.Random(4)
    words = [f"w{k}" for k in range(300)]
    base = [rng.choice(words) for _ in range(60)]
    rows = [(k, " ".join(rng.choice(words) if rng.random() < 0.03 else w for w in base)) for k in range(100, 190)]
    passage = " ".join(words[:30])
    rows += [(200 + k, passage + " " + " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for k in range(60)]
    rows += [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE\ttwo"), (6, "one two three four five"), (7, "One two three four five"), (None, "one two"), (None, None),
             (8, "É b c d e"), (9, "é b c d e"), (10, "x y " * 8000), (11, "X Y " * 9000), (4, "one two"), (4, "other words here")]
    docs = spark.createDataFrame([(*r, "c", 0) for r in rows], "doc_id long, text string, id string, n int")
    assert sorted(map(tuple, jaccard_join.join_classes(docs).collect()), key=str) == [(d, n, c if n else d) for d, n, c in brute(rows)]
    assert jaccard_join.join_classes(docs.limit(0)).count() == 0


def test_queries_against_their_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    for name, sql in queries.ORACLE.items():
        want = con.sql(sql)
        got = queries.QUERIES[name](spark, sf)
        assert sorted(got.columns) == sorted(want.columns)
        assert sorted(map(str, map(tuple, got.select(*want.columns).collect()))) == sorted(map(str, want.fetchall())), name


def test_shuffle_files_of_a_bitmap_go_when_it_is_built(spark):
    import os
    import time

    dirs = [str(d) for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f for d in dirs for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_") and f.endswith(".data")}
    before = files()
    ids = spark.range(1000).repartition(5, "id").selectExpr("id % 90 as id").groupBy("id").count().select("id")
    bits = jaccard_join._bitmap(ids)
    assert np.flatnonzero(np.unpackbits(bits, bitorder="little")).tolist() == list(range(90))
    for _ in range(50):
        if not (left := files() - before):
            break
        time.sleep(0.2)
    assert not left
