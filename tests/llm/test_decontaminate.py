import random
import re

import numpy as np
import pyarrow as pa
import pytest

from sftlake.llm import decontaminate, queries
from sftlake.llm.decontaminate import allowed, distances

SF = "/root/testdata/sf0.01"


def plain(text):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())


def best_stretch(item, text):
    """Least edits between the item and any stretch of the text."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for w in text:
        new = [0]
        for i, x in enumerate(item, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (x != w)))
        row = new
        best = min(best, row[-1])
    return best


def test_bit_parallel_distance():
    rng = random.Random(0)
    for _ in range(400):
        item = [rng.randrange(4) for _ in range(rng.randint(1, 70))]
        text = [rng.randrange(4) for _ in range(rng.randint(1, 60))]
        assert min([len(item), *distances(item, text)]) == best_stretch(item, text)
        row = list(range(len(item) + 1))
        for k, w in enumerate(text, 1):
            new = [k]
            for i, x in enumerate(item, 1):
                new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (x != w)))
            row = new
        assert distances(item, text, anchored=True)[-1] == row[-1]


def test_tables_reach_their_recall_on_edited_items():
    rng = np.random.default_rng(5)
    items = [rng.integers(1, 1 << 62, int(rng.integers(15, 60)), dtype=np.uint64) for _ in range(150)]
    index = decontaminate.Index(items)
    assert all(g.recall >= decontaminate.RECALL for g in index.groups)
    noise = rng.integers(1, 1 << 62, 30, dtype=np.uint64)
    found = 0
    for k, item in enumerate(items):
        text = np.concatenate([noise, decontaminate._edited(item, allowed(len(item)), rng), noise])
        words = decontaminate.words_of(pa.array([""]))
        words.hash, words.off = text, np.array([0, len(text)])
        hit = index.leaks(words).get(0, {})
        assert set(hit) <= {k}
        found += k in hit
    assert found / len(items) >= 0.93


def test_query_finds_what_brute_force_finds(spark):
    got = {(r.doc_id, r.item_id): r for r in queries.op5_decontamination(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = [(r.item_id, plain(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    exact = {(d.doc_id, i) for d in docs for i, w in items if f" {' '.join(w)} " in f" {' '.join(plain(d.text))} "}
    assert exact and {k for k, r in got.items() if r.distance == 0} == exact
    text = {d.doc_id: plain(d.text) for d in docs}
    of = dict(items)
    for (d, i), r in got.items():
        assert r.item_words == len(of[i]) and r.distance <= allowed(r.item_words)
        assert r.distance == best_stretch(of[i], text[d])
        assert best_stretch(of[i], text[d][r.first_word : r.last_word + 1]) == r.distance


def test_odd_rows(spark):
    item = "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda mu"
    rows = [
        (1, item.upper() + "!!"), (2, "x y " + item.replace("gamma ", "") + " z"), (3, item.replace("beta", "b").replace("eta", "e").replace("iota", "i")),
        (4, None), (5, ""), (None, "pre " + item), (1, item.upper() + "!!"), (6, "word " * 30_000 + item + " word" * 30_000), (7, "alpha beta gamma"), (8, "a b"),
    ]
    docs = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id long, text string, leaks string, item_id int")
    items = spark.createDataFrame([(10, item), (11, item), (12, None), (13, ""), (14, "a b"), (None, "one two three four five six")], "item_id long, text string")
    got = decontaminate.find_leaks(docs, items).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, len(r.text or "")): [(x.item_id, x.distance) for x in r.leaks] for r in got}
    by = {k[0]: v for k, v in by.items()}
    assert by[1] == by[None] == by[6] == [(10, 0), (11, 0)] and by[2] == [(10, 1), (11, 1)]
    assert by[3] == by[4] == by[5] == by[7] == [] and by[8] == [(14, 0)]  # short items: no edit
    assert [r.first_word for r in got if r.doc_id == 6 for r in r.leaks] == [30_000, 30_000]
    assert all(r.leaks == [] for r in decontaminate.find_leaks(docs, items.limit(0)).collect())
    assert decontaminate.find_leaks(docs.limit(0), items).count() == 0


def test_long_items_are_found_at_the_recall():
    rng = np.random.default_rng(11)
    sizes = [100, 150, 250, 400] * 25
    items = [rng.integers(1, 1 << 62, n, dtype=np.uint64) for n in sizes]
    index = decontaminate.Index(items)
    assert all(g.recall >= decontaminate.RECALL for g in index.groups)
    noise = rng.integers(1, 1 << 62, 30, dtype=np.uint64)
    found = {n: 0 for n in sizes}
    for k, item in enumerate(items):
        edited = decontaminate._edited(item, allowed(len(item)), rng)
        text = np.concatenate([noise, edited, noise])
        words = decontaminate.words_of(pa.array([""]))
        words.hash, words.off = text, np.array([0, len(text)])
        hit = index.leaks(words).get(0, {})
        assert set(hit) <= {k}
        if hit:
            cost, first, last = hit[k]
            assert cost == best_stretch(item.tolist(), text.tolist()) and best_stretch(item.tolist(), text[first : last + 1].tolist()) == cost
        found[len(item)] += k in hit
    assert all(n >= 0.93 * 25 for n in found.values()), found


def test_pieces_cover_an_item_and_keep_the_bound():
    for n in range(5, 1500):
        cut = decontaminate.pieces(n)
        assert cut[0][0] == 0 and cut[-1][1] == n and all(a[1] == b[0] for a, b in zip(cut, cut[1:]))
        assert max(b - a for a, b in cut) <= decontaminate.PIECE_WORDS
        # If every piece held one edit more than its share, the item would hold more than are allowed.
        assert sum(allowed(b - a) + 1 for a, b in cut) > allowed(n)


def test_tables_below_the_recall_are_an_error(monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_TABLES", 1)
    rng = np.random.default_rng(2)
    with pytest.raises(RuntimeError, match="tables meet only"):
        decontaminate.Index([rng.integers(1, 1 << 62, 60, dtype=np.uint64) for _ in range(20)])


def test_short_items_are_found_exactly(spark):
    rng = np.random.default_rng(5)
    rows = [(d, " ".join(f"w{k}" for k in rng.integers(0, 12, rng.integers(0, 40)))) for d in range(60)]
    short = [(i, " ".join(f"w{k}" for k in rng.integers(0, 12, 1 + i % 4))) for i in range(24)]
    got = decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(short, "item_id long, text string"))
    found = {(r.doc_id, x.item_id): (x.first_word, x.last_word, x.distance) for r in got.collect() for x in r.leaks}
    want = {}
    for d, t in rows:
        w = t.split()
        for i, s in short:
            q = s.split()
            at = [k for k in range(len(w) - len(q) + 1) if w[k : k + len(q)] == q]
            if at:
                want[d, i] = (at[0], at[0] + len(q) - 1, 0)
    assert found == want and len(want) > 100


def test_recall_is_measured_on_pieces_drawn_at_random():
    rng = np.random.default_rng(3)
    items = [rng.integers(1, 1 << 62, 12, dtype=np.uint64) for _ in range(900)]
    seen = []
    whole = decontaminate._edited
    try:
        decontaminate._edited = lambda w, k, r: seen.append(int(w[0])) or whole(w, k, r)
        group = decontaminate.Group(items, list(range(900)), 12, 12)
    finally:
        decontaminate._edited = whole
    place = {int(w[0]): k for k, w in enumerate(items)}
    at = sorted(place[s] for s in seen)
    assert group.recall >= decontaminate.RECALL and len(set(at)) == decontaminate.MEASURED and at[-1] > 800
