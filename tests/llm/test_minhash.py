import random

import numpy as np
import pytest
from test_jaccard_join import shingles

from sftlake.llm import minhash


def brute(rows, percent=85):
    s = [shingles(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for j in range(len(rows)):
        for i in range(j):
            both = len(s[i] & s[j])
            if both and 100 * both >= percent * (len(s[i]) + len(s[j]) - both):
                top[find(j)] = find(i)
    least: dict = {}
    for k, (d, _) in enumerate(rows):
        if d is not None:
            least[find(k)] = min(d, least.get(find(k), d))
    out = []
    for k, (d, _) in enumerate(rows):
        c = least.get(find(k)) if s[k] else d
        out.append((d, len(s[k]), c, d == c))
    return sorted(out, key=str)


def pair(rng, n, similarity):
    """Two sets of n elements or so with the similarity given, rounded up."""
    own = int(n * (1 - similarity) / (1 + similarity))
    base = rng.integers(0, 1 << 63, n + own, dtype=np.uint64)
    return base[:n], base[own:]


@pytest.mark.parametrize("n", [7, 40, 200, 5000])
def test_bins_agree_as_often_as_sets_do(n):
    rng = np.random.default_rng(n)
    shares = []
    for _ in range(150):
        a, b = pair(rng, n, 0.85)
        want = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        shares.append((minhash.sketch(a) == minhash.sketch(b)).mean() - want)
    assert abs(np.mean(shares)) < 0.03


@pytest.mark.parametrize("n", [8, 14, 30, 100, 400, 3000])
def test_linked_sets_share_a_band(n):
    rng = np.random.default_rng(n)
    for _ in range(400):
        a, b = pair(rng, n, 0.85)
        both = len(np.intersect1d(a, b))
        assert 100 * both >= 85 * (len(a) + len(b) - both)
        assert (minhash.band_keys(a) == minhash.band_keys(b)).any()


def test_unlike_sets_seldom_share_a_band():
    rng = np.random.default_rng(5)
    met = [(minhash.band_keys(a) == minhash.band_keys(b)).any() for a, b in (pair(rng, 300, 0.3) for _ in range(1000))]
    assert sum(met) < 60


@pytest.mark.parametrize("n", [1, 20, 300, 4000])
def test_parities_never_exceed_the_difference(n):
    rng = np.random.default_rng(n)
    for similarity in (0.2, 0.6, 0.9):
        a, b = pair(rng, n, similarity)
        differ = int(np.bitwise_count((minhash.parities(a) ^ minhash.parities(b)).view(np.uint64)).sum())
        assert differ <= len(np.setxor1d(a, b))


def test_sketch_of_one_element_and_of_any_order():
    one = np.array([12345], np.uint64)
    assert len(set(minhash.sketch(one))) == 1
    s = np.random.default_rng(1).integers(0, 1 << 63, 50, dtype=np.uint64)
    assert (minhash.sketch(s) == minhash.sketch(s[::-1])).all() and minhash.class_of(s) == minhash.class_of(s[::-1])


ODD = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE\ttwo"), (6, "one two three four five"), (7, "One two three four five"), (None, "one two"), (None, None),
       (8, "É b c d e"), (9, "é b c d e"), (10, "x y " * 8000), (11, "X Y " * 9000), (4, "one two"), (4, "other words here"), (None, "null alone here"), (None, "null alone here")]


@pytest.mark.parametrize("few", [minhash.BROADCAST_TEXTS, 0])  # 0: the texts' hashes are joined
def test_odd_rows_and_groups_against_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(minhash, "BROADCAST_TEXTS", few)
    rng = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    rows = list(ODD)
    for g in range(6):  # groups whose members are linked, in chains, or not
        base = [rng.choice(words) for _ in range(90)]
        rate = (0.004, 0.008, 0.012, 0.016, 0.02, 0.03)[g]
        rows += [(1000 * (g + 1) + k, " ".join(rng.choice(words) if rng.random() < rate else w for w in base)) for k in range(40)]
    passage = " ".join(words[:60])
    rows += [(8000 + k, passage + " " + " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for k in range(60)]
    rows += [(9000 + k, "the very same text of ten words and no more") for k in range(300)]
    docs = spark.createDataFrame([(*r, "c", 0) for r in rows], "doc_id long, text string, id string, th int")
    got = minhash.near_duplicates(docs)
    want = brute(rows)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, bool(r.kept)) for r in got.collect()), key=str) == sorted(((d, n, c, d == c) for d, n, c, _ in want), key=str)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_a_threshold_the_bands_are_not_laid_out_for(spark):
    with pytest.raises(ValueError):
        minhash.near_duplicates(spark.createDataFrame([(1, "a")], "doc_id long, text string"), 70)
