import hashlib
import random

import pytest
from pyspark.sql import functions as F

from sftlake.llm import merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, root int, g int, proof string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, n_chars=None):
    d, text, lang, source, n = row
    values = (d, source, lang, n if n_chars is None else n_chars, text)
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][k : k + 2]) for k in range(0, len(out[-1]), 2)])
    return out


def path(tree, pos):
    out = []
    for level in tree[:-1]:
        s = pos ^ 1
        out.append((0, None) if s >= len(level) else (-1 if pos & 1 else 1, level[s]))
        pos >>= 1
    return out


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    group = {x: sorted(((r[0], leaf(r)) for r in rows if r[2] == x), key=lambda p: (p[0] is not None, p[0] or 0, p[1])) for x in langs}
    trees = {x: levels([d for _, d in group[x]]) for x in langs}
    top = levels([trees[x][-1][0] for x in langs])
    return sorted(
        ((d, x, dig, trees[x][-1][0], top[-1][0], path(trees[x], k) + path(top, i)) for i, x in enumerate(langs) for k, (d, dig) in enumerate(group[x])), key=str
    )


def rows_of(n, rng):
    return [(k, rng.choice(["", "é text", f"line {k}\nline", None, "x" * 50_000]) if k % 9 == 0 else f"t{k}", rng.choice(["en", "en", "en", "é", "de", None]), rng.choice(["a", None]), k) for k in range(n)]


@pytest.mark.parametrize("bits", [1, 3, 14])
@pytest.mark.parametrize("rounds", [2, 12])
def test_manifest_against_plain_trees(spark, monkeypatch, bits, rounds):
    monkeypatch.setattr(merkle, "PART_BITS", bits)
    monkeypatch.setattr(merkle, "ROUND_LEVELS", rounds)
    rng = random.Random(bits)
    rows = rows_of(150, rng) + [(7, "twice", "en", "s", 3)] * 2 + [(7, "other", "en", "s", None), (None, None, None, None, None), (None, "x", "en", "s", 1), (1, "alone", "zz", "s", 1)]
    docs = spark.createDataFrame([(*r, "c", 1, 2, "p") for r in rows], SCHEMA).repartition(5)
    got = merkle.manifest(docs).collect()
    assert sorted(((r.doc_id, r.lang, r.leaf, r.subroot, r.root, [tuple(x) for x in r.proof]) for r in got), key=str) == brute(rows)


def test_one_row_one_group_and_no_rows(spark):
    for rows in ([(3, "only", "en", None, 4)], [(k, f"t{k}", None, "s", k) for k in range(9)]):
        docs = spark.createDataFrame([(*r, "c", 1, 2, "p") for r in rows], SCHEMA)
        got = merkle.manifest(docs).collect()
        assert sorted(((r.doc_id, r.lang, r.leaf, r.subroot, r.root, [tuple(x) for x in r.proof]) for r in got), key=str) == brute(rows)
    assert merkle.manifest(docs.limit(0)).count() == 0


def test_folding_finds_what_was_changed(spark):
    docs = spark.createDataFrame([(k, f"t{k}", "en" if k % 3 else "de", "s", k if k % 5 else None) for k in range(60)], "doc_id long, text string, lang string, source string, n_chars long")
    claim = merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.when(F.col("doc_id") % 4 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars")), F.col("text"))
    out = merkle.manifest(docs, claim=claim)
    ok = out.select("doc_id", merkle.fold(F.col("claim"), F.col("proof")).alias("folded"), "root", merkle.proof_digest(F.col("proof")).alias("p"), "proof").collect()
    for r in ok:
        assert (r.folded == r.root) == (r.doc_id % 4 != 0 or r.doc_id % 5 == 0)
        assert r.p == h(*(x.digest for x in r.proof if x.digest))


def test_partitions_ask_for_the_ends_alone(spark, monkeypatch):
    """The stored nodes and the coordinates that are asked for follow the number of partitions,
    not that of leaves; and every one asked for is stored."""
    monkeypatch.setattr(merkle, "PART_BITS", 6)
    leaves = spark.range(3000).select(F.lit("x").alias("g"), F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    tree = merkle.build_tree(leaves)
    parts, depth = tree.ranges.count(), 12
    asked = merkle.missing(tree.ranges)
    assert asked.count() <= 2 * depth * parts and tree.nodes.count() <= 3 * depth * parts < 3000 * 2
    assert asked.join(tree.nodes, ["g", "level", "idx"]).count() == asked.count()
    assert tree.nodes.groupBy("g", "level", "idx").count().where("count > 1").isEmpty()


def test_leaves_are_shuffled_by_digest_and_not_by_text(spark):
    plan = queries.QUERIES["op11_merkle_manifest"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan
