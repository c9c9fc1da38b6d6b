import collections
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from sftlake.llm import queries, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, k=35):
    words = [WORD.findall(t or "") for _, t in rows]
    n = collections.Counter(tuple(w[i : i + k]) for w in words for i in range(len(w) - k + 1))
    out = []
    for (d, _), w in zip(rows, words, strict=True):
        gone = {j for i in range(len(w) - k + 1) if n[tuple(w[i : i + k])] > 1 for j in range(i, i + k)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((d, len(w), len(gone), kept))
    return sorted(out, key=str)


def test_odd_rows_against_brute_force(spark, monkeypatch):
    a = [f"w{k}" for k in range(200)]
    rows = [
        (1, " ".join(a)), (2, "x " + " ".join(a[50:85]) + " y"), (3, "x " + " ".join(a[50:84]) + " y"), (4, None), (5, ""),
        (6, "for " * 100), (7, "for for"), (None, "\t".join(a[:40]) + "\n"), (None, None), (8, "un deux " * 30), (9, "same row " + " ".join(map(str, range(60)))),
        (9, "same row " + " ".join(map(str, range(60)))), (10, " ".join(a[60:100] + a[10:46])), (11, "é" * 5000), (12, " ".join(f"u{k}" for k in range(34))), (13, " ".join(f"u{k}" for k in range(34))),
    ]
    docs = spark.createDataFrame([(*r, 7, "k") for r in rows], "doc_id long, text string, pos int, rk string")
    assert sorted(map(tuple, substring_dedup.remove_repeats(docs).collect()), key=str) == brute(rows)
    monkeypatch.setattr(substring_dedup, "BROADCAST_BYTES", 0)  # the sketch as a table, looked up by joins
    assert sorted(map(tuple, substring_dedup.remove_repeats(docs).collect()), key=str) == brute(rows)
    assert substring_dedup.remove_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("broadcast", [1 << 26, 0])
def test_query_against_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(substring_dedup, "BROADCAST_BYTES", broadcast)
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = sorted((d, n, r, hashlib.sha256(k.encode()).hexdigest()) for d, n, r, k in brute(rows))
    got = sorted(map(tuple, queries.op9_substring_dedup(spark, sf).collect()))
    assert got == want and sum(r for _, _, r, _ in want) > 0


def test_few_single_windows_pass_at_a_full_load(spark, monkeypatch):
    """Cells are dealt by the bytes of text: with as few as the rule allows, under 5 % of the
    windows met once pass, and both ways let the same windows through."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text is not null")
    texts = docs.select(F.xxhash64("doc_id").alias("rk"), "text")
    monkeypatch.setattr(substring_dedup, "LEAST_CELLS", substring_dedup.BLOCK)
    size = substring_dedup.cell_count(texts)
    n = texts.agg(F.sum(F.octet_length("text"))).first()[0]
    assert size >= n / (substring_dedup.PLACE_BYTES * substring_dedup.LOAD) > size / 2
    found = substring_dedup.candidates(texts).cache()
    total = sum(max(0, len(WORD.findall(r.text)) - 34) for r in texts.collect())
    once = found.groupBy("w").count().where("count = 1").count()
    assert 0 < once < 0.05 * total
    monkeypatch.setattr(substring_dedup, "BROADCAST_BYTES", 0)
    other = substring_dedup.candidates(texts)
    assert sorted(map(tuple, other.collect())) == sorted(map(tuple, found.collect()))
