"""Every stage of the pipeline against plain Python on its own input, and the whole run."""

import collections

import pytest
from test_decontaminate import best_stretch, plain
from test_first_ops import check_pieces
from test_jaccard_join import brute as jaccard_classes
from test_line_dedup import removed

import corpus_pipeline
from sftlake.llm.decontaminate import allowed

SF = "/root/testdata/sf0.001"


def cut_lines(rows):
    gone, lines = removed(rows)
    left = collections.Counter(d for d, no, _ in lines if (d, no) not in gone)
    total = collections.Counter(d for d, *_ in lines)
    return {(d, "\n".join(x for no, x in enumerate(t.split("\n")) if (d, no) not in gone)) for d, t in rows if left[d] or not total[d]}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = corpus_pipeline.quality_classifier(spark, docs, SF)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    right = [(d in ids) == (q == 1) for d, q in labels.items()]
    assert sum(right) / len(right) > 0.9

    cut = corpus_pipeline.line_deduplication(spark, docs, SF)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = cut.collect()
    assert cut.columns == docs.columns and {(r.doc_id, r.text) for r in got} == cut_lines(rows) and all(r.n_chars == len(r.text) for r in got)

    one = corpus_pipeline.ngram_jaccard(spark, docs, SF)
    assert one.columns == docs.columns and sorted(r.doc_id for r in one.collect()) == sorted(d for d, _, c in jaccard_classes(rows) if c == d)

    clean = corpus_pipeline.decontamination(spark, docs, SF)
    items = [plain(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaky = {d for d, t in rows if any(best_stretch(w, plain(t)) <= allowed(len(w)) for w in items)}
    assert clean.columns == docs.columns and {d for d, _ in rows} - {r.doc_id for r in clean.collect()} == leaky


def test_run_and_odd_rows(spark, tmp_path):
    out = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert 0 < len({r.doc_id for r in out}) < docs.count()
    odd = spark.createDataFrame(
        [(1, None, "en", None, 0), (2, "", None, "s", 0), (None, "null id here", "en", "s", 12), (3, "a b c " * 50, "en", "s", 5), (3, "a b c " * 50, "en", "s", 5), (4, "line one\nline one", "xx", "s", 17)],
        docs.schema,
    )
    for df in (odd, odd.limit(0)):
        df.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        for t in ("labels", "benchmark"):
            spark.read.parquet(f"{SF}/{t}.parquet").write.mode("overwrite").parquet(str(tmp_path / f"{t}.parquet"))
        pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
        check_pieces(pieces, [])
    kept = corpus_pipeline.ngram_jaccard(spark, odd, SF).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "2", "3", "4", "None"]


@pytest.mark.parametrize("k", range(5))
def test_stage_names(k):
    assert [n for n, _ in corpus_pipeline.STAGES][k] == ["quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "packing"][k]
