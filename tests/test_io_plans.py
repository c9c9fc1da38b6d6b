from __future__ import annotations

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from sftlake.sources.jsonl import read_prompts, read_splits, write_jsonl

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_jsonl_skips_blank_lines_and_keeps_unicode(spark, tmp_out):
    p = os.path.join(tmp_out, "p.jsonl")
    with open(p, "w", encoding="utf-8") as f:
        f.write('{"id": "P1", "group": "g", "prompt": "请把 \\"引号\\"\\n换行"}\n\n   \n{"id": "P2", "prompt": "x"}\n')
    rows = read_prompts(spark, p).collect()
    assert [r.id for r in rows] == ["P1", "P2"]
    assert rows[0].prompt == '请把 "引号"\n换行' and rows[1].group == "unknown"
    out = os.path.join(tmp_out, "out")
    write_jsonl(read_prompts(spark, p), out)
    text = "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(f"{out}/part-*")))
    assert "请把" in text and '"group":"unknown"' in text


def test_jsonl_malformed_line_raises(spark, tmp_out):
    p = os.path.join(tmp_out, "bad.jsonl")
    with open(p, "w", encoding="utf-8") as f:
        f.write('{"id": "P1", "prompt": "ok"}\n{"id": oops}\n')
    with pytest.raises(Exception):
        read_prompts(spark, p).collect()


def test_prepare_job_end_to_end(spark, tmp_out):
    from sftlake.plans.prepare import prepare
    from sftlake.sources.adapters import documents_dirty

    raw = documents_dirty(spark, SF_SMALL)
    meta = prepare(raw, tmp_out, dataset_name="documents")
    assert meta["total_raw"] == 200
    assert meta["total_raw"] == meta["total_kept"] + meta["total_skipped"]
    assert meta["train_size"] + meta["val_size"] + meta["test_size"] == meta["total_kept"]
    splits = read_splits(spark, f"{tmp_out}/splits")
    counts = {r.split: r.n for r in splits.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {"train": meta["train_size"], "val": meta["val_size"], "test": meta["test_size"]}
    # only the test directory is read when test is asked for
    test_only = read_splits(spark, f"{tmp_out}/splits", ("test",))
    import re

    assert re.search(r"PartitionFilters: \[[^\]]*split[^\]]*test", _plan(test_only))
    assert test_only.count() == meta["test_size"]
    md = json.loads(open(glob.glob(f"{tmp_out}/metadata/part-*")[0], encoding="utf-8").read())
    assert md["total_kept"] == meta["total_kept"] and md["max_samples"] is None
    # files of a split follow the seeded order
    from sftlake.operators.split import seeded_hash

    rows = []
    for f in sorted(glob.glob(f"{tmp_out}/splits/split=train/part-*")):
        rows += [json.loads(line)["row_id"] for line in open(f, encoding="utf-8") if line.strip()]
    hashes = spark.createDataFrame([(r,) for r in rows], "row_id long").select(
        "row_id", seeded_hash(42, "row_id", "order").alias("h")
    ).collect()
    order = {r.row_id: r.h for r in hashes}
    assert [order[r] for r in rows] == sorted(order[r] for r in rows)


def test_prepare_max_samples(spark, tmp_out):
    from sftlake.plans.prepare import prepare
    from sftlake.sources.adapters import documents_raw

    meta = prepare(documents_raw(spark, SF_SMALL), tmp_out, max_samples=50)
    assert meta["total_raw"] == 50 and meta["max_samples"] == 50


def test_split_plan_has_one_big_exchange_and_broadcast_sizes(spark):
    from sftlake.plans.queries import QUERIES

    plan = _plan(QUERIES["stratified_split"](spark, SF_SMALL))
    assert "hashpartitioning(__at" in plan
    assert "SinglePartition" not in plan


def test_prepare_moves_the_texts_once(spark, tmp_out):
    """The plan of the write: one exchange carries prompt and response, the one by range."""
    import re

    from sftlake.operators import records as rec
    from sftlake.operators import split as spl
    from sftlake.sources.adapters import documents_raw

    kept = rec.convert_records(documents_raw(spark, SF_SMALL))
    split = spl.assign_splits(kept, spl.plan_split(kept)).withColumn("order_hash", spl.seeded_hash(42, "row_id", "order"))
    ordered = split.repartitionByRange("split", "order_hash", "row_id")
    text = _plan(ordered.select("prompt", "response", "split"))
    assert len(re.findall(r"(?<!Broadcast)Exchange (?!SinglePartition)", text)) == 1 and "rangepartitioning" in text


def test_prepare_fails_when_keys_are_not_unique(spark, tmp_out):
    from sftlake.plans.prepare import prepare

    raw = spark.createDataFrame([(1, "k", f"q{i}", f"a{i}") for i in range(40)], "row_id long, kind string, input string, target string")
    with pytest.raises(RuntimeError):
        prepare(raw, tmp_out)


def test_raw_ids_follow_files_by_name_whatever_their_size(spark, tmp_out):
    from sftlake.sources.jsonl import read_raw_records

    os.makedirs(f"{tmp_out}/raw")
    sizes = {"a.json": 3, "b.json": 2000, "c.json": 40}
    for name, n in sizes.items():
        with open(f"{tmp_out}/raw/{name}", "w", encoding="utf-8") as f:
            for i in range(n):
                f.write(json.dumps({"kind": "k", "input": f"{name[0]}{i}", "target": "t"}) + "\n")
    want = [f"{name[0]}{i}" for name, n in sizes.items() for i in range(n)]
    for split_bytes in ("128m", "4k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
        raw = read_raw_records(spark, f"{tmp_out}/raw")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        got = sorted((r.row_id, r.input) for r in raw.collect())
        assert [x for _, x in got] == want and [k for k, _ in got] == list(range(len(want)))


def test_messages_only_prunes_scan(spark):
    from sftlake.plans.queries import QUERIES

    df = QUERIES["messages_only"](spark, SF_SMALL)
    rs = df._jdf.queryExecution().executedPlan().toString()
    assert "n_chars" not in rs  # unused column never read


def test_entry_and_registry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0 and set(df.columns) == {"kind", "train", "val", "test"}
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 39


@pytest.mark.parametrize("name", ["split_audit", "render_chat", "before_after_dup", "loss_curves"])
def test_queries_run_on_mid_scale(spark, name):
    from sftlake.plans.queries import QUERIES

    assert QUERIES[name](spark, SF_MID).count() > 0


def test_write_report_title_then_blocks_in_order(spark, tmp_out):
    from sftlake.operators.align import REPORT_TITLE, before_after, report_block
    from sftlake.sources.jsonl import write_report

    rows = [(p, f"P{p:03d}", "g", f"prompt {p}", f"base {p}", f"tuned {p}") for p in (30, 10, 20)]
    df = spark.createDataFrame(rows, "pos long, id string, group string, prompt string, base_output string, tuned_output string")
    blocks = before_after(df).select("pos", report_block().alias("block"))
    out = f"{tmp_out}/report"
    write_report(blocks, out, REPORT_TITLE)
    doc = "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(f"{out}/part-*")))
    assert doc.startswith("# Before vs After (OFT)\n\n## P010 - g\n\n**Prompt**\n\nprompt 10\n\n")
    assert doc.index("## P010") < doc.index("## P020") < doc.index("## P030")
    assert doc.count("# Before vs After") == 1 and doc.endswith("**OFT Output**\n\ntuned 30\n\n")


@pytest.mark.parametrize("n,expect", [(None, 200), (0, 200), (1, 1), (10_000, 200)])
def test_prepare_max_samples_edges(spark, tmp_out, n, expect):
    from sftlake.plans.prepare import prepare
    from sftlake.sources.adapters import documents_raw

    meta = prepare(documents_raw(spark, SF_SMALL), f"{tmp_out}/m{n}", max_samples=n)
    assert meta["total_raw"] == expect
    assert meta["max_samples"] == (n if n else None)


def test_prepare_rejects_bad_ratios_before_planning(spark, tmp_out):
    from sftlake.plans.prepare import prepare
    from sftlake.sources.adapters import documents_raw

    with pytest.raises(ValueError):
        prepare(documents_raw(spark, SF_SMALL), tmp_out, train_ratio=0.95, val_ratio=0.05)


def test_evaluate_job_writes_summary(spark, tmp_out):
    from sftlake.functions.chat import render_chat
    from sftlake.operators.model import fit_token_model
    from sftlake.plans.evaluate import flat_summary, token_loss_summary
    from sftlake.plans.prepare import prepare
    from sftlake.sources.adapters import documents_raw
    from sftlake.sources.jsonl import SUMMARY_SCHEMA

    prepare(documents_raw(spark, SF_SMALL), tmp_out)
    splits = read_splits(spark, f"{tmp_out}/splits")
    train = splits.where("split = 'train'").select(render_chat("messages").alias("text"))
    base = fit_token_model(train.where(~F.col("text").contains("the")), "text")
    dom = fit_token_model(train, "text")
    test = read_splits(spark, f"{tmp_out}/splits", ("test",))
    doc = token_loss_summary(test, base, dom, lam=0.5, max_samples=5, output_path=f"{tmp_out}/summary")
    r = flat_summary(doc).first()
    assert r.num_samples == min(5, test.count())
    assert r.delta_mean_nll == pytest.approx(r.tuned_nll - r.base_nll)
    back = spark.read.schema(SUMMARY_SCHEMA).json(f"{tmp_out}/summary").first()
    assert back.num_samples == r.num_samples and back.oft.mean_nll == pytest.approx(r.tuned_nll)


def test_alignment_join_keys_include_position(spark):
    """The first-match lookup joins on (id, pos): a hot id can never gather in one task."""
    from sftlake.plans.queries import QUERIES

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(QUERIES["before_after_dup"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    joins = [x for x in plan.split("\n") if "SortMergeJoin" in x]
    assert joins and all("pos" in x and ("__first" in x or "__last" in x) for x in joins)


def test_ranked_steps_never_use_a_single_partition_window(spark):
    from sftlake.sources.adapters import event_log_entries

    plan = _plan(event_log_entries(spark, SF_SMALL))
    assert "SinglePartition" not in plan
    assert "hashpartitioning(__g" in plan


def test_scoring_matrix_is_one_pass(spark):
    from sftlake.plans.queries import _scored

    m, _ = _scored(spark, SF_SMALL)
    plan = _plan(m)
    assert "Join" not in plan and "FileScan parquet" in plan  # reads the materialised matrix only
    assert "ReadSchema: struct<token:string,n_base:bigint,n_domain:bigint,v_eval:bigint>" in plan


def test_raw_dataset_reader_ids_follow_file_order(spark, tmp_out):
    from sftlake.plans.prepare import prepare
    from sftlake.sources.jsonl import read_raw_records

    p = os.path.join(tmp_out, "raw.jsonl")
    with open(p, "w", encoding="utf-8") as f:
        for i in range(30):
            f.write(json.dumps({"kind": f"k{i % 3}", "input": f"q{i}", "target": None if i == 4 else f"a{i}"}) + "\n")
    raw = read_raw_records(spark, p)
    rows = sorted(raw.collect(), key=lambda r: r.row_id)
    assert [r.input for r in rows] == [f"q{i}" for i in range(30)] and rows[0].row_id == 0
    meta = prepare(raw, f"{tmp_out}/out", max_samples=10)
    assert (meta["total_raw"], meta["total_kept"]) == (10, 9)


def test_compare_on_splits_equals_separate_models(spark, tmp_out):
    from sftlake.functions.chat import render_chat
    from sftlake.operators.model import fit_token_model
    from sftlake.plans.evaluate import compare_on_splits, flat_summary, token_loss_summary
    from sftlake.plans.prepare import prepare
    from sftlake.sources.adapters import documents_raw, table

    prepare(documents_raw(spark, SF_SMALL), tmp_out)
    base_texts = table(spark, SF_SMALL, "benchmark").select("text")
    one = flat_summary(compare_on_splits(f"{tmp_out}/splits", base_texts, lam=0.4, max_samples=7,
                                         output_path=f"{tmp_out}/cmp")).first()
    train = read_splits(spark, f"{tmp_out}/splits", ("train",)).select(render_chat("messages").alias("text"))
    two = flat_summary(token_loss_summary(read_splits(spark, f"{tmp_out}/splits", ("test",)),
                                          fit_token_model(base_texts, "text"), fit_token_model(train, "text"),
                                          lam=0.4, max_samples=7)).first()
    assert one.num_samples == two.num_samples == 7
    assert one.base_nll == pytest.approx(two.base_nll, abs=1e-12)
    assert one.tuned_nll == pytest.approx(two.tuned_nll, abs=1e-12)
    assert one.delta_mean_nll == pytest.approx(one.tuned_nll - one.base_nll)


def test_prepare_with_every_record_dropped(spark, tmp_out):
    from sftlake.plans.prepare import prepare

    raw = spark.createDataFrame([(1, "k", " ", "t"), (2, None, "p", None)], "row_id long, kind string, input string, target string")
    meta = prepare(raw, tmp_out)
    assert (meta["total_raw"], meta["total_kept"], meta["total_skipped"]) == (2, 0, 2)
    assert meta["train_size"] == meta["val_size"] == meta["test_size"] == 0
    assert read_splits(spark, f"{tmp_out}/splits").count() == 0


def test_every_registered_query_runs_on_the_smallest_tables(spark):
    """sf0.001 has strata of one row and no English test texts: every query must still run."""
    from sftlake.plans.queries import QUERIES

    failed = []
    for name, fn in QUERIES.items():
        try:
            fn(spark, SF_SMALL).write.format("noop").mode("overwrite").save()
        except Exception as e:  # noqa: BLE001
            failed.append((name, str(e)[:120]))
    assert not failed


def test_plugin_queries_run_from_any_working_directory(tmp_out):
    """Python workers must import the package even when the driver runs elsewhere."""
    import subprocess
    import sys

    code = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("entry", {os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")!r})
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
n1 = m.queries()["generate_plugin"](spark, {SF_SMALL!r}).count()
n2 = m.queries()["score_plugin"](spark, {SF_SMALL!r}).count()
print("COUNTS", n1, n2)
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_out, capture_output=True, text=True, timeout=600)
    assert "COUNTS 40 2" in out.stdout, out.stderr[-2000:]


def test_raw_dataset_reader_parquet_with_id_column(spark, tmp_out):
    from sftlake.sources.jsonl import read_raw_records

    src = spark.createDataFrame(
        [(7, "k", "q", "a", 1.5), (3, None, "p", None, 2.5)], "id long, kind string, input string, target string, extra double"
    )
    src.write.parquet(f"{tmp_out}/raw")
    got = {r.row_id: (r.kind, r.input, r.target) for r in read_raw_records(spark, f"{tmp_out}/raw", "parquet", "id").collect()}
    assert got == {7: ("k", "q", "a"), 3: (None, "p", None)}


def test_prepare_with_a_custom_key_column(spark, tmp_out):
    from sftlake.plans.prepare import prepare

    raw = spark.createDataFrame(
        [(i * 3, f"k{i % 2}", f"q{i}", f"a{i}") for i in range(12)], "rid long, kind string, input string, target string"
    )
    meta = prepare(raw, tmp_out, key="rid")
    assert meta["total_kept"] == 12
    back = read_splits(spark, f"{tmp_out}/splits")
    assert sorted(r.row_id for r in back.collect()) == [i * 3 for i in range(12)]


def test_scratch_is_removed_for_the_session_alone(tmp_out):
    import subprocess
    import sys

    code = f"""
import os, sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from pyspark.sql import SparkSession
from sftlake.sources.scratch import checkpointed, remove_scratch, session_root
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {tmp_out!r}).getOrCreate()
os.makedirs({tmp_out!r} + "/other")
assert checkpointed(spark.range(3)).count() == 3 and os.path.isdir(session_root(spark))
print("REMOVED", remove_scratch(spark), os.path.exists(session_root(spark)), sorted(x for x in os.listdir({tmp_out!r}) if x == "other"))
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert "REMOVED True False ['other']" in out.stdout, out.stderr[-1500:]


def test_superseded_tables_are_removed_and_needed_ones_stay(spark):
    from sftlake.sources.scratch import checkpointed, recorded, remove_tables

    outer = checkpointed(spark.range(3))
    with recorded() as paths:
        first = checkpointed(spark.range(10))
        kept = checkpointed(first.where("id > 4"))
    assert len(paths) == 2
    lazy = kept.where("id < 8")
    assert remove_tables(spark, [*paths, "/tmp/somewhere/else"], lazy) == [paths[1], "/tmp/somewhere/else"]
    assert sorted(r.id for r in lazy.collect()) == [5, 6, 7] and outer.count() == 3
    assert remove_tables(spark, [paths[1]], spark.range(1)) == []
    with recorded() as none:
        pass
    assert none == []


def test_records_inside_one_another_end_by_themselves(spark):
    """The outer block has recorded just what the inner one has when the inner one ends."""
    from sftlake.sources.scratch import _RECORDS, checkpointed, recorded

    before = len(_RECORDS)
    with recorded() as outer:
        with recorded() as inner:
            checkpointed(spark.range(1))
            assert inner == outer
        checkpointed(spark.range(2))
        with recorded() as empty:
            pass
    assert (len(inner), len(outer), len(empty)) == (1, 2, 0) and len(_RECORDS) == before


def test_raw_roundtrip_folders_are_written_by_many_tasks(spark, tmp_path):
    """Seven folders must not mean seven tasks: their files follow the number of partitions."""
    from pathlib import Path

    from sftlake.plans.queries import q_raw_roundtrip
    from sftlake.sources.scratch import session_root

    docs = [(k * 3, f"first {k}" + ("\nrest\nof it" if k % 2 else ""), "en", "web" if k % 5 else None, 9) for k in range(700)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    root = Path(session_root(spark).removeprefix("file:"))
    known = set(root.glob("raw-*"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(old, ("35", "false"), strict=True):
            spark.conf.set(k, v)
        got = [tuple(r) for r in q_raw_roundtrip(spark, str(tmp_path)).orderBy("row_id").collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    (made,) = set(root.glob("raw-*")) - known
    assert len(list(made.glob("part=*"))) == 7 and len(list(made.glob("part=*/*.json"))) > 21
    want = []
    for k, text, lang, source, _ in sorted(docs, key=lambda d: (d[0] % 7, d[0])):
        head, _, rest = text.partition("\n")
        want.append((len(want), "/".join(x for x in (lang, source) if x), head, rest if "\n" in text else None))
    assert got == want
