from __future__ import annotations

import json
import os

import pytest

from sftlake.operators.align import before_after, prompt_groups, report_block
from sftlake.operators.curves import curve_compare, label_runs, loss_points, resolve_labels, run_summary
from sftlake.sources.jsonl import read_trainer_states

ROWS = "pos long, id string, group string, prompt string, base_output string, tuned_output string"


def _loop_reference(rows):
    """The sequential rule: results in order; each prompt updates the first equal id."""
    results = [dict(pos=r[0], id=r[1], tuned="") for r in rows]
    for r in rows:
        for res in results:
            if res["id"] == r[1]:
                res["tuned"] = r[5]
                break
    return {x["pos"]: x["tuned"] for x in results}


@pytest.mark.parametrize(
    "ids",
    [
        ["a", "b", "c"],
        ["a", "b", "a", "a", "c", "b"],
        [None, "x", None, None, "x"],
        ["k"] * 7,
    ],
)
def test_alignment_matches_sequential_rule(spark, ids):
    rows = [(i * 10, id_, "g", f"p{i}", f"b{i}", f"t{i}") for i, id_ in enumerate(ids)]
    got = {r.pos: r.tuned_output for r in before_after(spark.createDataFrame(rows, ROWS)).collect()}
    assert got == _loop_reference(rows)


def test_group_default_and_prompt_counts(spark):
    rows = [(1, "a", None, "p", "b", "t"), (2, "b", "g1", "q", "b", "t")]
    df = spark.createDataFrame(rows, ROWS)
    out = {r.pos: r.group for r in before_after(df).collect()}
    assert out == {1: None, 2: "g1"}  # an explicit null is not a missing key
    assert {r.group: r.n for r in prompt_groups(df).collect()} == {None: 1, "g1": 1}
    assert {r.group: r.n for r in prompt_groups(df.drop("group")).collect()} == {"unknown": 2}


def test_report_block_format(spark):
    rows = [(1, "P001", "sum", "prompt", "base", "tuned")]
    b = spark.createDataFrame(rows, ROWS).select(report_block().alias("b")).first().b
    assert b == (
        "## P001 - sum\n\n**Prompt**\n\nprompt\n\n**Base Model Output**\n\nbase\n\n**OFT Output**\n\ntuned\n\n"
    )


def _write_state(root, name, doc):
    d = os.path.join(root, name)
    os.makedirs(d, exist_ok=True)
    p = os.path.join(d, "trainer_state.json")
    with open(p, "w", encoding="utf-8") as f:
        f.write(doc if isinstance(doc, str) else json.dumps(doc, indent=2))
    return p


def test_log_rules(spark, tmp_out):
    doc = {
        "log_history": [
            {"step": 10, "loss": 2.0},
            {"step": 10, "eval_loss": 1.5},
            {"step": 20, "loss": 1.8, "eval_loss": 1.4, "learning_rate": "warmup"},
            {"loss": 9.9},
            {"step": None, "loss": 9.9},
            {"step": 30, "loss": None},
            {"step": 40, "grad_norm": 0.1},
        ]
    }
    p1 = _write_state(tmp_out, "runA", doc)
    p2 = _write_state(tmp_out, "runB", {"best_metric": None})
    entries = read_trainer_states(spark, [p1, p2]).withColumnRenamed("run_path", "run")
    pts = sorted((r.series, r.step, r.loss) for r in loss_points(entries).collect())
    assert pts == [("eval", 10, 1.5), ("eval", 20, 1.4), ("train", 10, 2.0), ("train", 20, 1.8), ("train", 30, None)]


def test_label_rule():
    paths = ["out/main/trainer_state.json", "out/abl/trainer_state.json", "x/third/trainer_state.json"]
    assert resolve_labels(paths, None) == ["main", "abl", "third"]
    assert resolve_labels(paths, ["A"]) == ["A", "abl", "third"]
    assert resolve_labels(paths, ["A", "B", "C", "D"]) == ["A", "B", "C"]


def test_compare_and_summary(spark):
    pts = spark.createDataFrame(
        [("r0", "train", 10, 3.0), ("r0", "train", 20, 2.0), ("r0", "eval", 20, 2.5), ("r1", "train", 10, 4.0)],
        "run string, series string, step long, loss double",
    )
    c = {(r.label, r.series): (r.n, r.first_loss, r.last_loss) for r in curve_compare(label_runs(pts, {"r0": "main"})).collect()}
    assert c == {("main", "train"): (2, 3.0, 2.0), ("main", "eval"): (1, 2.5, 2.5), ("r1", "train"): (1, 4.0, 4.0)}
    s = {(r.run, r.metric): r.value for r in run_summary(pts).collect()}
    assert s[("r0", "train_loss")] == 2.5 and s[("r0", "eval_loss")] == 2.5 and s[("r1", "eval_points")] == 0.0


def test_generate_before_after_one_pass(spark):
    from sftlake.operators.align import generate, generate_before_after

    def echo_factory():
        def gen(prompts, max_new_tokens=256, **_):
            return [" " + p[-max_new_tokens:] + " " for p in prompts]

        return gen

    def upper_factory():
        return lambda prompts, **_: [p.upper() for p in prompts]

    rows = [(1, "a", "g", "x y"), (2, "a", "g", "z"), (3, "b", None, "w")]
    prompts = spark.createDataFrame(rows, "pos long, id string, group string, prompt string")
    out = {r.pos: r for r in generate_before_after(prompts, echo_factory, upper_factory, "t1").collect()}
    assert out[1].base_output == "x y" and out[1].tuned_output == "Z"  # first 'a' gets the last 'a'
    assert out[2].tuned_output == "" and out[3].group is None and out[3].tuned_output == "W"
    g = {r.id: r.output for r in generate(prompts.where("pos = 3"), "id", "prompt", echo_factory, "t2",
                                           render_template=True, max_new_tokens=33).collect()}
    assert g["b"] == "<|im_end|>\n<|im_start|>assistant"  # last 33 chars of the rendered prompt, stripped


def test_loss_curves_from_state_documents(spark, tmp_out):
    from sftlake.operators.curves import loss_curves

    p1 = _write_state(tmp_out, "run_main", {"log_history": [{"step": 10, "loss": 2.0}, {"step": 10, "eval_loss": 1.9}]})
    p2 = _write_state(tmp_out, "run_ablation", {"log_history": [{"step": 10, "loss": 2.5}]})
    got = sorted((r.label, r.series, r.step, r.loss) for r in loss_curves(spark, [p1, p2], ["block 32"]).collect())
    assert got == [("block 32", "eval", 10, 1.9), ("block 32", "train", 10, 2.0), ("run_ablation", "train", 10, 2.5)]


def test_loss_curves_labels_for_any_spelling_of_a_path(spark, tmp_out, monkeypatch):
    from sftlake.operators.curves import loss_curves

    p1 = _write_state(tmp_out, "run a%20b", {"log_history": [{"step": 10, "loss": 2.0}, {"step": 10, "loss": 1.0}]})
    p2 = _write_state(tmp_out, "other", {"log_history": [{"step": 5, "eval_loss": 3.0}]})
    monkeypatch.chdir(tmp_out)
    for a, b in ((p1.replace("%", "%25").replace(" ", "%20"), p2), (p1, "file:" + p2)):
        try:
            got = sorted((r.label, r.pos, r.loss) for r in loss_curves(spark, [p1, b], ["first"]).collect())
        except Exception:  # noqa: BLE001 - a spelling that Spark itself can't read
            continue
        assert got == [("first", 0, 2.0), ("first", 1, 1.0), ("other", 0, 3.0)]


def test_merged_run_summary(spark):
    from sftlake.operators.curves import merged_run_summary

    t = spark.createDataFrame([("a", {"loss": 1.0, "epoch": 2.0}), ("b", {"loss": 3.0})], "run string, metrics map<string,double>")
    e = spark.createDataFrame([("a", {"eval_loss": 1.5, "epoch": 2.5}), ("c", {"eval_loss": 4.0})], "run string, metrics map<string,double>")
    got = sorted(map(tuple, merged_run_summary(t, e).collect()))
    assert got == [("a", "epoch", 2.5), ("a", "eval_loss", 1.5), ("a", "loss", 1.0), ("b", "loss", 3.0), ("c", "eval_loss", 4.0)]


def test_generated_rows_are_the_same_in_every_use(spark, tmp_out):
    import glob

    from sftlake.operators.align import generate_before_after, write_before_after
    from sftlake.sources.jsonl import read_report

    def random_factory():
        import random

        return lambda prompts, **_: [f"{p} {random.random()}" for p in prompts]

    prompts = spark.createDataFrame([(k, f"P{k}", "g", f"p{k}") for k in range(9)], "pos long, id string, group string, prompt string")
    out = generate_before_after(prompts, random_factory, random_factory, "random")
    assert "MapInPandas" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, out.collect()))
    assert write_before_after(out, f"{tmp_out}/w") == 9
    lines = [json.loads(x) for f in sorted(glob.glob(f"{tmp_out}/w/jsonl/part-*")) for x in open(f, encoding="utf-8")]
    assert [x["pos"] for x in lines] == list(range(9))
    blocks = [r.block for r in read_report(spark, f"{tmp_out}/w/report").collect()]
    assert len(blocks) == 9 and all(any(x["tuned_output"] in b for b in blocks) for x in lines)
