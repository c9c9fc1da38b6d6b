"""Typed JSON fields against Python's str, and trainer-state documents against json.load."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from sftlake.functions.pytext import python_float
from sftlake.sources.jsonl import read_prompts, read_raw_records, read_typed
from sftlake.sources.trainer_log import read_trainer_documents, write_trainer_states


def _lines(path, lines):
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_python_float_equals_str(spark):
    rng = random.Random(7)
    values = [0.0, -0.0, 1.0, 1e10, 1e15, 1e16, 123456789012345680.0, 1e22, 2e23, 1e-4, 1e-5, 0.1, 1 / 3, 5.684341886080802e-14]
    values += [1.7976931348623157e308, 9007199254740993.0, float("inf"), float("-inf"), float("nan"), 100.0, -2.5, 1234.5678]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-30, 30) for _ in range(3000)] + [rng.randint(1, 10**6) / 8 for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, x double").select("i", python_float("x").alias("t"))
    got = [r.t for r in sorted(df.collect())]
    for t, v in zip(got, values, strict=True):
        digits = str(v).lower().split("e")[0].strip("-").replace(".", "").strip("0")
        if t != str(v):  # Java before 19 may name a neighbour of the nearest shortest text
            assert len(digits) > 15 and float(t) == v and len(t) <= len(str(v)) + 1, (t, v)
    assert sum(t != str(v) for t, v in zip(got, values, strict=True)) < len(values) / 100


def test_typed_fields_equal_python(spark, tmp_out):
    texts = ['"x"', '" \\u3000é\\n"', '""', "null", "true", "false", '"true"', "0", "-0", "12", "1234567890123456789012345678901234567890123", "1e10", "1.50", "1.0", "-0.0", "1E-7", "1e400", "5e15", "1e16"]
    lines = [f'{{"id": {i}, "input": {t}, "other": "{{}}"}}' for i, t in enumerate(texts)] + ['{"id": 99}', "", "  "]
    p = _lines(f"{tmp_out}/t.jsonl", lines)
    want = {}
    for r in map(json.loads, filter(str.strip, lines)):
        v = r.get("input")
        want[str(r["id"])] = ("input" in r, None if v is None else str(v))
    got = read_typed(spark, p, ["id", "input"])
    assert got.columns == ["id", "has_id", "input", "has_input"]
    assert {r.id: (r.has_input, r.input) for r in got.collect()} == want
    nested = read_typed(spark, _lines(f"{tmp_out}/n.jsonl", ['{"input": {"a": [1, "b"]}}']), ["input"])
    assert nested.first().input == '{"a":[1,"b"]}'
    with pytest.raises(Exception):
        read_typed(spark, _lines(f"{tmp_out}/bad.jsonl", ['{"input": oops}']), ["input"]).collect()


def test_prompts_and_raw_records_keep_types(spark, tmp_out):
    p = _lines(f"{tmp_out}/p.jsonl", ['{"id": 1, "prompt": "a"}', '{"id": "2", "group": null, "prompt": true}', '{"id": 3.0, "group": 4, "prompt": "c"}'])
    assert sorted(map(tuple, read_prompts(spark, p).collect())) == [("1", "unknown", "a"), ("2", None, "True"), ("3.0", "4", "c")]
    p = _lines(f"{tmp_out}/r.jsonl", ['{"kind": false, "input": 1e3, "target": "t"}', '{"input": "q"}'])
    assert sorted(map(tuple, read_raw_records(spark, p).collect())) == [(0, "False", "1000.0", "t"), (1, None, "q", None)]


ENTRIES = [
    {"step": 10, "loss": 2.0, "note": 'a "quoted\\" }] text, {"log_history": ['},
    {"step": 10, "loss": 1.0},
    {"step": None, "loss": 9.9},
    {"step": 30, "loss": None, "nested": {"a": [1, {"b": "]"}]}},
    {"eval_loss": 1.5},
]


def _documents(root):
    docs = {
        "indented": json.dumps({"best": None, "callbacks": {"log": [{"x": 1}]}, "log_history": ENTRIES, "tail": [{"y": 2}]}, indent=2),
        "wide": json.dumps({"log_history": ENTRIES * 300}, indent=7),
        "oneline": json.dumps({"log_history": ENTRIES}),
        "missing": json.dumps({"best_metric": None}, indent=2),
        "missing1": json.dumps({"best_metric": None}),
        "empty": json.dumps({"log_history": [], "a": 1}, indent=2),
        "dense": '{\n "log_history": [\n' + ", ".join(json.dumps(e) for e in ENTRIES[:3]) + ",\n" + json.dumps(ENTRIES[4]) + "\n ]\n}",
        "joined": '{\n "log_history": [\n {\n"step": 1\n}, {\n"step": 2\n}\n ]\n}',
        "twice": '{\n "log_history": [\n {"step": 1}\n ],\n "log_history": [\n {"step": 2}\n ]\n}',
    }
    paths = {}
    for name, text in docs.items():
        os.makedirs(f"{root}/{name}", exist_ok=True)
        paths[name] = _lines(f"{root}/{name}/trainer_state.json", [text])
    return docs, paths


def test_trainer_documents_equal_json(spark, tmp_out):
    docs, paths = _documents(tmp_out)
    want = {(n, i): (set(e), e.get("step")) for n, t in docs.items() for i, e in enumerate(json.loads(t).get("log_history", []))}
    for split_bytes in ("128m", "4k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
        rows = read_trainer_documents(spark, list(paths.values())).collect()
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        got = {(r.run_path.split("/")[-2], r.pos): r.entry for r in rows}
        assert len(rows) == len(got) and set(got) == set(want)
        for key, entry in got.items():
            keys, step = want[key]
            assert set(entry) == keys and entry.get("step") == (None if step is None else str(step))
            if "note" in keys:
                assert entry["note"] == ENTRIES[0]["note"]


@pytest.mark.parametrize("text", ['{"log_history": [\n {"step": 1}\n ]\n}', '{\n "log_history": [\n {\n "step": 1\n } ]\n}'])
def test_trainer_documents_of_other_layouts_fail(spark, tmp_out, text):
    p = _lines(f"{tmp_out}/t.json", [text])
    with pytest.raises(Exception, match="within a line"):
        read_trainer_documents(spark, [p]).collect()


def test_trainer_documents_written_in_parts(spark, tmp_out):
    rows = [(f"r{i % 3 // 2}", i, i * 10 if i % 4 else None, float(i)) for i in range(600)]
    df = spark.createDataFrame(rows, "run string, i long, step long, loss double")
    from pyspark.sql import Window

    df = df.withColumn("pos", F.row_number().over(Window.partitionBy("run").orderBy("i")) - 1).drop("i")
    write_trainer_states(df, f"{tmp_out}/states")
    for run in ("r0", "r1"):
        parts = sorted(f for f in os.listdir(f"{tmp_out}/states/run={run}") if f.startswith("part-"))
        state = json.loads("".join(open(f"{tmp_out}/states/run={run}/{f}", encoding="utf-8").read() for f in parts))
        assert [e["loss"] for e in state["log_history"]] == [r[3] for r in rows if r[0] == run]
    got = read_trainer_documents(spark, [f"{tmp_out}/states"])
    got = {(r.run_path[-2:], r.pos): float(r.entry["loss"]) for r in got.collect()}
    assert got == {(r.run, r.pos): r.loss for r in df.collect()}


def test_lines_of_a_block_are_not_sorted_as_one_group(spark, tmp_out, monkeypatch):
    """A block of a file may be 128 MB of short lines; what is summed up in order is far smaller."""
    n = 30_000
    os.makedirs(f"{tmp_out}/run=a")
    p = _lines(f"{tmp_out}/run=a/part-0", ["{", ' "log_history": [', *(f'  {{\n   "step": {i}\n  }}' + "," * (i < n - 1) for i in range(n)), " ]", "}"])
    frame, groups = type(spark.range(1)), []

    def join(self, other, on=None, *how, real=frame.join):
        if "value" in self.columns and on in ("__g", ["c", "h"]):  # a running total's groups
            groups.append(max(r["count"] for r in self.groupBy(on).count().collect()))
        return real(self, other, on, *how)

    monkeypatch.setattr(frame, "join", join)
    rows = read_trainer_documents(spark, [p]).select("pos", F.col("entry")["step"].cast("long").alias("s")).collect()
    assert sorted((r.pos, r.s) for r in rows) == [(i, i) for i in range(n)]
    assert len(groups) == 2 and max(groups) <= 1 << 16 < 3 * n
