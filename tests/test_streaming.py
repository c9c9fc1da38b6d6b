from __future__ import annotations

import json
import os

from sftlake.streaming.streams import curve_progress, log_point_stream, record_stream, write_progress, write_records


def _write_lines(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        for r in rows:
            f.write(json.dumps(r, ensure_ascii=False) + "\n")


def test_record_stream_matches_batch(spark, tmp_out):
    raw = os.path.join(tmp_out, "raw")
    _write_lines(f"{raw}/a.json", [
        {"row_id": 1, "kind": " k ", "input": "hi", "target": "yo"},
        {"row_id": 2, "kind": None, "input": "　", "target": "x"},
    ])
    _write_lines(f"{raw}/b.json", [{"row_id": 3, "input": "问题", "target": "答案"}])
    out = os.path.join(tmp_out, "out")
    q = write_records(record_stream(spark, raw, max_files_per_trigger=1), out)
    q.awaitTermination(120)
    got = {r.row_id: r for r in spark.read.schema("row_id long, kind string, text string, n_tokens int").json(out).collect()}
    assert sorted(got) == [1, 3]
    assert got[1].kind == "k" and got[3].kind == "unknown"
    assert got[3].n_tokens > 0 and "问题" in got[3].text


def test_log_stream_progress(spark, tmp_out):
    logs = os.path.join(tmp_out, "logs")
    _write_lines(f"{logs}/run=main/p0.json", [{"step": 10, "loss": 2.0}, {"step": 20, "loss": 1.5, "eval_loss": 1.7}])
    _write_lines(f"{logs}/run=abl/p0.json", [{"step": 10, "loss": 3.0}, {"loss": 9.0}])
    out = os.path.join(tmp_out, "progress")
    q = write_progress(curve_progress(log_point_stream(spark, logs)), out)
    q.awaitTermination(120)
    rows = {(r.run, r.series): (r.n, r.last_step, r.first_loss, r.last_loss)
            for r in spark.read.parquet(out).collect()}
    assert rows == {
        ("main", "train"): (2, 20, 2.0, 1.5),
        ("main", "eval"): (1, 20, 1.7, 1.7),
        ("abl", "train"): (1, 10, 3.0, 3.0),
    }


def test_record_stream_restart_processes_only_new_files(spark, tmp_out):
    raw, out, ckpt = (os.path.join(tmp_out, d) for d in ("raw2", "out2", "ckpt2"))
    _write_lines(f"{raw}/a.json", [{"row_id": 1, "kind": "k", "input": "a", "target": "b"}])
    write_records(record_stream(spark, raw), out, checkpoint=ckpt).awaitTermination(120)
    _write_lines(f"{raw}/b.json", [{"row_id": 2, "kind": "k", "input": "c", "target": "d"}])
    write_records(record_stream(spark, raw), out, checkpoint=ckpt).awaitTermination(120)
    ids = sorted(r.row_id for r in spark.read.schema("row_id long").json(out).collect())
    assert ids == [1, 2]
