from __future__ import annotations

from pyspark.sql import functions as F

from sftlake.functions.text import kind_or_unknown, normalize_text
from sftlake.operators.records import convert_records, explode_messages, normalized

PY_WHITESPACE = [chr(c) for c in range(0x110000) if chr(c).isspace()]


def test_python_has_29_whitespace_code_points():
    assert len(PY_WHITESPACE) == 29


def test_normalize_matches_python_strip_for_every_whitespace(spark):
    rows = [(i, ws + "ab c" + ws) for i, ws in enumerate(PY_WHITESPACE)]
    rows += [(100, "a\n\n"), (101, "  inner   spaces  "), (102, "​"), (103, ""), (104, "　 x　")]
    df = spark.createDataFrame(rows, "i int, s string")
    got = {r.i: r.n for r in df.select("i", normalize_text("s").alias("n")).collect()}
    for i, s in rows:
        assert got[i] == s.strip(), (i, repr(s))


def test_normalize_null_is_empty(spark):
    df = spark.createDataFrame([(None,)], "s string")
    assert df.select(normalize_text("s").alias("n")).first().n == ""


def test_kind_default(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("　 x 　",), ("y",)], "k string")
    got = [r.k for r in df.select(kind_or_unknown("k").alias("k")).collect()]
    assert got == ["unknown", "unknown", "unknown", "x", "y"]


def test_convert_drops_incomplete_and_builds_two_messages(spark):
    rows = [
        (1, "k", None, "t"),
        (2, "k", "p", "　"),
        (3, "k", " ", " "),
        (4, None, " p ", " t "),
        (5, " 　", "p", "t"),
        (6, " kk ", "p", "t"),
    ]
    raw = spark.createDataFrame(rows, "row_id long, kind string, input string, target string")
    out = {r.row_id: r for r in convert_records(raw).collect()}
    assert sorted(out) == [4, 5, 6]
    assert out[4].kind == "unknown" and out[4].prompt == "p" and out[4].response == "t"
    assert out[5].kind == "unknown"
    assert out[6].kind == "kk"
    assert [(m.role, m.content) for m in out[6].messages] == [("user", "p"), ("assistant", "t")]
    flags = {r.row_id: r.kept for r in normalized(raw).collect()}
    assert flags == {1: False, 2: False, 3: False, 4: True, 5: True, 6: True}


def test_explode_messages(spark):
    raw = spark.createDataFrame([(7, "k", "p", "t")], "row_id long, kind string, input string, target string")
    ex = explode_messages(convert_records(raw), "row_id").orderBy("pos").collect()
    assert [(r.pos, r.role, r.content) for r in ex] == [(0, "user", "p"), (1, "assistant", "t")]


def test_plain_trim_would_be_wrong(spark):
    df = spark.createDataFrame([("　x　",)], "s string")
    r = df.select(F.trim("s").alias("t"), normalize_text("s").alias("n")).first()
    assert r.t != "x" and r.n == "x"
