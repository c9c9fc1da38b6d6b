import hashlib
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st

from sftlake.llm import fim

MARKS = [s.encode() for s in fim.SENTINELS]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(doc_id, text, rate=100, spm=50, seed=7):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = sha(f"{seed}:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in fim.SENTINELS) or h[2] % 100 >= rate:
        return (len(lines), "plain", None, None, text)
    a, b = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    pre, mid, suf = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    form = "spm" if h[3] % 100 < spm else "psm"
    out = f"<P>{pre}<S>{suf}<M>{mid}" if form == "psm" else f"<S>{suf}<P>{pre}<M>{mid}"
    return (len(lines), form, len(pre), len(mid), out)


@given(st.text("a<P>SM\né", max_size=30), st.data(), st.sampled_from(["psm", "spm"]))
def test_arranged_pieces_come_back(text, data, form):
    if any(m in text for m in fim.SENTINELS):
        return
    whole = b"before" + text.encode() + b"after"
    lo, hi = 6, len(whole) - 5
    a = data.draw(st.integers(0, hi - lo))
    b = data.draw(st.integers(a, hi - lo))
    table = fim.arrange_text(whole, lo, hi, a, b, form, MARKS)
    out = table.bytes()
    assert table.sha256() == hashlib.sha256(out).hexdigest()
    assert len(out) == hi - lo + 9 and table.buffers[0] is whole
    back = fim.restore_text(b"x" + out + b"<P>", 1, 1 + len(out), form, MARKS)
    assert back.bytes().decode() == text


def test_permutations_are_inverse():
    for order in fim.ORDERS.values():
        assert [order[k] for k in fim.inverse(order)] == list(range(6))


@pytest.mark.parametrize("marks", [("<P>", "<S>", "<P>x"), ("ab", "ba", "c"), ("aa", "b", "c"), ("", "b", "c"), ("a", "bab", "c")])
def test_sentinels_that_could_be_mistaken(marks):
    with pytest.raises(ValueError):
        fim._marks(marks)


def test_a_cut_outside_its_piece_and_a_lost_sentinel():
    with pytest.raises(ValueError):
        fim.PieceTable((b"abc",), [fim.Piece(0, 0, 3)]).cut(0, 4)
    with pytest.raises(ValueError):
        fim.restore_text(b"<P>a<S>b", 0, 8, "psm", MARKS)


ROWS = [
    (1, None), (2, ""), (3, "\n"), (4, "one line"), (5, "a\nb\nc\nd"), (6, "a\nb\nc\n"), (7, "holds <M> already\nx"), (8, "\n\n\n"),
    (None, "null id\nx\ny\nz"), (5, "a\nb\nc\nd"), (5, "another\ntext\n"), (9, "é\nü日本\n" * 9), (10, "long " * 200_000 + "\n" + "x\n" * 100_000), (11, "\r\nx\x00y\r\n"), (12, "<P\n<S\n>M>"),
] + [(k, "\n".join(f"l{j}" for j in range(k % 13))) for k in range(20, 120)]


@pytest.mark.parametrize("rate,spm", [(100, 50), (40, 0), (0, 50)])
def test_rows_against_plain_python(spark, rate, spm):
    docs = spark.createDataFrame([(*r, "c", 5, "e") for r in ROWS], "doc_id long, text string, form string, n_units int, extra string")
    out = fim.restore(fim.arrange(docs, rate=rate, spm=spm))
    got = out.collect()
    assert set(out.columns) == {"doc_id", "text", "extra", "n_units", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "restored", "restored_sha256"}
    want = sorted(((d, *plain(d, t, rate, spm)) for d, t in ROWS), key=str)
    assert sorted(((r.doc_id, r.n_units, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=str) == want
    for r in got:
        assert r.restored == (r.text or "") and r.restored_sha256 == sha(r.text or "") and r.output_sha256 == sha(r.output) and r.extra == "e"
    assert fim.restore(fim.arrange(docs.limit(0))).count() == 0
