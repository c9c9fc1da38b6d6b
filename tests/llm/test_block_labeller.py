import numpy as np
import pytest

from sftlake.llm import block_labeller, queries
from sftlake.llm.block_labeller import vectors
from sftlake.llm.blocks import blocks


def texts(page):
    return [b.text for b in blocks(page)]


def test_blocks_of_odd_markup():
    assert texts("") == texts("<p></p><script>var t='</p>'</script><style>p{}</style>") == []
    assert texts("<p>a &amp; b&nbsp;c<br>d\n e<p>next<!-- x <p> --> one") == ["a & b c d e", "next one"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul></ul><td>d") == ["a", "b", "c", "d"]
    assert texts("<p>cut &am") == ["cut &am"] and texts("<p>cut <a hre") == ["cut"] and texts("a < b <3") == ["a < b <3"]
    assert texts('<p title="a > b">x</p><title>no</title><SCRIPT>1<2</SCRIPT>y') == ["x", "y"]
    assert texts("<script>never closed <p>x") == [] and texts("<!-- never closed <p>x") == []
    assert texts("<div>" * 5000 + "deep") == ["deep"] and len(texts("<p>x " * 3000)) == 3000
    b = blocks('<article class="postBody x"><div id="side-bar"><p><a href=x>link</a> rest</p>')[0]
    assert b.path == ("t:article", "c:post", "c:body", "c:x", "t:div", "c:side", "c:bar", "t:p") and b.linked == 4


def test_gradient_against_finite_differences():
    rng = np.random.default_rng(0)
    model = block_labeller.Labeller(rng)
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    pages, truth = zip(*block_labeller.training_pages(3, 2), strict=True)

    def loss():
        e, lengths = model.padded(list(pages))
        z = np.concatenate([row[:n] for row, n in zip(model.forward(e, lengths), lengths, strict=True)])
        y = np.concatenate(truth)
        return (np.logaddexp(0, z) - z * y).mean()

    grad = model.step(list(pages), list(truth))
    for name in ("dense", "xf", "hb", "bf", "out", "bias"):
        at = tuple(int(rng.integers(n)) for n in model.w[name].shape)
        if name == "dense":
            at = (block_labeller.WORD_SLOTS, at[1])
        keep, h = model.w[name][at], 1e-2
        model.w[name][at] = keep + h
        up = loss()
        model.w[name][at] = keep - h
        down = loss()
        model.w[name][at] = keep
        assert grad[name][at] == pytest.approx((up - down) / (2 * h), rel=0.1, abs=2e-4), name


def test_held_out_layouts():
    data = block_labeller.training_pages(200, 99)
    said = block_labeller.trained().label([b for b, _ in data])
    truth = [np.array(y, bool) for _, y in data]
    assert np.mean(np.concatenate(said) == np.concatenate(truth)) > 0.985


def test_every_kind_of_clutter_goes(spark):
    prose = "Some longer sentence of the article, with several words in it. And then another sentence follows."
    page = (
        '<html><head><title>T</title><style>x</style></head><body><header><p>Site name</p></header><nav><ul><li><a href="/">Home</a><li><a href="/n">News</a></ul></nav>'
        '<div class="cookie-notice"><p>We use cookies. Accept?</p></div><div class="wrapper"><article><h1>A title</h1>'
        f'<p>{prose}</p><div class="advert"><p>Buy this now, it is a very good offer.</p></div><p>{prose} 2&lt;3</p>'
        '<form><label>Name</label><button>Send</button></form></article><aside><h3>Related</h3><ul><li><a href="/r">Read this</a></ul></aside>'
        f'<div class="comments"><h3>Comments</h3><div class="comment"><p>{prose}</p></div></div></div><footer><p>&copy; 2024 Site</p></footer><script>f()</script></body></html>'
    )
    rows = [(1, "u", page), (2, None, None), (None, "v", ""), (1, "u", page), (3, "w", "<p>"), (4, "x", "<b>" * 100 + "&#x41;")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = [(r.page_id, r.text) for r in block_labeller.extract(df).collect()]
    want = f"A title\n{prose}\n{prose} 2<3"
    assert got[:5] == [(1, want), (2, ""), (None, ""), (1, want), (3, "")] and len(got) == 6
    assert block_labeller.extract(df.limit(0)).count() == 0


def test_query_agrees_with_the_marked_article(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.page_id: r for r in queries.op3_html_extraction(spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    same = [got[p.page_id].text == "\n".join(b.text for b in blocks(p.html) if "t:article" in b.path) for p in pages]
    assert len(got) == len(pages) and np.mean(same) > 0.97 and all(r.n_chars == len(r.text) for r in got.values())


def test_every_class_word_of_an_element_is_kept():
    from sftlake.llm.blocks import blocks

    many = " ".join(f"u{k}" for k in range(40))
    (block,) = blocks(f'<div class="{many} {many} comments" id="x">text</div>')
    assert "c:comments" in block.path and "c:x" in block.path and len(set(block.path)) == len(block.path)


def test_deep_nesting_is_linear():
    import time

    deep = "<div class='a b c d e f g h'>x" * 40_000 + "</p>" * 40_000
    began = time.process_time()
    found = blocks(deep)
    assert len(found) == 40_000 and found[-1].leaf == found[-1].parent == "div"
    assert found[-1].level.slots is found[1].level.slots  # one set for all levels that name nothing new
    vectors(found)
    assert time.process_time() - began < 20
    many = "".join(f"<section class='{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}'>y" for k in range(8_000))
    assert max(len(b.level.slots) for b in blocks(many)) <= 1024
    assert len(blocks("<ul><li>" + "<fieldset>" * 3_000 + "<ul>" + "<li>z</li>" * 20_000)) == 20_000


def test_implied_ends_by_name():
    page = "<ul><li>a<li>b<ul><li>c<li>d</ul><li>e</ul><p>f<p>g<div>h<p>i</div>j<table><tr><td>k<td>l<tr><td>m</table>n"
    got = [(b.text, len([n for n in b.path if n.startswith("t:")])) for b in blocks(page)]
    assert got == [("a", 2), ("b", 2), ("c", 4), ("d", 4), ("e", 2), ("f", 1), ("g", 1), ("h", 1), ("i", 2), ("j", 0), ("k", 3), ("l", 3), ("m", 4), ("n", 0)]
