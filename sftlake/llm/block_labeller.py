"""Main text of web pages by a recurrent block labeller.

A page is a sequence of leaf blocks. Each block is read as a vector of its tag path and class
words (hashed), its words (hashed) and a few sizes; a bidirectional LSTM passes over the whole
sequence in both directions and every block is classified with the context of the entire page.
All in numpy; pages of like length go through together.

There are no labelled pages, so the labeller is trained on ``TRAIN_PAGES`` pages drawn from a
layout grammar (menus, headers, adverts, notices, forms, sidebars, comments around and inside an
article, with and without telling class names), whose labels are known by construction. The
training is seeded and takes a few seconds on the driver; the weights (well under 1 MB) are
broadcast.

Null html counts as empty and gives an empty text; cut-off markup is read as far as it goes.
Null ids, repeated rows and ties are kept, an empty table gives no rows, and only the columns
named in ``keep`` are returned beside ``text``. One page is always whole in memory."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftlake.llm import textkit
from sftlake.llm.blocks import PATH_SLOTS, Block, blocks, slot
from sftlake.llm.common import ship_package

WORD_SLOTS, SIZES, EMBED, HIDDEN = 64, 6, 32, 24
TRAIN_PAGES = 2000
_BATCH_CELLS = 16_384


@functools.lru_cache(20_000)
def _slots(above: frozenset[int], near: str, leaf: str, parent: str) -> tuple[int, ...]:
    return tuple(above | {slot(p) for p in ("leaf:" + leaf, "under:" + parent, f"near:{near}", f"near:{near} {leaf}")})


_NOWHERE: frozenset[int] = frozenset()


def vectors(found: list[Block]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(path slots, their block, dense part) of a run of blocks."""
    slots, owner = [], []
    for k, b in enumerate(found):
        own = _slots(b.level.slots, b.level.near, b.leaf, b.parent) if b.level else _slots(_NOWHERE, "", "", "")
        slots += own
        owner += [k] * len(own)
    data, off = textkit.text_buffer(pa.array([b.text for b in found], pa.string()))
    w = textkit.Words(data, off, lower=True)
    n = len(found)
    words = np.bincount(w.doc() * WORD_SLOTS + (w.hash % np.uint64(WORD_SLOTS)).astype(np.int64), minlength=n * WORD_SLOTS)
    count = np.diff(w.off)
    size = np.array([b.size for b in found], float)
    linked = np.array([b.linked for b in found], float)
    ends = np.array([b.text[-1:] in ".!?…。:" for b in found], float)
    stats = np.stack([np.log1p(size) / 5, np.log1p(count) / 4, linked / np.maximum(size, 1), ends, (count < 4).astype(float), np.ones(n)], 1)
    words = np.log1p(words.reshape(n, WORD_SLOTS)) / np.log1p(np.maximum(count, 1))[:, None] / 4
    return np.array(slots, np.int64), np.array(owner, np.int64), np.concatenate([words, stats], 1).astype(np.float32)


class Labeller:
    """One embedding layer, one LSTM in each direction, one logistic output."""

    def __init__(self, rng: np.random.Generator):
        def init(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.w = {"path": init(PATH_SLOTS, EMBED) * 8, "dense": init(WORD_SLOTS + SIZES, EMBED)}
        for d in "fb":
            self.w |= {"x" + d: init(EMBED, 4 * HIDDEN), "h" + d: init(HIDDEN, 4 * HIDDEN), "b" + d: np.zeros(4 * HIDDEN, np.float32)}
            self.w["b" + d][HIDDEN : 2 * HIDDEN] = 1  # the forget gate starts open
        self.w |= {"out": init(2 * HIDDEN + EMBED, 1), "bias": np.zeros(1, np.float32)}

    def embed(self, slots: np.ndarray, owner: np.ndarray, dense: np.ndarray) -> np.ndarray:
        z = dense @ self.w["dense"]
        if len(slots):
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            z[owner[first]] += np.add.reduceat(self.w["path"][slots], first, axis=0) / 4
        return np.tanh(z)

    def _pass(self, x: np.ndarray, mask: np.ndarray, d: str, tape: list | None = None) -> np.ndarray:
        """x (time, page, EMBED), already turned for the backward direction."""
        h = c = np.zeros((x.shape[1], HIDDEN), np.float32)
        out = np.empty((*x.shape[:2], HIDDEN), np.float32)
        gates_x = x @ self.w["x" + d] + self.w["b" + d]
        for t in range(len(x)):
            z = gates_x[t] + h @ self.w["h" + d]
            s = 1 / (1 + np.exp(-np.clip(z[:, : 3 * HIDDEN], -30, 30)))
            i, f, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            c2 = f * c + i * g
            tc = np.tanh(c2)
            h2 = o * tc
            m = mask[t][:, None]
            if tape is not None:
                tape.append((h, c, i, f, o, g, tc, m))
            h, c = np.where(m, h2, h), np.where(m, c2, c)
            out[t] = h
        return out

    def _back(self, x: np.ndarray, dout: np.ndarray, d: str, tape: list, grad: dict) -> np.ndarray:
        dh = dc = np.zeros((x.shape[1], HIDDEN), np.float32)
        dx = np.empty_like(x)
        wx, wh = self.w["x" + d], self.w["h" + d]
        for t in range(len(x) - 1, -1, -1):
            h, c, i, f, o, g, tc, m = tape[t]
            dh = dh + dout[t]
            dh2, keep_h, keep_c = np.where(m, dh, 0), np.where(m, 0, dh), np.where(m, 0, dc)
            dc2 = np.where(m, dc, 0) + dh2 * o * (1 - tc * tc)
            dz = np.concatenate([dc2 * g * i * (1 - i), dc2 * c * f * (1 - f), dh2 * tc * o * (1 - o), dc2 * i * (1 - g * g)], 1)
            grad["x" + d] += x[t].T @ dz
            grad["h" + d] += h.T @ dz
            grad["b" + d] += dz.sum(0)
            dx[t] = dz @ wx.T
            dh, dc = dz @ wh.T + keep_h, dc2 * f + keep_c
        return dx

    def forward(self, e: np.ndarray, lengths: np.ndarray, tapes: dict | None = None) -> np.ndarray:
        """Logits (page, time) from embeddings (page, time, EMBED)."""
        x = e.transpose(1, 0, 2)
        mask = np.arange(len(x))[:, None] < lengths
        hf = self._pass(x, mask, "f", None if tapes is None else tapes.setdefault("f", []))
        hb = self._pass(x[::-1], mask[::-1], "b", None if tapes is None else tapes.setdefault("b", []))[::-1]
        top = np.concatenate([hf, hb, x], 2)
        if tapes is not None:
            tapes["top"], tapes["mask"] = top, mask
        return (top @ self.w["out"] + self.w["bias"])[:, :, 0].T

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Which blocks of each page are main text."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
        while order:
            longest = len(pages[order[-1]])
            group = order[-max(1, _BATCH_CELLS // longest) :]
            del order[-len(group) :]
            e, lengths = self.padded([pages[k] for k in group])
            logit = self.forward(e, lengths)
            for k, row, n in zip(group, logit, lengths, strict=True):
                out[k] = row[:n] > 0
        return out

    def padded(self, pages: list[list[Block]]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(p) for p in pages])
        flat = self.embed(*vectors([b for p in pages for b in p]))
        e = np.zeros((len(pages), lengths.max(), EMBED), np.float32)
        e[np.arange(lengths.max()) < lengths[:, None]] = flat
        return e, lengths

    def step(self, pages: list[list[Block]], truth: list[list[bool]]) -> dict[str, np.ndarray]:
        """Gradients of the mean log loss over a batch of pages."""
        slots, owner, dense = vectors([b for p in pages for b in p])
        flat = self.embed(slots, owner, dense)
        lengths = np.array([len(p) for p in pages])
        live = np.arange(lengths.max()) < lengths[:, None]
        e = np.zeros((len(pages), lengths.max(), EMBED), np.float32)
        e[live] = flat
        y = np.zeros(live.shape, np.float32)
        y[live] = np.concatenate(truth)
        tapes: dict = {}
        logit = self.forward(e, lengths, tapes)
        d = np.where(live, 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y, 0).astype(np.float32).T[:, :, None] / live.sum()
        grad = {k: np.zeros_like(v) for k, v in self.w.items()}
        top = tapes["top"]
        grad["out"] = (top.reshape(-1, top.shape[2]).T @ d.reshape(-1, 1)).astype(np.float32)
        grad["bias"] = d.sum((0, 1))
        dtop = d @ self.w["out"].T
        x = e.transpose(1, 0, 2)
        dx = dtop[:, :, 2 * HIDDEN :] + self._back(x, dtop[:, :, :HIDDEN], "f", tapes["f"], grad)
        dx = dx + self._back(x[::-1], dtop[::-1, :, HIDDEN : 2 * HIDDEN], "b", tapes["b"], grad)[::-1]
        dz = dx.transpose(1, 0, 2)[live] * (1 - flat * flat)
        grad["dense"] = dense.T @ dz
        np.add.at(grad["path"], slots, dz[owner] / 4)
        return grad


# A layout grammar for training pages. Element names, class names and stock phrases.
_SECTIONS = {
    "menu": (["nav", "div", "ul"], ["nav", "menu", "navbar", "breadcrumb", "main-menu", "navigation", "topbar", "toc", "links"], ""),
    "header": (["header", "div"], ["header", "masthead", "site-header", "page-header", "branding", "top", "logo"], "home login welcome search site daily news"),
    "footer": (["footer", "div"], ["footer", "site-footer", "bottom", "copyright", "colophon", "legal"], "© copyright all rights reserved privacy terms contact imprint ·"),
    "sidebar": (["aside", "div"], ["sidebar", "widget", "related", "recommended", "side", "more-stories", "trending", "popular", "rail"], "related popular more read also recent latest"),
    "notice": (["div", "section", "p", "dialog"], ["cookie", "notice", "consent", "gdpr", "alert", "banner", "popup", "modal", "overlay", "disclaimer", "message", "warning", "subscribe", "paywall"], "we use cookies accept agree privacy policy our site subscribe sign up newsletter"),
    "advert": (["div", "aside", "section", "ins"], ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "sponsor", "banner-ad", "adsense", "commercial", "promotion", "ad-slot"], "buy now offer sale sponsored advertisement"),
    "form": (["form", "form", "div"], ["form", "search", "login", "newsletter", "signup", "contact-form"], "name email password send submit search subscribe login"),
    "comments": (["div", "section", "ol", "ul"], ["comments", "comment-list", "discussion", "replies", "reader-comments", "respond", "feedback", "commentlist", "user-comments", "disqus"], "reply comment says wrote posted report"),
    "share": (["div", "ul"], ["share", "social", "tags", "pager", "pagination", "toolbar", "actions"], "share tweet like follow print next previous"),
}
_ARTICLE = ["content", "post", "entry", "article", "article-body", "story", "post-content", "entry-content", "main-content", "text", "body-text"]
_NEUTRAL = ["wrapper", "container", "row", "col", "page", "site", "inner", "box", "grid", "clearfix", "x1", "left", "wide"]
_SYLLABLES = "the an er on in re ing ti es or st sch ung keit der ein en ver ción que ar os la ment eau tion ou é ü ß ñ ka mo lu ri sa to".split()


class _Pages:
    """Random pages with the label of each block, in order."""

    def __init__(self, rng: np.random.Generator):
        self.rng = rng

    def pick(self, items):
        return items[int(self.rng.integers(len(items)))]

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def words(self, lo: int, hi: int, stock: str = "") -> str:
        out = ["".join(self.pick(_SYLLABLES) for _ in range(int(self.rng.integers(1, 4)))) for _ in range(int(self.rng.integers(lo, hi + 1)))]
        stock = stock.split()
        for k in range(len(out)):
            if stock and self.chance(0.3):
                out[k] = self.pick(stock)
        return " ".join(out).capitalize()

    def prose(self, lo: int = 1, hi: int = 6, stock: str = "") -> str:
        """Sentences; one text in six is lists, shouting, symbols or repeated words instead, so
        that the looks of a text alone don't decide."""
        if self.chance(0.17):
            w = self.words(1, 60, stock).split()
            kind = int(self.rng.integers(6))
            if kind == 0:
                return " | ".join(w) + self.pick(["", " |"])
            if kind == 1:
                return " ".join(x.upper() + "!!" for x in w)
            if kind == 2:
                return " ".join(x + self.pick(["###", "$$$", "***", "%%%", "&amp;&amp;"]) if self.chance(0.5) else x for x in w)
            if kind == 3:
                return " ".join(x for x in w[:8] for _ in range(int(self.rng.integers(3, 12))))
            if kind == 4:
                return " ".join(w)
            return f"{w[0]} +1 (323) 555-9830 {w[-1]}@mail.example.com https://x.example.org/{w[0]} " + " ".join(w)
        return " ".join(self.words(3, 22, stock) + "." for _ in range(int(self.rng.integers(lo, hi + 1))))

    def add(self, html: str, main: bool) -> None:
        self.html.append(html)
        self.truth.append(main)

    def open(self, tag: str, names: list[str] | None, p: float = 0.9) -> None:
        name = ""
        if names and self.chance(p):
            name = f' {self.pick(["class", "class", "id"])}="{self.pick(names)}{" " + self.pick(_NEUTRAL) if self.chance(0.2) else ""}"'
        self.html.append(f"<{tag}{name}>")

    def section(self, kind: str) -> None:
        tags, names, stock = _SECTIONS[kind]
        tag = self.pick(tags)
        telling = tag in ("nav", "header", "footer", "aside", "form") or kind == "menu"
        self.open(tag, names, 0.5 if telling else 1.0)
        if kind in ("menu", "share") or kind == "sidebar" and self.chance(0.6):
            if kind == "sidebar":
                self.add(f"<h3>{self.words(1, 4, stock)}</h3>", False)
            inner = tag != "ul" and self.chance(0.8)
            self.html.append("<ul>" if inner else "")
            for _ in range(int(self.rng.integers(2, 9))):
                el = "li" if inner or tag == "ul" else self.pick(["div", "p"])
                self.add(f'<{el}><a href="/{self.words(1, 1)}">{self.words(1, 4, stock if self.chance(0.3) else "")}</a>' + (f"</{el}>" if self.chance(0.9) else ""), False)
            self.html.append("</ul>" if inner else "")
        elif kind == "form":
            for _ in range(int(self.rng.integers(1, 5))):
                self.add(f"<{self.pick(['label', 'button', 'p', 'legend'])}>{self.words(1, 6, stock)}", False)
                self.html.append('</label></button></p><input type="text">')
        elif kind == "comments":
            if self.chance(0.7):
                self.add(f"<h3>{self.words(1, 3, stock)}</h3>", False)
            for _ in range(int(self.rng.integers(1, 7))):
                el = "li" if tag in ("ol", "ul") else self.pick(["div", "div", "article", "p", "p"])
                if el == "p":
                    self.add(f"<p>{self.prose(1, 4)}</p>", False)
                    continue
                self.open(el, ["comment", "reply", "comment-body"], 0.6)
                if self.chance(0.6):
                    self.add(f"<{self.pick(['h4', 'div', 'p'])}>{self.words(1, 4, stock)}", False)
                    self.html.append("</h4></div></p>" if el == "li" else "</h4></p>" if self.html[-1][1:3] != "di" else "</div>")
                self.add(f"<p>{self.prose(1, 4)}</p>", False)
                self.html.append(f"</{el}>")
        elif self.chance(0.3) and tag not in ("p", "ul", "ol"):
            self.add(self.prose(1, 2, stock) if self.chance(0.6) else self.words(2, 8, stock), False)
        else:
            for k in range(1 if tag == "p" else int(self.rng.integers(1, 4))):
                body = self.prose(1, 3, stock if self.chance(0.6) else "") if self.chance(0.6) else self.words(1, 7, stock)
                body = f'<a href="/x">{body}</a>' if self.chance(0.25) else body
                self.add(body if tag == "p" else f"<{self.pick(['p', 'p', 'div', 'h3', 'span' if not k else 'p'])}>{body}", False)
                self.html.append("</span></p></h3>" if self.html[-1][1:4] != "div" else "</div>")
        self.html.append(f"</{tag}>")

    def paragraph(self) -> None:
        kind = self.rng.random()
        if kind < 0.66:
            text = self.prose(1, 8) if self.chance(0.8) else self.words(1, 4) + self.pick([".", ".", ""])
            if self.chance(0.2):
                text = f"<b>{self.words(1, 3)}</b> {text}" if self.chance(0.7) else f"<b>{text}<br>"
            if self.chance(0.15):
                text += f' <a href="/y">{self.words(1, 4)}</a> ' + self.prose(1, 2)
            self.add(f"<p>{text}" + ("</p>" if self.chance(0.85) else ""), True)
        elif kind < 0.78:
            self.add(f"<{(h := self.pick(['h2', 'h3', 'h4']))}>{self.words(1, 9)}</{h}>", True)
        elif kind < 0.88:
            self.html.append("<ul>")
            for _ in range(int(self.rng.integers(1, 6))):
                self.add(f"<li>{self.words(2, 14)}{'.' if self.chance(0.5) else ''}</li>", True)
            self.html.append("</ul>")
        elif kind < 0.93:
            self.add(f"<blockquote>{self.prose(1, 3)}</blockquote>" if self.chance(0.5) else f"<blockquote><p>{self.prose(1, 3)}</p></blockquote>", True)
        elif kind < 0.96:
            self.add(f"<pre>{self.words(3, 20)}</pre>", True)
        else:
            self.html.append("<table>")
            for _ in range(int(self.rng.integers(1, 4))):
                self.html.append("<tr>")
                for _ in range(int(self.rng.integers(1, 4))):
                    self.add(f"<td>{self.words(1, 5)}</td>", True)
                self.html.append("</tr>")
            self.html.append("</table>")

    def page(self) -> tuple[str, list[bool]]:
        self.html, self.truth = ["<!DOCTYPE html><html><head><title>t</title></head><body>"], []
        wraps = int(self.rng.integers(0, 3))
        for _ in range(wraps):
            self.open("div", _NEUTRAL, 0.8)
        for kind in self.rng.permutation(["header", "menu", "notice", "advert", "menu", "form", "share"]):
            if self.chance(0.4 if kind != "menu" else 0.6):
                self.section(str(kind))
        if self.chance(0.25):
            self.section("sidebar")
        tag = self.pick(["article", "article", "main", "div", "div", "section"])
        outer = self.chance(0.25)
        if outer:
            self.open(self.pick(["main", "div"]), _ARTICLE + _NEUTRAL, 0.6)
        self.open(tag, _ARTICLE, 0.5 if tag in ("article", "main") else 1.0)
        if self.chance(0.85):
            self.add(f"<h1>{self.words(1, 12)}{'.' if self.chance(0.3) else ''}</h1>", True)
        # Most articles are short, some very long: the labeller must not count.
        for k in range(1 + min(150, int(self.rng.exponential(self.pick([6, 6, 6, 40]))))):
            self.paragraph()
            if k and self.chance(0.06):
                self.section(self.pick(["advert", "sidebar", "notice", "form", "share"]))
        if self.chance(0.15):
            self.section("comments")
        self.html.append(f"</{tag}>" + ("</div></main>" if outer else ""))
        for kind in self.rng.permutation(["comments", "sidebar", "advert", "form", "share", "notice", "menu"]):
            if self.chance(0.3):
                self.section(str(kind))
        if self.chance(0.8):
            self.section("footer")
        return "".join(self.html) + "</div>" * wraps + "</body></html>", self.truth


def training_pages(n: int, seed: int) -> list[tuple[list[Block], list[bool]]]:
    """Pages whose blocks, as parsed, agree in number with their labels (nearly all do)."""
    source = _Pages(np.random.default_rng(seed))
    out = []
    while len(out) < n:
        page, truth = source.page()
        found = blocks(page)
        if len(found) == len(truth):
            out.append((found, truth))
    return out


@functools.lru_cache(4)
def trained(pages: int = TRAIN_PAGES, epochs: int = 9, seed: int = 11, rate: float = 0.006) -> Labeller:
    data = training_pages(pages, seed)
    rng = np.random.default_rng(seed)
    model = Labeller(rng)
    m = {k: np.zeros_like(v) for k, v in model.w.items()}
    v = {k: np.zeros_like(x) for k, x in model.w.items()}
    t = 0
    for _ in range(epochs):
        order = sorted(range(len(data)), key=lambda k: (len(data[k][0]) // 8, rng.random()))
        groups = [order[k : k + 48] for k in range(0, len(order), 48)]
        for k in rng.permutation(len(groups)):
            batch = [data[j] for j in groups[k]]
            grad = model.step([b for b, _ in batch], [y for _, y in batch])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            t += 1
            lr = rate * (1 - (t - 1) / (epochs * len(groups)))
            for name, g in grad.items():
                g = g * min(1.0, 1 / (norm + 1e-9))
                m[name] = 0.9 * m[name] + 0.1 * g
                v[name] = 0.99 * v[name] + 0.01 * g * g
                model.w[name] = model.w[name] - lr * (m[name] / (1 - 0.9**t)) / (np.sqrt(v[name] / (1 - 0.99**t)) + 1e-6)
    return model


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), model: Labeller | None = None) -> DataFrame:
    """The columns in ``keep`` and text: the blocks labelled as main text, joined by newlines."""
    spark = pages.sparkSession
    ship_package(spark)
    held = spark.sparkContext.broadcast(model or trained())
    keep = tuple(c for c in keep if c != "text")
    source = pages.select(*keep, F.coalesce(F.col("html"), F.lit("")).alias("__t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            for part in textkit.slices(batch, "__t"):
                found = [blocks(x) for x in part.column("__t").to_pylist()]
                text = ["\n".join(b.text for b, y in zip(bs, ys, strict=True) if y) for bs, ys in zip(found, model.label(found), strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(text, pa.string())], [*keep, "text"])

    return source.mapInArrow(run, source.drop("__t").schema.add("text", "string"))
