"""HTML into its leaf blocks: the text of each block-level element with the path of elements
and class words above it. Tolerates unclosed and cut-off markup. Time and memory grow with the
page alone, however deep its elements are nested: blocks share the levels above them, and an
element to be closed is found by its name, not by a search through all open ones."""

from __future__ import annotations

import functools
import html
import re
import zlib
from dataclasses import dataclass, field

_TAG = re.compile(
    r"<!--(?P<remark>.*?)(?:-->|\Z)|<[!?](?P<decl>[^>]*)(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?>[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.DOTALL,
)
_LABEL = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")
#: Elements whose content is never page text.
UNSEEN = {"script", "style", "noscript", "template", "svg", "title", "textarea", "iframe", "object"}
BLOCKS = {
    "html", "head", "body", "address", "article", "aside", "blockquote", "button", "caption", "center", "dd", "details", "dialog", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr",
    "label", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search", "section", "select", "summary",
    "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
#: What an opening element closes by itself, up to the nearest of the second set.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}


#: Hashed places for the names of a path.
PATH_SLOTS = 1024
SECTIONING = {"article", "main", "aside", "nav", "header", "footer", "form", "section", "dialog"}


@functools.lru_cache(20_000)
def slot(name: str) -> int:
    return zlib.crc32(name.encode()) % PATH_SLOTS


@dataclass(eq=False, slots=True)
class Level:
    """An open element: its tag, "t:tag" and "c:class word" names, the level above, the slots of
    all names from the root down (shared with the level above unless new), the nearest
    sectioning element."""

    tag: str
    names: tuple[str, ...]
    above: Level | None
    slots: frozenset[int]
    near: str


def _level(tag: str, names: tuple[str, ...], above: Level | None) -> Level:
    known = above.slots if above else frozenset()
    new = {slot(n) for n in names} - known
    return Level(tag, names, above, known | new if new else known, "t:" + tag if tag in SECTIONING else above.near if above else "")


@dataclass
class Block:
    text: str
    level: Level | None
    linked: int  # characters inside links
    size: int = field(init=False)

    def __post_init__(self):
        self.size = len(self.text)

    @property
    def leaf(self) -> str:
        return self.level.tag if self.level else ""

    @property
    def parent(self) -> str:
        return self.level.above.tag if self.level and self.level.above else ""

    @property
    def path(self) -> tuple[str, ...]:
        """All names from the root down."""
        found, at = [], self.level
        while at:
            found.append(at.names)
            at = at.above
        return tuple(n for names in reversed(found) for n in names)


def _names(attrs: str) -> tuple[str, ...]:
    found: list[str] = []
    for m in _LABEL.finditer(attrs):
        found += [w.lower() for w in _WORD.findall(m[1] or m[2] or m[3] or "")]
    return tuple(dict.fromkeys("c:" + w for w in found))


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, those without text left out. White space inside a block is
    one space; ``br`` counts as white space."""
    out: list[Block] = []
    stack: list[Level] = []
    open_at: dict[str, list[int]] = {}  # depths of the open elements of each name
    parts: list[str] = []
    linked = links = 0
    at = 0

    def end_block() -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                out.append(Block(text, stack[-1] if stack else None, min(linked, len(text))))
            parts.clear()
        linked = 0

    def add(s: str) -> None:
        nonlocal linked
        if s:
            parts.append(s)
            if links:
                linked += len(s)

    def deepest(names) -> int:
        return max((open_at[n][-1] for n in names if open_at.get(n)), default=-1)

    def close(depth: int) -> None:
        while len(stack) > depth:
            open_at[stack.pop().tag].pop()

    while m := _TAG.search(page, at):
        add(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if m["close"]:
            if name == "a":
                links = 0
            elif name in BLOCKS:
                end_block()
                if (k := deepest((name,))) >= 0:
                    close(k)
        elif name in UNSEEN:
            if not m["attrs"].endswith("/"):
                shut = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
                at = shut.end() if shut else len(page)
            if name != "svg":
                continue
        elif name == "a":
            links = 1
        elif name in ("br", "img", "input", "wbr"):
            add(" ")
        elif name in BLOCKS:
            end_block()
            links = 0
            shuts, until = IMPLIED.get(name, ({"p"} if name not in ("button", "label", "option", "select") else set(), {"article", "aside", "div", "td", "section"}))
            if (k := deepest(shuts)) > deepest(until):
                close(k)
            if name != "hr":
                open_at.setdefault(name, []).append(len(stack))
                stack.append(_level(name, ("t:" + name, *_names(m["attrs"])), stack[-1] if stack else None))
    tail = page[at:]
    add(tail)
    end_block()
    return out
