"""Per-page helper of the Python stage: tokenise HTML and recover its element tree.

It runs inside Spark tasks on Arrow batches; see ``pagelake.operators.dom`` for the table operator.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Iterator
from html import unescape
from itertools import chain

import pyarrow as pa

# HTML facts: elements without content, and which start tags end an open element.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEAD_ONLY = frozenset("title meta link base style script noscript template".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small "
    "span strike strong sub sup time tt u var".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section summary table ul dt dd".split()
)
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}
HIDDEN = frozenset(("script", "style", "template"))
RAW_TEXT = {
    name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I)
    for name in ("script", "style", "title", "textarea")
}
# One first character for all, and runs of ordinary characters taken at once: both spare steps of the matcher, not matches.
TOKEN = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)"
    r"|/([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|=)*+)(?:>|\Z))",
    re.S,
)
TEMPLATE_END = re.compile(r"</template\s*>", re.I)
ATTRIBUTE = re.compile(r"([^\s=/>\"'][^\s=/>]*)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]*)))?")
# Start tags that may end an open element or need more than a new node.
UNUSUAL = frozenset((*IMPLIED_END, *RAW_TEXT, "html", "head", "body", "template"))


class _Tree:
    """Open-element stack and flat node lists of one page."""

    def __init__(self) -> None:
        self.last: list[int] = []
        self.parent: list[int] = []
        self.tag: list[str] = []
        self.attrs: list[dict[str, str]] = []
        self.s0: list[int] = []
        self.s1: list[int] = []
        self.texts: list[str] = []
        self.ld: list[str] = []
        self.stack: list[int] = []
        self.in_body = False

    def push(self, tag: str, attrs: dict[str, str]) -> None:
        index = len(self.tag)
        self.parent.append(self.stack[-1] if self.stack else -1)
        self.tag.append(tag)
        self.attrs.append(attrs)
        self.last.append(index)
        self.s0.append(len(self.texts))
        self.s1.append(len(self.texts))
        self.stack.append(index)

    def pop_to(self, depth: int) -> None:
        """Close every open element above ``depth``."""
        while len(self.stack) > depth:
            index = self.stack.pop()
            self.last[index] = len(self.tag) - 1
            self.s1[index] = len(self.texts)

    def close_implied(self, names: set[str] | frozenset[str], stop: set[str] | None) -> None:
        """Close the outermost open element in ``names`` above the nearest scope boundary."""
        found = None
        for depth in range(len(self.stack) - 1, -1, -1):
            tag = self.tag[self.stack[depth]]
            if tag in names:
                found = depth
                if stop is None:
                    break
            elif (tag in stop) if stop is not None else (tag not in INLINE):
                break
        if found is not None:
            self.pop_to(found)

    def require_body(self) -> None:
        if not self.in_body:
            self.pop_to(1)
            if not self.stack:
                self.push("html", {})
            self.push("body", {})
            self.in_body = True

    def open(self, tag: str, attrs: dict[str, str]) -> None:
        if tag == "html":
            if not self.tag:
                self.push(tag, attrs)
            return
        if tag == "body":
            if not self.in_body:
                self.require_body()
                self.attrs[-1] = attrs
            return
        if not self.in_body:
            if not self.stack:
                self.push("html", {})
            if tag == "head":
                if "head" not in self.tag:
                    self.push(tag, attrs)
                return
            if tag not in HEAD_ONLY:
                self.require_body()
            elif "head" not in self.tag:
                self.push("head", {})
        if tag in ENDS_PARAGRAPH:
            self.close_implied({"p"}, None)
        if tag in IMPLIED_END:
            self.close_implied(*IMPLIED_END[tag])
        self.push(tag, attrs)

    def close(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        for depth in range(len(self.stack) - 1, -1, -1):
            open_tag = self.tag[self.stack[depth]]
            if open_tag == tag:
                self.pop_to(depth)
                return
            if tag in INLINE and open_tag not in INLINE:
                return

    def text(self, raw: str) -> None:
        clean = " ".join((unescape(raw) if "&" in raw else raw).split())
        if clean:
            if not self.in_body and (not self.stack or self.tag[self.stack[-1]] in ("html", "head")):
                self.require_body()
            self.texts.append(clean)


def self_closing(raw: str) -> bool:
    """Whether a start tag ends in a slash of its own; a slash in an unquoted value belongs to the value."""
    return raw.endswith("/") and ATTRIBUTE.sub("", raw).rstrip().endswith("/")


def _attributes(raw: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(raw):
        value = double or single or bare
        found.setdefault(name.lower(), unescape(value) if "&" in value else value)
    return found


def build_tree(html: str) -> _Tree:
    """Tokenise one page and recover its tree."""
    tree, at, more = _Tree(), 0, True
    while more:
        at, more = _read(tree, html, at)
    tree.pop_to(0)
    return tree


def _read(tree: _Tree, html: str, at: int) -> tuple[int, bool]:
    """Read tokens from ``at`` to the end of the page, or to the end of an element of raw text.

    Usual tokens are dealt with here: text inside the body, start tags that end nothing, and end tags of the innermost
    element. The tree's methods, which say the same in general, do the others.
    """
    tags, stack, texts = tree.tag, tree.stack, tree.texts
    parent, last, attributes, s0, s1 = tree.parent, tree.last, tree.attrs, tree.s0, tree.s1
    for m in TOKEN.finditer(html, at):
        start, end = m.span()
        if start > at:
            if tree.in_body:
                raw = html[at:start]
                words = (unescape(raw) if "&" in raw else raw).split()
                if words:
                    texts.append(" ".join(words))
            else:
                tree.text(html[at:start])
        at = end
        closed, opened, raw = m.groups()
        if opened:
            tag = opened.lower()
            attrs = _attributes(raw) if raw else {}
            if tree.in_body and tag not in UNUSUAL and not (
                tag in ENDS_PARAGRAPH and stack and ((above := tags[stack[-1]]) == "p" or above in INLINE)
            ):
                index, n = len(tags), len(texts)
                parent.append(stack[-1] if stack else -1)
                tags.append(tag)
                attributes.append(attrs)
                last.append(index)
                s0.append(n)
                s1.append(n)
                if tag not in VOID and not self_closing(raw):
                    stack.append(index)
                continue
            tree.open(tag, attrs)
            if tag in RAW_TEXT:
                found = RAW_TEXT[tag].search(html, at)
                content = html[at : found.start() if found else len(html)]
                if tag not in HIDDEN:
                    tree.text(content)
                elif attrs.get("type", "") == "application/ld+json":
                    tree.ld.append(content)
                tree.close(tag)
                return (found.end() if found else len(html)), True
            if tag in VOID or self_closing(raw):
                if stack and tags[stack[-1]] == tag:
                    tree.pop_to(len(stack) - 1)
            elif tag == "template":
                found = TEMPLATE_END.search(html, at)
                tree.close(tag)
                return (found.end() if found else len(html)), True
        elif closed:
            tag = closed.lower()
            if stack and tags[stack[-1]] == tag and tag not in ("html", "body"):
                index = stack.pop()
                last[index] = len(tags) - 1
                s1[index] = len(texts)
            else:
                tree.close(tag)
    tree.text(html[at:])
    return len(html), False


def _offsets(sizes: list[int]) -> pa.Array:
    total, out = 0, [0]
    for size in sizes:
        total += size
        out.append(total)
    return pa.array(out, pa.int32())


def _dom_arrays(pages: list[str | None]) -> list[pa.Array]:
    """Texts, nodes and JSON-LD of some pages as three Arrow list arrays."""
    trees = [build_tree(html or "") for html in pages]
    nodes = [range(len(t.tag)) for t in trees]
    attrs = list(chain.from_iterable(t.attrs for t in trees))
    classes = [" ".join(a["class"].split()) if "class" in a else None for a in attrs]
    attr_map = pa.MapArray.from_arrays(
        _offsets([len(a) for a in attrs]),
        pa.array(list(chain.from_iterable(attrs)), pa.string()),
        pa.array(list(chain.from_iterable(a.values() for a in attrs)), pa.string()),
    )
    def ints(name: str) -> pa.Array:
        return pa.array(list(chain.from_iterable(getattr(t, name) for t in trees)), pa.int32())

    struct = pa.StructArray.from_arrays(
        [
            pa.array(list(chain.from_iterable(nodes)), pa.int32()),
            ints("last"),
            ints("parent"),
            pa.array(list(chain.from_iterable(t.tag for t in trees)), pa.string()),
            pa.array([None if c is None else f" {c} " for c in classes], pa.string()),
            attr_map,
            ints("s0"),
            ints("s1"),
        ],
        names=["pre", "last", "parent", "tag", "cls", "attrs", "s0", "s1"],
    )

    def strings(name: str) -> pa.Array:
        lists = [getattr(t, name) for t in trees]
        return pa.ListArray.from_arrays(
            _offsets([len(x) for x in lists]), pa.array(list(chain.from_iterable(lists)), pa.string())
        )

    return [
        strings("texts"),
        pa.ListArray.from_arrays(_offsets([len(r) for r in nodes]), struct),
        strings("ld"),
    ]


def parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 128):
            part = batch.slice(start, 128)
            *kept, html = part.columns
            names = part.schema.names[:-1] + ["texts", "nodes", "ld"]
            yield pa.RecordBatch.from_arrays(kept + _without_cycles(html.to_pylist()), names=names)


def _without_cycles(pages: list[str | None]) -> list[pa.Array]:
    """Trees hold no reference cycles, so looking for some in their many small objects would find nothing."""
    enabled = gc.isenabled()
    gc.disable()
    try:
        return _dom_arrays(pages)
    finally:
        if enabled:
            gc.enable()
