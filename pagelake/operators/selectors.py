"""A subset of CSS compiled to column expressions over node arrays.

``css("main .card > a[href*='/offer/' i], h2 a")`` understands tag names and ``*``, classes, ids, attributes (there, equal,
``~=``, ``^=``, ``$=``, ``*=``, and ``i`` for any case), descendants, children and lists. What stands in a list is found in
document order. Ancestors are looked for among the nodes that are searched, so below a card only the card's own
elements count.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelake.functions.text import let

NAME = r"[A-Za-z_][\w-]*"
PART = re.compile(
    rf"""(?P<tag>\*|{NAME})
    |\.(?P<cls>{NAME})
    |\#(?P<id>{NAME})
    |\[\s*(?P<attr>{NAME}(?::{NAME})?)\s*(?:(?P<op>[~^$*]?=)\s*(?:"(?P<double>[^"]*)"|'(?P<single>[^']*)'|(?P<bare>[\w-]+))\s*(?P<case>[iI])?\s*)?\]""",
    re.VERBOSE,
)
GAP = re.compile(r"\s*>\s*|\s*,\s*|\s+")


@dataclass(frozen=True)
class Attribute:
    name: str
    op: str | None = None
    value: str = ""
    any_case: bool = False

    def test(self, node: Column) -> Column:
        found, value = node["attrs"][self.name], self.value
        if self.op is None:
            return found.isNotNull()
        if self.any_case:
            found, value = F.lower(found), value.lower()
        if self.op == "=":
            return found == value
        if value == "":
            # No text begins with, ends with or holds nothing.
            return F.lit(False)
        if self.op == "~=":
            return F.lit(False) if re.search(r"\s", value) else F.array_contains(F.split(found, r"[ \t\n\f\r]+"), value)
        return {"^=": found.startswith, "$=": found.endswith, "*=": found.contains}[self.op](value)


@dataclass(frozen=True)
class Compound:
    """What one element has to be."""

    tag: str | None = None
    ids: tuple[str, ...] = ()
    classes: tuple[str, ...] = ()
    attributes: tuple[Attribute, ...] = ()

    def test(self, node: Column) -> Column:
        tests = [node["tag"] == self.tag] if self.tag else []
        tests += [node["attrs"]["id"] == i for i in self.ids]
        tests += [node["cls"].contains(f" {c} ") for c in self.classes]
        tests += [a.test(node) for a in self.attributes]
        return F.coalesce(reduce(and_, tests, F.lit(True)), F.lit(False))


@dataclass(frozen=True)
class Chain:
    """Compounds from the outermost to the element that is meant; ``child[i]`` ties the i-th to its parent."""

    compounds: tuple[Compound, ...]
    child: tuple[bool, ...]

    def select(self, nodes: Column) -> Column:
        def step(outer: Column, i: int) -> Column:
            if i == len(self.compounds):
                return outer
            inner, tight = self.compounds[i], self.child[i]

            def below(o: Column, n: Column) -> Column:
                return o["pre"] == n["parent"] if tight else (o["pre"] < n["pre"]) & (n["pre"] <= o["last"])

            return let(
                F.transform(outer, lambda o: F.struct(o["pre"].alias("pre"), o["last"].alias("last"))),
                lambda spans: step(F.when(F.size(spans) == 0, F.slice(nodes, 1, 0)).otherwise(
                    F.filter(nodes, lambda n: inner.test(n) & F.exists(spans, lambda o: below(o, n)))), i + 1),
            )

        return step(F.filter(nodes, self.compounds[0].test), 1)


@dataclass(frozen=True)
class Css:
    """A parsed selector list."""

    text: str
    chains: tuple[Chain, ...]

    @property
    def plain(self) -> bool:
        """Whether an element can be judged by itself."""
        return all(len(c.compounds) == 1 for c in self.chains)

    def test(self, node: Column) -> Column:
        if not self.plain:
            raise ValueError(f"a selector without ancestors is needed here, not {self.text!r}")
        return reduce(or_, (c.compounds[0].test(node) for c in self.chains))

    def select(self, nodes: Column) -> Column:
        if self.plain:
            return F.filter(nodes, self.test)
        if len(self.chains) == 1:
            return self.chains[0].select(nodes)
        found = F.concat(*(c.select(nodes) for c in self.chains))
        return let(F.transform(found, lambda n: n["pre"]), lambda places: F.filter(nodes, lambda n: F.array_contains(places, n["pre"])))


def css(text: str) -> Css:
    """Parse a selector; what is outside the subset is a ``ValueError`` that names the place."""
    chains, at, source = [], 0, text.strip()
    compounds, child, tight = [], [], False
    while True:
        parts, start = [], at
        while m := PART.match(source, at):
            if m["tag"] and parts:
                break
            parts.append(m)
            at = m.end()
        if not parts:
            raise ValueError(f"cannot read the selector {text!r} from {source[start:start + 20]!r} on")
        compounds.append(Compound(
            tag=next((m["tag"].lower() for m in parts if m["tag"] and m["tag"] != "*"), None),
            ids=tuple(m["id"] for m in parts if m["id"]),
            classes=tuple(m["cls"] for m in parts if m["cls"]),
            attributes=tuple(
                Attribute(m["attr"].lower(), m["op"], next((v for v in (m["double"], m["single"], m["bare"]) if v is not None), ""), bool(m["case"]))
                for m in parts if m["attr"]),
        ))
        child.append(tight)
        gap = GAP.match(source, at)
        if gap is None or at == len(source):
            break
        at, kind = gap.end(), gap[0].strip()
        tight = kind == ">"
        if kind == ",":
            chains.append(Chain(tuple(compounds), tuple(child)))
            compounds, child = [], []
    if at != len(source):
        raise ValueError(f"cannot read the selector {text!r} from {source[at:at + 20]!r} on")
    return Css(text, (*chains, Chain(tuple(compounds), tuple(child))))


#: A node test, a parsed selector, or the text of one.
Pick = Callable[[Column], Column] | Css | str


def picked(pick: Pick) -> Callable[[Column], Column] | Css:
    return css(pick) if isinstance(pick, str) else pick


def test_of(pick: Pick) -> Callable[[Column], Column]:
    """A test of single nodes; a selector with ancestors is an error."""
    found = picked(pick)
    if isinstance(found, Css):
        if not found.plain:
            raise ValueError(f"a selector without ancestors is needed here, not {found.text!r}")
        return found.test
    return found
