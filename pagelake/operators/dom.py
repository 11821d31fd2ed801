"""HTML to an ordered node array: the one Python stage, plus native look-ups on its result.

``parse_html`` adds three columns to a table of pages:

* ``texts``  every visible, whitespace-cleaned, non-empty string in document order;
* ``nodes``  every element in document order, with its index ``pre``, the index ``last`` of its last
  descendant, its ``parent``, ``tag``, space-padded ``cls``, ``attrs`` and its range ``s0..s1`` of texts;
* ``ld``     the raw text of JSON-LD scripts.

Everything after that is an expression over these arrays: descendants are a slice, ancestors are
nodes whose range covers the node, text is a slice of ``texts``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.functions.hashing import structural_fingerprint, structural_tokens
from pagelake.functions.text import filled, let
from pagelake.operators import html_tree
from pagelake.operators.selectors import Css, Pick, picked, test_of

# Ship the helper with the job, so that executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(html_tree)

NODE = (
    "struct<pre:int,last:int,parent:int,tag:string,cls:string,"
    "attrs:map<string,string>,s0:int,s1:int>"
)
DOM_COLUMNS = f"texts array<string>, nodes array<{NODE}>, ld array<string>"
DOM_NAMES = ("texts", "nodes", "ld")


def is_parsed(pages: DataFrame) -> bool:
    return "html" not in pages.columns and set(DOM_NAMES) <= set(pages.columns)


def own_columns(pages: DataFrame) -> list[str]:
    """Columns of pages, parsed or not, that are neither markup nor what it was parsed to."""
    return [c for c in pages.columns if c not in (DOM_NAMES if is_parsed(pages) else ("html",))]


def parse_html(pages: DataFrame, html: str = "html", keep: Sequence[str] | None = None) -> DataFrame:
    """Add ``texts``, ``nodes`` and ``ld`` to the kept columns; the HTML itself is dropped.

    Name the HTML column in ``keep`` to retain it. Pages that were parsed before and stored are taken as they are, so
    that several readers of the same pages share one parse.
    """
    if html == "html" and is_parsed(pages):
        return pages.select(*(own_columns(pages) if keep is None else keep), *DOM_NAMES)
    names = list(keep) if keep is not None else [c for c in pages.columns if c != html]
    source = pages.select(*names, F.col(html).alias("__html"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    return source.mapInArrow(html_tree.parse_batches, f"{kept}, {DOM_COLUMNS}" if kept else DOM_COLUMNS)


def with_structure(parsed: DataFrame) -> DataFrame:
    """Add ``structural_fingerprint`` to parsed pages, for readers of records that ask for the structure too."""
    return parsed.withColumn("structural_fingerprint", structural_fingerprint(structural_tokens(F.col("nodes"))))


# ---- look-ups ---------------------------------------------------------------

Match = Callable[[Column], Column]


def match(
    *tags: str,
    cls: str | Sequence[str] | None = None,
    has: str | None = None,
    equals: tuple[str, str] | None = None,
    contains: tuple[str, str] | None = None,
    icontains: tuple[str, str] | None = None,
) -> Match:
    """Selector for one element: tag names, class, attribute presence, value or part of a value."""

    def test(n: Column) -> Column:
        result = F.lit(True) if not tags else n["tag"].isin(*tags)
        if cls is not None:
            names = [cls] if isinstance(cls, str) else cls
            hit = F.lit(False)
            for name in names:
                hit = hit | n["cls"].contains(f" {name} ")
            result = result & hit
        if has is not None:
            result = result & n["attrs"][has].isNotNull()
        if equals is not None:
            result = result & (n["attrs"][equals[0]] == equals[1])
        if contains is not None:
            value = n["cls"] if contains[0] == "class" else n["attrs"][contains[0]]
            result = result & value.contains(contains[1])
        if icontains is not None:
            result = result & F.lower(n["attrs"][icontains[0]]).contains(icontains[1])
        return F.coalesce(result, F.lit(False))

    return test


def either(*tests: Match) -> Match:
    def test(n: Column) -> Column:
        result = tests[0](n)
        for t in tests[1:]:
            result = result | t(n)
        return result

    return test


def select(nodes: Column, pick: Pick) -> Column:
    found = picked(pick)
    return found.select(nodes) if isinstance(found, Css) else F.filter(nodes, found)


def first(nodes: Column, pick: Pick) -> Column:
    return F.get(select(nodes, pick), F.lit(0))


def select_within(nodes: Column, outer: Pick, inner: Match) -> Column:
    """Nodes matching ``inner`` below a node that ``outer`` picks (a descendant selector)."""
    return let(
        F.transform(
            select(nodes, outer), lambda o: F.struct(o["pre"].alias("pre"), o["last"].alias("last"))
        ),
        lambda outers: F.when(F.size(outers) == 0, F.slice(nodes, 1, 0)).otherwise(
            F.filter(
                nodes,
                lambda n: inner(n)
                & F.exists(outers, lambda o: (o["pre"] < n["pre"]) & (n["pre"] <= o["last"])),
            )
        ),
    )


def below(nodes: Column, node: Column) -> Column:
    """Descendants of ``node``; ``nodes`` must be the whole page."""
    return F.slice(nodes, node["pre"] + 2, node["last"] - node["pre"])


def spans(ranges: Column, points: Column) -> Column:
    """For each of ``ranges`` (structs of ``a`` and ``z``), which of the sorted ``points`` lie after ``a`` and up to ``z``.

    The result has ``start`` (how many come before) and ``n``, in the order of ``ranges``. Ranges may nest and repeat.
    Both ends and all points are sorted together once; how many points come before an end is then its place less the
    number of ends before it, so the work grows with the page and not with ranges times points.
    """
    def event(at: Column, kind: int, i: Column | int) -> Column:
        return F.struct(at.cast("int").alias("at"), F.lit(kind).alias("kind"), (F.lit(i) if isinstance(i, int) else i).alias("i"))

    # At one place a range that begins there comes after the points, and so does one that ends there.
    events = F.sort_array(F.concat(
        F.transform(points, lambda p: event(p, 0, 0)),
        F.transform(ranges, lambda r, i: event(r["a"], 1, i)),
        F.transform(ranges, lambda r, i: event(r["z"], 2, i)),
    ))
    ends = F.filter(F.transform(events, lambda e, k: F.struct(e["kind"].alias("kind"), e["i"].alias("i"), k.alias("k"))), lambda e: e["kind"] > 0)
    before = F.transform(ends, lambda e, r: F.struct(e["kind"].alias("kind"), e["i"].alias("i"), (e["k"] - r).alias("n")))

    def paired(counts: Column) -> Column:
        def of(kind: int) -> Column:
            own = F.filter(counts, lambda e: e["kind"] == kind)
            return F.sort_array(F.transform(own, lambda e: F.struct(e["i"].alias("i"), e["n"].alias("n"))))

        starts, stops = of(1), of(2)
        return F.zip_with(starts, stops, lambda s, t: F.struct(s["n"].alias("start"), (t["n"] - s["n"]).alias("n")))

    return let(before, paired)


def slice_of(found: Column, span: Column) -> Column:
    return F.slice(found, span["start"] + 1, span["n"])


def nearest(candidates: Column, node: Column) -> Column:
    """Innermost of ``candidates`` that properly contains ``node``."""
    return let(
        F.filter(candidates, lambda c: (c["pre"] < node["pre"]) & (node["pre"] <= c["last"])),
        lambda found: F.get(found, F.size(found) - 1),
    )


def strings_of(texts: Column, node: Column, start: Column | int = 0) -> Column:
    """Strings of a node; ``start`` is the page position of the first string in ``texts``."""

    def cut(n: Column) -> Column:
        return F.slice(texts, n["s0"] + 1 - start, n["s1"] - n["s0"])

    return let(node, cut)


def text_of(texts: Column, node: Column, start: Column | int = 0) -> Column:
    """One-line text of a node, NULL when it has none."""
    return filled(F.array_join(strings_of(texts, node, start), " "))


def multiline_text_of(texts: Column, node: Column, start: Column | int = 0) -> Column:
    return filled(F.array_join(strings_of(texts, node, start), "\n"))


def first_text(
    texts: Column, nodes: Column, selectors: Sequence[Pick], start: Column | int = 0
) -> Column:
    """Text of the first match of the first selector that yields any."""
    return F.coalesce(*[text_of(texts, first(nodes, s), start) for s in selectors])


def first_attr(nodes: Column, selectors: Sequence[Pick], name: str) -> Column:
    return F.coalesce(*[filled(first(nodes, s)["attrs"][name]) for s in selectors])


WHOLE_PAGE = (
    "named_struct('pre', -1, 'last', size(nodes) - 1, 's0', 0, 's1', size(texts), 'name', '')"
)


def root_of(*choices: tuple[str, Pick]) -> Column:
    """First existing root among named selectors, else the whole page."""
    def pick(name: str, wanted: Pick) -> Column:
        n = first(F.col("nodes"), wanted)
        return F.when(
            n.isNotNull(),
            F.struct(
                n["pre"].alias("pre"), n["last"].alias("last"), n["s0"].alias("s0"),
                n["s1"].alias("s1"), F.lit(name).alias("name"),
            ),
        )

    return F.coalesce(*[pick(name, wanted) for name, wanted in choices], F.expr(WHOLE_PAGE))


MAIN_OR_BODY = (("main", match("main")), ("body", match("body")))

__all__ = [
    "DOM_COLUMNS", "DOM_NAMES", "MAIN_OR_BODY", "Match", "Pick", "below", "either", "first", "first_attr", "first_text", "is_parsed", "match",
    "multiline_text_of", "nearest", "own_columns", "parse_html", "root_of", "select", "select_within", "slice_of", "spans", "strings_of",
    "test_of", "text_of", "with_structure",
]
