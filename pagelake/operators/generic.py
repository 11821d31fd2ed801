"""Any page: metadata, links, images, headings, paragraphs, lists, tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake import constants as K
from pagelake.functions.text import clean_text, let
from pagelake.functions.urls import resolve, split_base
from pagelake.operators import dom

HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")


def first_by_url(entries: Column) -> Column:
    """Entries with a URL, the first one per URL, in document order.

    ``map_from_entries`` is not usable here because the first occurrence has to win. Sorted by URL and place, an entry
    is the first of its URL if the one before has another, so a page of many links costs a sort.
    """
    def distinct(kept: Column) -> Column:
        placed = F.sort_array(F.transform(kept, lambda e, i: F.struct(e["url"].alias("url"), i.alias("i"))))
        return let(placed, lambda p: F.transform(
            F.sort_array(F.transform(
                F.filter(p, lambda e, k: (k == 0) | (F.get(p, k - 1)["url"] != e["url"])), lambda e: e["i"])),
            lambda i: F.get(kept, i)))

    return let(F.filter(entries, lambda e: e["url"].isNotNull()), distinct)


def meta_map(nodes: Column) -> Column:
    """Meta name (or property) to content; on a repeated name the last one wins."""
    entries = F.filter(
        F.transform(
            dom.select(nodes, dom.match("meta")),
            lambda n: F.struct(
                F.coalesce(
                    F.nullif(n["attrs"]["name"], F.lit("")), F.nullif(n["attrs"]["property"], F.lit(""))
                ).alias("key"),
                F.nullif(n["attrs"]["content"], F.lit("")).alias("value"),
            ),
        ),
        lambda e: e["key"].isNotNull() & e["value"].isNotNull(),
    )

    def last_wins(found: Column) -> Column:
        return let(
            F.transform(found, lambda e: e["key"]),
            lambda keys: F.map_from_entries(
                F.filter(
                    found,
                    lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"]),
                )
            ),
        )

    return let(entries, last_wins)


def json_ld(ld: Column) -> Column:
    """Valid JSON-LD blocks as canonical JSON text; broken ones are dropped."""
    return F.filter(
        F.transform(ld, lambda x: F.to_json(F.try_parse_json(x))), lambda x: x.isNotNull()
    )


def links(nodes: Column, texts: Column, base: Column) -> Column:
    """Links resolved against ``base`` (a ``split_base`` struct), the first one per URL."""

    def build(b: Column) -> Column:
        entries = F.transform(
            dom.select(nodes, dom.match("a", has="href")),
            lambda n: F.struct(
                dom.text_of(texts, n).alias("text"),
                resolve(b, n["attrs"]["href"]).alias("url"),
                clean_text(n["attrs"]["rel"]).alias("rel"),
            ),
        )
        return F.filter(entries, lambda e: ~e["url"].rlike("^(javascript:|mailto:)"))

    return first_by_url(let(base, build))


def image_url(node: Column, base: Column) -> Column:
    source = F.coalesce(
        F.nullif(node["attrs"]["src"], F.lit("")), F.nullif(node["attrs"]["data-src"], F.lit(""))
    )
    return resolve(base, source)


IMAGE = dom.either(dom.match("img", has="src"), dom.match("img", has="data-src"))


def images(nodes: Column, base: Column) -> Column:
    """Images resolved against ``base``, the first one per URL."""
    return first_by_url(
        let(
            base,
            lambda b: F.transform(
                dom.select(nodes, IMAGE),
                lambda n: F.struct(
                    image_url(n, b).alias("url"),
                    clean_text(n["attrs"]["alt"]).alias("alt"),
                    clean_text(n["attrs"]["title"]).alias("title"),
                ),
            ),
        )
    )


def texts_of(nodes: Column, texts: Column, test: dom.Match) -> Column:
    """Non-empty one-line texts of the matching nodes."""
    return F.filter(
        F.transform(dom.select(nodes, test), lambda n: dom.text_of(texts, n)),
        lambda t: t.isNotNull(),
    )


def headings(nodes: Column, texts: Column) -> Column:
    return F.filter(
        F.transform(
            dom.select(nodes, dom.match(*HEADINGS)),
            lambda n: F.struct(
                F.substring(n["tag"], 2, 1).cast("int").alias("level"),
                dom.text_of(texts, n).alias("text"),
            ),
        ),
        lambda h: h["text"].isNotNull(),
    )


def lists(nodes: Column, texts: Column) -> Column:
    """Item texts of each list, direct items only; lists without text are left out.

    Items sorted by their parent stand together, so each list takes a slice of them.
    """
    def of(items: Column, holders: Column) -> Column:
        places = dom.spans(
            F.transform(holders, lambda n: F.struct((n["pre"] - 1).alias("a"), n["pre"].alias("z"))),
            F.transform(items, lambda i: i["parent"]),
        )
        return F.filter(
            F.transform(places, lambda span: F.filter(
                F.transform(dom.slice_of(items, span), lambda i: dom.text_of(texts, i["node"])), lambda t: t.isNotNull())),
            lambda found: F.size(found) > 0,
        )

    items = F.sort_array(F.transform(
        dom.select(nodes, dom.match("li")),
        lambda n: F.struct(n["parent"].alias("parent"), n["pre"].alias("pre"), F.struct(n["s0"].alias("s0"), n["s1"].alias("s1")).alias("node")),
    ))
    return let(items, lambda i: let(dom.select(nodes, dom.match("ul", "ol")), lambda h: of(i, h)))


def tables(nodes: Column, texts: Column) -> Column:
    """Headers (the first row with a ``th``) and the other rows of each table; a nested table's rows count for all around it.

    Rows and cells stand in document order, so each table takes a slice of the rows and each row a slice of the
    cells; the texts of a row's cells are made once, however many tables hold the row.
    """
    def around(found: Column) -> Column:
        return F.transform(found, lambda n: F.struct(n["pre"].alias("a"), n["last"].alias("z")))

    def places(found: Column) -> Column:
        return F.transform(found, lambda n: n["pre"])

    def cells_of(rows: Column, cells: Column) -> Column:
        return F.transform(dom.spans(around(rows), places(cells)), lambda span: let(
            dom.slice_of(cells, span),
            lambda own: F.struct(
                F.exists(own, lambda c: c["tag"] == "th").alias("head"),
                F.transform(own, lambda c: F.coalesce(dom.text_of(texts, c), F.lit(""))).alias("cells"),
            )))

    def split(found: Column) -> Column:
        none = F.array().cast("array<string>")
        return let(F.array_position(F.transform(found, lambda r: r["head"]), True).cast("int"), lambda at: F.struct(
            F.coalesce(F.get(found, at - 1)["cells"], none).alias("headers"),
            F.transform(F.filter(found, lambda r, i: i + 1 != at), lambda r: r["cells"]).alias("rows"),
        ))

    def all_of(found: Column, trs: Column, cells: Column) -> Column:
        return let(cells_of(trs, cells), lambda rows: F.transform(
            dom.spans(around(found), places(trs)),
            lambda span: let(F.filter(dom.slice_of(rows, span), lambda r: F.size(r["cells"]) > 0), split)))

    return let(dom.select(nodes, dom.match("tr")), lambda trs: let(
        dom.select(nodes, dom.match("th", "td")), lambda cells: all_of(dom.select(nodes, dom.match("table")), trs, cells)))


def page_title(nodes: Column, texts: Column) -> Column:
    return dom.text_of(texts, dom.first(nodes, dom.match("title")))


def source_struct(url: Column, fetched_at: Column) -> Column:
    """Lineage carried by every record."""
    return F.struct(
        url.alias("source_url"),
        fetched_at.alias("fetched_at"),
        F.lit(K.PARSER_VERSION).alias("parser_version"),
        F.lit(K.SCHEMA_VERSION).alias("schema_version"),
    )


def generic_page(
    pages: DataFrame, keep_html: bool = False, root: Sequence[tuple[str, dom.Pick]] = dom.MAIN_OR_BODY
) -> DataFrame:
    """One record per page.  ``pages`` holds ``url``, ``html`` and optionally ``fetched_at``.

    What is extracted lies below the first of ``root`` that a page has, else anywhere on the page.
    """
    keep = [c for c in pages.columns if c != "html" or keep_html]
    parsed = dom.parse_html(pages, keep=keep)
    fetched = F.col("fetched_at") if "fetched_at" in pages.columns else F.lit(None).cast("timestamp")
    rooted = parsed.withColumns({"root": dom.root_of(*root), "base": split_base(F.col("url"))})
    inner, texts, url = dom.below(F.col("nodes"), F.col("root")), F.col("texts"), F.col("url")
    base = F.col("base")
    nodes = F.col("nodes")
    canonical = dom.first_attr(nodes, [dom.match("link", equals=("rel", "canonical"))], "href")

    def scoped(build) -> Column:
        return let(inner, build)

    record = rooted.select(
        *[c for c in keep if c not in ("fetched_at",)],
        page_title(nodes, texts).alias("title"),
        resolve(base, canonical).alias("canonical_url"),
        meta_map(nodes).alias("metadata"),
        scoped(lambda n: headings(n, texts)).alias("headings"),
        scoped(lambda n: texts_of(n, texts, dom.match("p"))).alias("paragraphs"),
        scoped(lambda n: lists(n, texts)).alias("lists"),
        scoped(lambda n: tables(n, texts)).alias("tables"),
        scoped(lambda n: links(n, texts, base)).alias("links"),
        scoped(lambda n: images(n, base)).alias("images"),
        json_ld(F.col("ld")).alias("json_ld"),
        dom.multiline_text_of(texts, F.col("root")).alias("text"),
        source_struct(url, fetched).alias("source"),
    )
    return record
