"""Catalog listing pages: cards, items and page diagnostics.

``catalog_pages`` keeps one row per page and holds the accepted cards in an array, so diagnostics
need no shuffle.  ``catalog_items`` explodes those cards into one typed record per item.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake import constants as K
from pagelake.functions import text as T
from pagelake.functions.dates import parse_ru_datetime
from pagelake.functions.hashing import content_fingerprint
from pagelake.functions.money import parse_money
from pagelake.functions.text import let
from pagelake.functions.urls import (
    page_number,
    path,
    project_id,
    query_pairs,
    resolve,
    split_base,
    username,
)
from pagelake.operators import dom
from pagelake.operators.generic import IMAGE, image_url, source_struct

LISTING_ROOTS = (
    ("#projects-list", dom.match(equals=("id", "projects-list"))),
    *dom.MAIN_OR_BODY,
)
DESCRIPTION = [
    dom.match(equals=("itemprop", "description")),
    dom.match(cls="b-layout__txt_padbot_20"),
    lambda n: dom.match(cls="b-post__txt")(n) & dom.match(cls="text-5")(n),
    dom.match(cls="project-description"),
    dom.match(contains=("class", "description")),
]
PRICE = [
    dom.match(contains=("class", "price")),
    dom.match(contains=("class", "budget")),
    dom.match(cls="b-post__price"),
    dom.match(equals=("itemprop", "price")),
]


@dataclass(frozen=True)
class Selectors:
    """Where the parts of pages are looked for; give others, as node tests or as CSS, for pages with other markup.

    Sequences are tried in order. Cards, blocks and links are judged one element at a time, so their selectors name
    no ancestors. What is None is looked for as usual.
    """

    description: Sequence[dom.Pick] = tuple(DESCRIPTION)
    price: Sequence[dom.Pick] = tuple(PRICE)
    title: Sequence[dom.Pick] = (
        dom.match("h1"), dom.match(equals=("itemprop", "name")), dom.match(cls="b-page__title"), dom.match(cls="project-title")
    )
    #: Roots of listing pages and of all other pages, by the name that diagnostics give them.
    listing_root: Sequence[tuple[str, dom.Pick]] | None = None
    page_root: Sequence[tuple[str, dom.Pick]] = dom.MAIN_OR_BODY
    card: dom.Pick | None = None
    next_link: dom.Pick | None = None
    image: dom.Pick | None = None
    breadcrumbs: dom.Pick | None = None
    people_card: dom.Pick | None = None
    name: Sequence[dom.Pick] | None = None
    avatar: Sequence[dom.Pick] | None = None
    about: Sequence[dom.Pick] | None = None
    skill_block: dom.Pick | None = None
    review_block: dom.Pick | None = None
    portfolio_block: dom.Pick | None = None
    verified: dom.Pick | None = None


SELECTORS = Selectors()
#: Fields of an item that are looked for among the elements of its card.
MARKUP_FIELDS = ("description", "budget", "customer", "image_url", "field_sources")
USER_LINK = dom.match("a", has="href")
EXPLICIT_NEXT = dom.either(
    lambda n: (n["tag"] == "a") & F.coalesce(
        F.concat(F.lit(" "), n["attrs"]["rel"], F.lit(" ")) == " next ", F.lit(False)
    ),
    dom.match("a", icontains=("aria-label", K.NEXT_LABEL)),
    dom.match("a", icontains=("title", K.NEXT_LABEL)),
)


def user_link(node: Column) -> Column:
    return USER_LINK(node) & F.coalesce(node["attrs"]["href"].rlike(K.USER_LINK), F.lit(False))


def is_project_card(node: Column) -> Column:
    return (
        (node["tag"] == "article")
        | dom.match(cls=K.PROJECT_CARD_CLASSES)(node)
        | F.coalesce(node["attrs"]["data-id"].startswith(K.PROJECT_CARD_DATA_ID), F.lit(False))
    )


def card_marks(nodes: Column, is_card: dom.Match = is_project_card) -> Column:
    """Nodes that end the search for a card: cards themselves, and main/body as the limit."""
    return F.transform(
        F.filter(nodes, lambda n: is_card(n) | n["tag"].isin("main", "body")),
        lambda n: F.struct(
            n["pre"].alias("pre"), n["last"].alias("last"), is_card(n).alias("card")
        ),
    )


def headings(nodes: Column) -> Column:
    return F.filter(nodes, lambda n: n["tag"].isin("h2", "h3"))


def find_card(nodes: Column, marks: Column, heads: Column, anchor: Column) -> Column:
    """Index of the card an anchor belongs to; ``marks`` and ``heads`` are found once per page.

    The innermost card, unless main/body comes first; else the parent of the innermost h2/h3; else
    the anchor's own parent.
    """

    def decide(mark: Column) -> Column:
        heading = dom.nearest(heads, anchor)
        holder = F.get(nodes, heading["parent"])
        usable = holder.isNotNull() & ~holder["tag"].isin("main", "body")
        own_parent = F.when(anchor["parent"] >= 0, anchor["parent"]).otherwise(anchor["pre"])
        return F.when(mark["card"], mark["pre"]).otherwise(
            let(usable, lambda ok: F.when(ok, heading["parent"]).otherwise(own_parent))
        )

    return let(dom.nearest(marks, anchor), decide)


def next_page_url(nodes: Column, base: Column, page: Column, next_link: dom.Pick = EXPLICIT_NEXT) -> Column:
    """Explicit next link, else the first link that carries the next page number."""
    explicit = F.nullif(dom.first(nodes, next_link)["attrs"]["href"], F.lit(""))
    wanted = (page + 1).cast("string")
    hrefs = F.transform(
        F.filter(
            nodes,
            # Only links that mention a page can qualify: resolve no others.
            lambda n: (n["tag"] == "a") & n["attrs"]["href"].contains("page"),
        ),
        lambda n: resolve(base, n["attrs"]["href"]),
    )

    def numbered(href: Column) -> Column:
        pages = F.filter(query_pairs(href), lambda p: (p["k"] == "page") & (p["v"] != ""))
        by_query = (F.size(pages) == 1) & (F.get(pages, F.lit(0))["v"] == wanted)
        by_path = T.find(path(href), r"/page-(\d+)/?$", 1) == wanted
        return F.coalesce(by_query, F.lit(False)) | F.coalesce(by_path, F.lit(False))

    by_number = F.get(F.filter(hrefs, numbered), F.lit(0))
    return F.coalesce(resolve(base, explicit), by_number)


def _ensure(pages: DataFrame) -> DataFrame:
    """Fill in the optional input columns ``page`` and ``fetched_at``."""
    if "page" not in pages.columns:
        pages = pages.withColumn("page", F.coalesce(page_number(F.col("url")), F.lit(1)))
    if "fetched_at" not in pages.columns:
        pages = pages.withColumn("fetched_at", F.lit(None).cast("timestamp"))
    return pages


def catalog_pages(
    pages: DataFrame, fingerprint: bool = True, selectors: Selectors = SELECTORS, structure: bool = False, markup: bool = True
) -> DataFrame:
    """One row per listing page: accepted ``cards``, next page and diagnostics; with ``structure`` its fingerprint.

    Input columns: ``url``, ``html`` and optionally ``page``, ``fetched_at`` and any keys, which are
    passed through; without ``fingerprint`` pages may come parsed (``dom.parse_html``).  Without ``markup`` the cards carry their text but not their elements, which is all
    that readers of identity, kind and labelled values need; ``catalog_items`` then has the fields found so.
    """
    prepared = _ensure(pages)
    if fingerprint:
        prepared = prepared.withColumn("page_fingerprint", content_fingerprint(F.col("html")))
    keys = dom.own_columns(prepared)
    parsed = dom.parse_html(prepared, keep=keys).withColumns(
        {"root": dom.root_of(*(selectors.listing_root or LISTING_ROOTS)), "base": split_base(F.col("url"))}
    )
    if structure:
        parsed, keys = dom.with_structure(parsed), [*keys, "structural_fingerprint"]
    nodes, texts, base = F.col("nodes"), F.col("texts"), F.col("base")

    anchors = F.filter(
        dom.below(nodes, F.col("root")),
        lambda n: (n["tag"] == "a") & F.coalesce(n["attrs"]["href"].rlike(K.PROJECT_PATH), F.lit(False)),
    )

    def candidate(anchor: Column, marks: Column, heads: Column) -> Column:
        return let(
            resolve(base, anchor["attrs"]["href"]),
            lambda href: F.struct(
                href.alias("url"),
                project_id(href).alias("id"),
                dom.text_of(texts, anchor).alias("title"),
                find_card(nodes, marks, heads, anchor).alias("card"),
            ),
        )

    candidates = let(
        card_marks(nodes, dom.test_of(selectors.card or is_project_card)),
        lambda marks: let(headings(nodes), lambda heads: F.transform(anchors, lambda a: candidate(a, marks, heads))),
    )

    def accepted(found: Column) -> Column:
        """Candidates with an id and a title, the first one per id."""
        usable = F.filter(found, lambda c: c["id"].isNotNull() & c["title"].isNotNull())
        return let(
            usable,
            lambda u: let(
                F.transform(u, lambda c: c["id"]),
                lambda ids: F.filter(u, lambda c, i: F.array_position(ids, c["id"]) == i + 1),
            ),
        )

    def described_card(c: Column) -> Column:
        return let(
            dom.multiline_text_of(texts, F.get(nodes, c["card"])),
            lambda text: F.struct(F.coalesce(text, F.lit("")).alias("card_text"), T.kind(text).alias("kind")),
        )

    def with_content(c: Column, i: Column) -> Column:
        # Nothing binds the nodes on the way: each binding would copy them.
        card, known = F.get(nodes, c["card"]), F.get("described", i)
        return F.struct(
            i.alias("pos"),
            c["id"].alias("id"),
            c["url"].alias("url"),
            c["title"].alias("title"),
            known["card_text"].alias("card_text"),
            known["kind"].alias("kind"),
            *([
                dom.below(nodes, card).alias("nodes"),
                F.slice(texts, card["s0"] + 1, card["s1"] - card["s0"]).alias("texts"),
                card["s0"].alias("s0"),
            ] if markup else []),
        )

    paged = parsed.select(
        *keys,
        next_page_url(nodes, base, F.col("page"), selectors.next_link or EXPLICIT_NEXT).alias("next_url"),
        F.lower(dom.multiline_text_of(texts, F.col("root"))).alias("root_text"),
        F.col("root.name").alias("root_selector"),
        let(
            candidates,
            lambda found: F.struct(
                F.size(found).alias("candidate_links_found"),
                F.size(F.array_distinct(F.transform(found, lambda c: c["card"]))).alias("cards_found"),
                accepted(found).alias("accepted"),
            ),
        ).alias("found"),
        "nodes", "texts",
    )
    # One step each, so that readers of counts do without the texts, and readers of texts without the nodes.
    counted = paged.select(
        *keys, "next_url", "root_text", "root_selector", "found.candidate_links_found", "found.cards_found",
        "found.accepted", F.size("found.accepted").alias("parsed_count"), "nodes", "texts",
    )
    told = counted.withColumn("described", F.transform("accepted", described_card))
    return _diagnose(told.select(
        *keys, "next_url", "root_text", "root_selector", "candidate_links_found", "cards_found", "parsed_count",
        F.transform("accepted", with_content).alias("cards"),
        F.size(F.filter("described", lambda d: d["kind"] == "unknown")).alias("unknown_kind_count"),
    ), T.contains_any(F.coalesce(F.col("root_text"), F.lit("")), K.CATALOG_END_MARKERS)).drop("root_text")


def _diagnose(found: DataFrame, end_text: Column) -> DataFrame:
    """Counts, warnings and confidence of a page whose ``cards`` are known."""
    empty = F.col("parsed_count") == 0
    ended = empty & F.col("next_url").isNull() & end_text
    return found.select(
        *[c for c in found.columns if c not in ("parsed_count", "unknown_kind_count")],
        F.col("next_url").isNotNull().alias("has_next"),
        "parsed_count",
        "unknown_kind_count",
        F.when(empty, F.array(F.lit("items"))).otherwise(F.array().cast("array<string>")).alias("missing_required"),
        F.when(ended, F.array(F.lit("catalog_end"))).otherwise(F.array().cast("array<string>")).alias("warnings"),
        F.create_map(F.lit("items"), F.lit("project_url_pattern")).alias("field_sources"),
        F.when(~empty, K.CONFIDENCE_ITEMS).when(ended, K.CONFIDENCE_END)
        .otherwise(K.CONFIDENCE_EMPTY).alias("confidence"),
    )


def described(
    texts: Column, nodes: Column, title: Column, stop: list[str], minimum: int, joiner,
    start: Column | int = 0, selectors: Selectors = SELECTORS,
) -> Column:
    """Description by selector, else the longest paragraph-like text, with its provenance."""

    def choose(value: Column) -> Column:
        chunks = F.filter(
            F.transform(dom.select(nodes, dom.match("p", "div")), lambda n: joiner(texts, n, start)),
            lambda t: t.isNotNull() & (t != title) & (F.length(t) >= minimum)
            & ~let(F.lower(t), lambda folded: T.contains_any(folded, stop)),
        )
        fallback = let(
            T.longest(chunks),
            lambda t: F.struct(
                t.alias("value"),
                F.when(t.isNull(), "missing").otherwise("text_fallback").alias("source"),
            ),
        )
        return F.when(
            value.isNotNull() & (value != title),
            F.struct(value.alias("value"), F.lit("css").alias("source")),
        ).otherwise(fallback)

    return let(dom.first_text(texts, nodes, selectors.description, start), choose)


def budget_text(
    texts: Column, nodes: Column, card_line: Column, start: Column | int = 0, selectors: Selectors = SELECTORS
) -> Column:
    """Budget snippet by selector, else by text pattern, with its provenance."""

    def choose(value: Column) -> Column:
        fallback = T.clean_text(F.coalesce(*[T.find(card_line, p) for p in K.BUDGET_FALLBACKS]))
        return F.when(
            value.isNotNull(), F.struct(value.alias("value"), F.lit("css").alias("source"))
        ).otherwise(
            let(
                fallback,
                lambda t: F.struct(
                    t.alias("value"),
                    F.when(t.isNull(), "missing").otherwise("text_fallback").alias("source"),
                ),
            )
        )

    return let(dom.first_text(texts, nodes, selectors.price, start), choose)


def person(texts: Column, node: Column, base: Column, start: Column | int = 0) -> Column:
    """User name, name and link behind a profile anchor; NULL without an anchor."""

    def build(n: Column) -> Column:
        return let(
            resolve(base, n["attrs"]["href"]),
            lambda link: F.when(
                n.isNotNull(),
                F.struct(
                    username(link).alias("username"),
                    dom.text_of(texts, n, start).alias("name"),
                    link.alias("url"),
                ),
            ),
        )

    return let(node, build)


def catalog_items(
    pages: DataFrame, timezone: str = K.DEFAULT_TIMEZONE, keep_pages: bool = False, selectors: Selectors = SELECTORS
) -> DataFrame:
    """One typed record per accepted card.

    ``pages`` is the output of ``catalog_pages``; its key columns (everything but the arrays and the
    diagnostics) stay on each item, with ``page_url`` naming the page.  With ``keep_pages`` a page
    without items stays as one row without an id, and ``has_next``/``next_url`` stay on every row, so
    that one table answers questions about both items and pages.

    Cards of pages read without markup give the same records less ``MARKUP_FIELDS``.
    """
    markup = "nodes" in pages.schema["cards"].dataType.elementType.names
    dropped = {
        "cards", "root_selector", "candidate_links_found", "cards_found", "parsed_count",
        "unknown_kind_count", "missing_required", "warnings", "field_sources", "confidence",
        "page_fingerprint", "next_url", "has_next", "url", "fetched_at",
    }
    if keep_pages:
        dropped -= {"next_url", "has_next"}
    keys = [c for c in pages.columns if c not in dropped]
    # A plain explode asks first whether there is anything to explode, which would compute all cards twice.
    exploded = pages.select(*keys, F.col("url").alias("page_url"), "fetched_at", F.explode_outer("cards").alias("c"))
    card = (
        (exploded if keep_pages else exploded.filter(F.col("c").isNotNull()))
        .select(
            *keys,
            "page_url",
            "fetched_at",
            F.col("c.pos").alias("pos"),
            F.col("c.id").alias("id"),
            F.col("c.title").alias("title"),
            F.col("c.url").alias("url"),
            F.col("c.kind").alias("kind"),
            F.col("c.card_text").alias("card_text"),
            *([F.col("c.texts").alias("texts"), F.col("c.nodes").alias("nodes"), F.col("c.s0").alias("s0")] if markup else []),
        )
    )
    card = card.withColumn("base", split_base(F.col("page_url")))
    nodes, texts, text, s0 = F.col("nodes"), F.col("texts"), F.col("card_text"), F.col("s0")
    staged = card.select(
        *keys, "page_url", "fetched_at", "pos", "id", "title", "url", "kind", "card_text",
        *([
            described(texts, nodes, F.col("title"), K.DESCRIPTION_STOP_WORDS, 20, dom.text_of, s0, selectors).alias("described"),
            budget_text(texts, nodes, F.replace(text, F.lit("\n"), F.lit(" ")), s0, selectors).alias("priced"),
            person(texts, dom.first(nodes, user_link), F.col("base"), s0).alias("customer"),
            let(dom.first(nodes, selectors.image or IMAGE), lambda n: image_url(n, F.col("base"))).alias("image_url"),
        ] if markup else []),
        T.published_text(text).alias("published_raw"),
    )
    return staged.select(
        *keys, "page_url", "pos", "id", "title", "url",
        *([F.col("described.value").alias("description"), parse_money(F.col("priced.value")).alias("budget")] if markup else []),
        "kind",
        T.status(text).alias("status"),
        F.lit(None).cast("string").alias("category"),
        F.lit(None).cast("string").alias("subcategory"),
        T.label(text, "location").alias("location"),
        parse_ru_datetime(F.col("published_raw"), F.col("fetched_at"), timezone).alias("published_at"),
        "published_raw",
        T.label_int(text, "responses").alias("responses_count"),
        T.label(text, "views").alias("views_raw"),
        *(["customer", "image_url"] if markup else []),
        source_struct(F.col("page_url"), F.col("fetched_at")).alias("source"),
        "card_text",
        *([F.create_map(
            F.lit("title"), F.lit("url_anchor"),
            F.lit("description"), F.col("described.source"),
            F.lit("budget"), F.col("priced.source"),
        ).alias("field_sources")] if markup else []),
    )
