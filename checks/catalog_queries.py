"""Extraction queries: pages are rendered from the tables, extracted, and checked against the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import render
from checks.render import BASE, table
from pagelake.functions import urls
from pagelake.functions.urls import split_base
from pagelake.operators import catalog, crawl, detail, dom, generic, incremental, people, profile, quality
from pagelake.operators.runs import first_per_key
from pagelake.plans import verbs
from pagelake.session import materialize

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


# ---- SQL building blocks: the same facts, straight from the tables -------------

MONTHS = "['января','февраля','марта','апреля','мая','июня','июля','августа','сентября','октября','ноября','декабря'][month(o_orderdate)::INT]"
DATE_TEXT = f"day(o_orderdate) || ' ' || {MONTHS} || ' ' || year(o_orderdate)"
GROUPED = "replace(format('{{:,}}', {}), ',', {})"
W = "CAST(floor(o_totalprice + 0.5) AS BIGINT)"
KIND = "CASE o_orderpriority[1] WHEN '5' THEN 'contest' WHEN '4' THEN 'vacancy' ELSE 'order' END"
STATUS = "CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'open' ELSE 'unknown' END"
AMOUNT_MIN = f"CASE WHEN o_orderkey % 4 < 3 THEN {W} END"
AMOUNT_MAX = f"CASE o_orderkey % 4 WHEN 1 THEN 2 * {W} WHEN 3 THEN NULL ELSE {W} END"
CURRENCY = "CASE o_orderkey % 4 WHEN 0 THEN 'RUB' WHEN 1 THEN 'RUB' WHEN 2 THEN 'USD' END"
MOSCOW = "strftime(timezone('UTC', timezone('Europe/Moscow', o_orderdate + INTERVAL '12:30' HOUR_MINUTE)), '%Y-%m-%d %H:%M:%S')".replace("INTERVAL '12:30' HOUR_MINUTE", "to_minutes(750)")
ITEMS = f"""WITH o AS (SELECT *, o_orderkey + 5500000 AS id, o_orderkey // 30 + 1 AS home FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
spots AS (SELECT *, home AS page, o_orderkey % 30 AS rank FROM o UNION ALL SELECT *, home + 1, o_orderkey % 30 + 30 FROM o WHERE o_orderkey % 97 = 0),
items AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY rank) - 1 AS pos, {KIND} AS kind, {STATUS} AS status,
  {AMOUNT_MIN} AS amount_min, {AMOUNT_MAX} AS amount_max, {CURRENCY} AS currency FROM spots) """


def stamp(value) -> Column:
    return F.date_format(value, "yyyy-MM-dd HH:mm:ss")


def listing(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.catalog_pages(render.catalog_html(spark, sf))


def items(spark: SparkSession, sf: str) -> DataFrame:
    # Items carry no fingerprint of their page.
    return catalog.catalog_items(catalog.catalog_pages(render.catalog_html(spark, sf), fingerprint=False))


@query("x15_catalog_items", ITEMS + f"""SELECT page, pos, id, 'Item & order ' || o_orderkey AS title, '{BASE}/projects/' || id || '/item.html' AS url,
  'Work of ' || c_name || ' with priority ' || o_orderpriority AS description, kind, status, CASE WHEN kind = 'vacancy' THEN n_name END AS location,
  o_orderkey % 50 AS responses, 'c-' || o_custkey AS customer, c_name || ' & Co' AS customer_name, {MOSCOW} AS published_at FROM items""")
def x15(spark, sf):
    return items(spark, sf).select(
        F.col("page").cast("long").alias("page"), F.col("pos").cast("long").alias("pos"), "id", "title", "url", "description", "kind", "status", "location",
        F.col("responses_count").cast("long").alias("responses"), F.col("customer.username").alias("customer"), F.col("customer.name").alias("customer_name"),
        stamp("published_at").alias("published_at"),
    )


@query("p1_budget_accessors", ITEMS + """SELECT page, id, amount_min::DOUBLE AS budget_min, amount_max::DOUBLE AS budget_max, currency, o_orderkey % 4 = 3 AS negotiable, 'c-' || o_custkey AS customer_username FROM items""")
def p1(spark, sf):
    return items(spark, sf).select(
        F.col("page").cast("long").alias("page"), "id", F.col("budget.amount_min").cast("double").alias("budget_min"), F.col("budget.amount_max").cast("double").alias("budget_max"),
        "budget.currency", "budget.negotiable", F.col("customer.username").alias("customer_username"),
    )


@query("c24_published_snippet", ITEMS + f"SELECT page, id, {DATE_TEXT} || ', 12:30' AS published_raw FROM items")
def c24(spark, sf):
    return items(spark, sf).select(F.col("page").cast("long").alias("page"), "id", "published_raw")


BUDGET_SQL = f"""CASE o_orderkey % 4 WHEN 0 THEN 'от ' || {GROUPED.format(W, "' '")} || ' ₽' WHEN 1 THEN {GROUPED.format(W, "' '")} || ' ₽ – ' || {GROUPED.format("2 * " + W, "' '")} || ' ₽'
  WHEN 2 THEN {GROUPED.format(W, "' '")} || ' $' ELSE 'по договоренности' END"""


@query("c25_budget_snippet", f"SELECT o_orderkey + 5500000 AS id, {BUDGET_SQL} AS raw, 'text_fallback' AS source FROM orders")
def c25(spark, sf):
    """Budget found by text pattern, on cards whose price has no class to select it by."""
    o = render.orders_with_people(spark, sf)
    ident = (F.col("o_orderkey") + render.ITEM_OFFSET).cast("string")
    html = F.concat(
        F.lit('<body><article><h2><a href="/projects/'), ident, F.lit('/">Title</a></h2><span>'),
        render.price_text(F.col("o_orderkey"), F.col("o_totalprice")), F.lit("</span><i>Срок</i></article></body>"),
    )
    page = o.select(F.lit(f"{BASE}/projects/").alias("url"), F.lit(1).alias("page"), render.fetched_at().alias("fetched_at"), html.alias("html"))
    found = catalog.catalog_items(catalog.catalog_pages(page, fingerprint=False))
    return found.select("id", "budget.raw", F.col("field_sources")["budget"].alias("source"))


@query("c26_labelled_values", ITEMS + "SELECT page, id, o_orderkey % 50 AS responses, CASE WHEN kind = 'vacancy' THEN n_name END AS location, NULL AS views FROM items")
def c26(spark, sf):
    # Labelled values are found in the text of a card.
    found = catalog.catalog_items(catalog.catalog_pages(render.catalog_html(spark, sf), fingerprint=False, markup=False))
    return found.select(
        F.col("page").cast("long").alias("page"), "id", F.col("responses_count").cast("long").alias("responses"), "location", F.col("views_raw").alias("views")
    )


@query("x13_description_fallback", "SELECT o_orderkey + 5500000 AS id, 'Longest text about order ' || o_orderkey AS description, 'text_fallback' AS source FROM orders")
def x13(spark, sf):
    o = table(spark, sf, "orders")
    key = F.col("o_orderkey").cast("string")
    html = F.concat(
        F.lit('<body><article><h2><a href="/projects/'), (F.col("o_orderkey") + render.ITEM_OFFSET).cast("string"),
        F.lit('/">T</a></h2><p>short</p><p>Откликнуться на это задание можно здесь, и это самый длинный текст</p><p>Longest text about order '), key,
        F.lit("</p><p>Text no. two of order </p></article></body>"),
    )
    page = o.select(F.lit(f"{BASE}/projects/").alias("url"), F.lit(1).alias("page"), render.fetched_at().alias("fetched_at"), html.alias("html"))
    found = catalog.catalog_items(catalog.catalog_pages(page, fingerprint=False))
    return found.select("id", "description", F.col("field_sources")["description"].alias("source"))


@query("x21_field_provenance", ITEMS + "SELECT page, id, 'url_anchor' AS title_source, 'css' AS description_source, 'css' AS budget_source FROM items")
def x21(spark, sf):
    return items(spark, sf).select(
        F.col("page").cast("long").alias("page"), "id", *[F.col("field_sources")[f].alias(f"{f}_source") for f in ("title", "description", "budget")]
    )


@query("x22_source_struct", ITEMS + f"SELECT id, CASE WHEN page = 1 THEN '{BASE}/projects/' ELSE '{BASE}/projects/page-' || page || '/' END AS source_url, '2026-07-25 12:00:00' AS fetched_at, '1' AS schema_version FROM items")
def x22(spark, sf):
    return items(spark, sf).select("id", "source.source_url", stamp("source.fetched_at").alias("fetched_at"), "source.schema_version")


PAGES_SQL = ITEMS + """, last AS (SELECT max(o_orderkey) // 30 + 1 AS n FROM orders), extra AS (SELECT n // 500 + 1 AS d, n FROM last),
pg AS (SELECT page, count(*) AS parsed, count(*) AS links, count(*) FILTER (WHERE kind = 'order') AS orders_kept, FALSE AS ended FROM items GROUP BY page
  UNION ALL SELECT n + 1 + unnest(range(1, d + 1)), 0, 1, 0, FALSE FROM extra UNION ALL SELECT n + 2 + d, 0, 0, 0, TRUE FROM extra) """


@query("a6_page_diagnostics", PAGES_SQL + """SELECT page, links AS candidate_links_found, links AS cards_found, parsed AS parsed_count, orders_kept AS filtered_count, 0 AS unknown_kind_count FROM pg""")
def a6(spark, sf):
    filtered = crawl.filter_cards(listing(spark, sf), ["order"])
    return filtered.select(*[F.col(c).cast("long").alias(c) for c in (
        "page", "candidate_links_found", "cards_found", "parsed_count", "filtered_count", "unknown_kind_count")])


@query("p16_confidence", PAGES_SQL + "SELECT page, CASE WHEN parsed > 0 THEN 1.0 WHEN ended THEN 0.8 ELSE 0.2 END::DOUBLE AS confidence FROM pg")
def p16(spark, sf):
    return listing(spark, sf).select(F.col("page").cast("long").alias("page"), "confidence")


@query("p15_catalog_end", PAGES_SQL + "SELECT page, ended FROM pg")
def p15(spark, sf):
    return listing(spark, sf).select(F.col("page").cast("long").alias("page"), F.array_contains("warnings", "catalog_end").alias("ended"))


@query("p12_page_status", PAGES_SQL + """SELECT page, CASE WHEN orders_kept > 0 THEN 'ok' WHEN parsed > 0 THEN 'filtered_empty' WHEN links > 0 THEN 'selector_drift' ELSE 'catalog_end' END AS status,
  CASE WHEN orders_kept > 0 THEN 'ok' WHEN links > 0 THEN 'selector_drift' ELSE 'catalog_end' END AS strict_status FROM pg""")
def p12(spark, sf):
    filtered = crawl.filter_cards(listing(spark, sf), ["order"])
    return filtered.select(F.col("page").cast("long").alias("page"), quality.page_status().alias("status"), quality.page_status(compat=True).alias("strict_status"))


@query("e6_warning_overlap", PAGES_SQL + "SELECT page, ended OR (parsed > 0 AND orders_kept = 0) AS explained FROM pg")
def e6(spark, sf):
    filtered = crawl.filter_cards(listing(spark, sf), ["order"])
    known = F.array(F.lit("catalog_end"), F.lit("filtered_empty"))
    return filtered.select(F.col("page").cast("long").alias("page"), F.arrays_overlap("warnings", known).alias("explained"))


@query("a7_all_unknown_drift", "SELECT o_orderstatus AS status, TRUE AS all_unknown FROM orders WHERE o_orderstatus = 'P' GROUP BY 1 UNION ALL SELECT o_orderstatus, FALSE FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")
def a7(spark, sf):
    """One page per order; pages of status P carry no kind word at all."""
    o = table(spark, sf, "orders")
    word = F.when(F.col("o_orderstatus") == "P", "Разное").otherwise("Заказ")
    html = F.concat(F.lit('<body><article><h2><a href="/projects/'), F.col("o_orderkey").cast("string"), F.lit('/">T</a></h2><p>'), word, F.lit("</p></article></body>"))
    page = o.select(F.lit(f"{BASE}/projects/").alias("url"), F.lit(1).alias("page"), "o_orderstatus", render.fetched_at().alias("fetched_at"), html.alias("html"))
    judged = crawl.filter_cards(catalog.catalog_pages(page, fingerprint=False), ["order"])
    return judged.groupBy(F.col("o_orderstatus").alias("status")).agg(F.bool_and("all_unknown").alias("all_unknown"))


@query("p13_required_fields", PAGES_SQL + "SELECT page, CASE WHEN parsed > 0 THEN '' ELSE 'id,title,url' END AS missing FROM pg")
def p13(spark, sf):
    head = F.get("cards", F.lit(0))
    missing = quality.missing_fields(id=head["id"], title=head["title"], url=head["url"])
    return listing(spark, sf).select(F.col("page").cast("long").alias("page"), F.array_join(missing, ",").alias("missing"))


@query("x14_next_page", PAGES_SQL + f"SELECT page, CASE WHEN NOT ended THEN '{BASE}/projects/page-' || (page + 1) || '/' END AS next_url FROM pg")
def x14(spark, sf):
    return listing(spark, sf).select(F.col("page").cast("long").alias("page"), "next_url")


@query("w8_next_by_number", "SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'https://m.example.org/list?page=' || (page_id + 1) WHEN 1 THEN 'https://m.example.org/list/page-' || (page_id + 1) || '/' END AS next_url FROM pages")
def w8(spark, sf):
    """No explicit next link: the first link in document order with the next number is taken."""
    p = table(spark, sf, "pages")
    nxt, far = (F.col("page_id") + 1).cast("string"), (F.col("page_id") + 10).cast("string")
    by_query = F.concat(F.lit('<a href="?page='), far, F.lit('">far</a><a href="/list?page='), nxt, F.lit('">n</a><a href="/other?page='), nxt, F.lit('">o</a>'))
    by_path = F.concat(F.lit('<a href="/list/page-'), nxt, F.lit('0/">far</a><a href="/list/page-'), nxt, F.lit('/">n</a>'))
    html = F.concat("html", F.when(F.col("page_id") % 3 == 0, by_query).when(F.col("page_id") % 3 == 1, by_path).otherwise(""))
    parsed = dom.parse_html(p.select("page_id", html.alias("html")))
    found = catalog.next_page_url(F.col("nodes"), split_base(F.lit("https://m.example.org/list")), F.col("page_id"))
    return parsed.select("page_id", found.alias("next_url"))


@query("x12_card_finder", ITEMS + "SELECT page, count(*) AS cards, count(DISTINCT id) AS titles FROM items GROUP BY page")
def x12(spark, sf):
    """Every card holds its own title and no other one."""
    own = F.col("card_text").startswith(F.col("title")) & (F.locate("Item &", "card_text", 2) == 0)
    found = items(spark, sf).withColumn("own_id", F.when(own, F.col("id")))
    return found.groupBy(F.col("page").cast("long").alias("page")).agg(
        F.count("*").alias("cards"), F.count_distinct("own_id").alias("titles")
    )


@query("p3_type_filter", ITEMS + "SELECT page, id, kind FROM items WHERE kind IN ('vacancy','contest')")
def p3(spark, sf):
    chosen = crawl.item_filter(types=["вакансия", "3"])
    return items(spark, sf).filter(chosen.kind_condition()).select(F.col("page").cast("long").alias("page"), "id", "kind")


@query("p5_default_orders", ITEMS + "SELECT page, id, kind FROM items WHERE kind = 'order'")
def p5(spark, sf):
    return items(spark, sf).filter(crawl.item_filter().condition()).select(F.col("page").cast("long").alias("page"), "id", "kind")


@query("p6_search_filter", ITEMS + "SELECT page, id FROM items WHERE contains(c_name, '7') AND amount_max >= 50000 AND amount_min <= 200000")
def p6(spark, sf):
    chosen = crawl.item_filter(types=[], min_budget=50_000, max_budget=200_000, with_budget=True)
    kept = items(spark, sf).filter(chosen.condition() & F.col("customer.name").contains("7"))
    return kept.select(F.col("page").cast("long").alias("page"), "id")


@query("p6_query_filter", ITEMS + "SELECT page, id FROM items WHERE o_orderpriority = '1-URGENT' AND amount_min IS NULL")
def p6b(spark, sf):
    kept = items(spark, sf).filter(crawl.item_filter(types="orders", query="Priority 1-URGENT", with_budget=False).condition())
    return kept.select(F.col("page").cast("long").alias("page"), "id")


@query("w1_dedupe_items", ITEMS + "SELECT id, min(page) AS page, arg_min(pos, page) AS pos FROM items GROUP BY id")
def w1(spark, sf):
    # The first row of an id is kept whole, so fields nobody reads are left out before, not after.
    first = crawl.dedupe_items(items(spark, sf).select("id", "page", "pos"))
    return first.select("id", F.col("page").cast("long").alias("page"), F.col("pos").cast("long").alias("pos"))


@query("w4_traversal_cut", PAGES_SQL + "SELECT page, parsed FROM pg WHERE page >= 3 AND page < 3 + 20 AND page <= (SELECT min(page) FROM pg WHERE ended)")
def w4(spark, sf):
    cut = crawl.traversal_cut(listing(spark, sf), max_pages=20, start_page=3)
    return cut.select(F.col("page").cast("long").alias("page"), F.col("parsed_count").cast("long").alias("parsed"))


@query("w4_cut_on_failure", """WITH p AS (SELECT p_brand, p_partkey, p_partkey % 97 = 96 AS failed, p_partkey % 301 = 300 AS final FROM part),
s AS (SELECT p_brand, min(p_partkey) FILTER (WHERE final AND NOT failed) AS e1, (min((p_partkey - 1) // 5) FILTER (WHERE failed) + 1) * 5 AS e2 FROM p WHERE p_partkey >= 1 GROUP BY 1)
SELECT p.p_brand, p_partkey AS page FROM p JOIN s USING (p_brand) WHERE p_partkey >= 1 AND NOT failed AND p_partkey <= least(coalesce(e1, 1000000000), coalesce(e2, 1000000000))""")
def w4b(spark, sf):
    """Each brand is one crawl over the part keys as page numbers; some pages failed, some are the last."""
    p = table(spark, sf, "part").select("p_brand", F.col("p_partkey").alias("page"), (F.col("p_partkey") % 301 != 300).alias("has_next"), (F.col("p_partkey") % 97 == 96).alias("bad"))
    return crawl.traversal_cut(p, crawl_key="p_brand", failed=F.col("bad"), batch_size=5).select("p_brand", "page")


@query("l1_page_order", PAGES_SQL + "SELECT page, parsed FROM pg ORDER BY page")
def l1(spark, sf):
    # A sort reads its input twice, to find the ranges and to deal by them; the pages are parsed once.
    counts = listing(spark, sf).select(F.col("page").cast("long").alias("page"), F.col("parsed_count").cast("long").alias("parsed"))
    return materialize(counts).orderBy("page")


@query("l2_page_limit", ITEMS + "SELECT id, page FROM items WHERE page BETWEEN 2 AND 6")
def l2(spark, sf):
    start, limit = crawl.start_of(2), crawl.page_limit(5)
    # As in the verbs, start and limit are applied before any page is parsed.
    chosen = verbs.chosen_pages(render.catalog_html(spark, sf), limit, start, None)
    cut = crawl.traversal_cut(catalog.catalog_pages(chosen, fingerprint=False, markup=False), max_pages=limit, start_page=start)
    return catalog.catalog_items(cut).select("id", F.col("page").cast("long").alias("page"))


@query("a10_surface_report", PAGES_SQL + """SELECT 'catalog' AS surface, count(*) AS pages, count(*) FILTER (WHERE parsed > 0) AS passed, count(*) FILTER (WHERE parsed = 0 AND NOT ended) AS drifted,
  min(CASE WHEN parsed > 0 THEN 1.0 WHEN ended THEN 0.8 ELSE 0.2 END)::DOUBLE AS min_confidence, bool_and(parsed > 0) AS ok FROM pg""")
def a10(spark, sf):
    checked = crawl.filter_cards(listing(spark, sf))
    head = F.get("cards", F.lit(0))
    rows = checked.select(
        F.lit("catalog").alias("surface"), "url", quality.page_status().alias("status"), "confidence",
        quality.missing_fields(id=head["id"], title=head["title"], url=head["url"]).alias("missing"),
    )
    return quality.surface_report(quality.health_checks(rows))


@query("a10_all_surfaces", """WITH p AS (SELECT DISTINCT s_suppkey // 30 + 1 AS page FROM supplier), o AS (SELECT (o_orderkey + 5500000) % 101 <> 0 AS good FROM orders)
SELECT 'people' AS surface, count(*) + 1 AS pages, count(*) AS passed, false AS ok FROM p
UNION ALL SELECT 'detail', count(*), count(*), true FROM o WHERE good
UNION ALL SELECT 'profile', 3 * count(*), 3 * count(*), true FROM customer""")
def a10_all(spark, sf):
    """Reports for people, details and profiles; pages that lack what a record needs fail."""
    report, _ = verbs.health({
        "people": render.people_html(spark, sf), "detail": render.detail_html(spark, sf), "profile": render.profile_html(spark, sf),
    }, site="Market.example")
    return report.select("surface", "pages", "passed", "ok")


# ---- details ------------------------------------------------------------------

DETAIL = "WITH d AS (SELECT *, o_orderkey + 5500000 AS id FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE (o_orderkey + 5500000) % 101 <> 0) "


def details(spark: SparkSession, sf: str) -> DataFrame:
    return detail.detail_pages(render.detail_html(spark, sf))


@query("x16_detail_pages", DETAIL + f"""SELECT id, CASE o_orderkey % 10 WHEN 0 THEN 'Named ' || o_orderkey WHEN 1 THEN 'Item & order' ELSE 'Item ' || o_orderkey END AS title,
  CASE o_orderkey % 10 WHEN 0 THEN 'json_ld' WHEN 1 THEN 'open_graph' ELSE 'css' END AS title_source, 'Details of order ' || o_orderkey || ' for ' || c_name AS description,
  {AMOUNT_MIN}::DOUBLE AS amount_min, 'Status ' || o_orderstatus AS category, 'Priority ' || o_orderpriority AS subcategory, 'c-' || o_custkey AS customer,
  CASE WHEN o_orderkey % 3 = 0 THEN 's-' || (o_orderkey % 100) END AS executor, CASE WHEN o_orderkey % 2 = 0 THEN '{BASE}/files/' || o_orderkey || '.pdf' END AS attachment,
  o_orderkey % 50 AS responses, {MOSCOW} AS published_at FROM d""")
def x16(spark, sf):
    return details(spark, sf).select(
        "id", "title", F.col("field_sources")["title"].alias("title_source"), "description", F.col("budget.amount_min").cast("double").alias("amount_min"),
        "category", "subcategory", F.col("customer.username").alias("customer"), F.col("executor.username").alias("executor"),
        F.get("attachments", F.lit(0))["url"].alias("attachment"), F.col("responses_count").cast("long").alias("responses"), stamp("published_at").alias("published_at"),
    )


@query("l3_breadcrumbs", DETAIL + "SELECT id, 'All|Status ' || o_orderstatus || '|Priority ' || o_orderpriority AS crumbs FROM d")
def l3(spark, sf):
    return details(spark, sf).select("id", F.array_join("breadcrumbs", "|").alias("crumbs"))


@query("j3_items_with_details", ITEMS + """SELECT id, CASE WHEN id % 101 <> 0 THEN 'Status ' || o_orderstatus END AS category, CASE WHEN id % 101 = 0 THEN 'missing_page' END AS error_kind FROM items WHERE page = o_orderkey // 30 + 1""")
def j3(spark, sf):
    joined = detail.with_details(crawl.dedupe_items(items(spark, sf).select("id", "title", "page", "pos")).select("id", "title"), details(spark, sf))
    return joined.select("id", "detail.category", F.col("error.kind").alias("error_kind"))


@query("a8_longest_text", "SELECT p_partkey, CASE WHEN length(p_name) >= length(p_type) AND length(p_name) >= length(p_brand) THEN p_name WHEN length(p_type) >= length(p_brand) THEN p_type ELSE p_brand END AS longest FROM part")
def a8(spark, sf):
    from pagelake.functions.text import longest

    return table(spark, sf, "part").select("p_partkey", longest(F.array("p_name", "p_type", "p_brand")).alias("longest"))


# ---- people and profiles --------------------------------------------------------

PEOPLE = """WITH s AS (SELECT *, s_suppkey // 30 + 1 AS home, (SELECT max(s_suppkey) // 30 + 1 FROM supplier) AS last FROM supplier JOIN nation ON s_nationkey = n_nationkey),
p AS (SELECT *, home AS page FROM s UNION ALL SELECT *, home + 1 FROM s WHERE s_suppkey % 7 = 0 AND home < last) """


def people_listing(spark, sf):
    return people.people_pages(render.people_html(spark, sf))


@query("x20_people_items", PEOPLE + f"""SELECT page, 's-' || s_suppkey AS username, s_name AS name, CASE WHEN s_suppkey % 3 > 0 THEN n_name END AS location, abs(s_acctbal)::DOUBLE AS rating,
  'Программирование: Spark' AS specialization, (s_suppkey % 20) || ' лет' AS experience_raw, s_suppkey % 90 AS portfolio_count, s_suppkey % 40 AS reviews_count,
  CASE WHEN s_suppkey % 2 = 0 THEN '{BASE}/a/' || s_suppkey || '.jpg' END AS avatar_url, '{BASE}/users/s-' || s_suppkey || '/portfolio/p-' || s_suppkey || '/' AS work FROM p""")
def x20(spark, sf):
    return people.people_items(people_listing(spark, sf)).select(
        F.col("page").cast("long").alias("page"), "username", "name", "location", F.col("rating").cast("double").alias("rating"), "specialization", "experience_raw",
        F.col("portfolio_count").cast("long").alias("portfolio_count"), F.col("reviews_count").cast("long").alias("reviews_count"), "avatar_url",
        F.get("portfolio_links", F.lit(0))["url"].alias("work"),
    )


@query("x20_people_pages", PEOPLE + f"""SELECT page, count(*) AS parsed, count(*) AS links, TRUE AS has_next, FALSE AS ended FROM p GROUP BY page
UNION ALL SELECT max(last) + 1, 0, 0, FALSE, TRUE FROM s""")
def x20b(spark, sf):
    return people_listing(spark, sf).select(
        F.col("page").cast("long").alias("page"), F.col("parsed_count").cast("long").alias("parsed"), F.col("candidate_links_found").cast("long").alias("links"),
        "has_next", F.array_contains("warnings", "catalog_end").alias("ended"),
    )


@query("w2_dedupe_people", "SELECT 's-' || s_suppkey AS username, s_suppkey // 30 + 1 AS page FROM supplier")
def w2(spark, sf):
    return crawl.dedupe_people(people.people_items(people_listing(spark, sf))).select("username", F.col("page").cast("long").alias("page"))


def profiles(spark, sf):
    return profile.profile_pages(render.profile_html(spark, sf), "Market.example")


PROFILE_PAGES = "customer, (SELECT unnest([1, 2, 3]) AS page)"


@query("x17_profile_pages", f"""SELECT 'c-' || c_custkey AS username, page, c_custkey AS user_id, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN 'customer' ELSE 'freelancer' END AS role, n_name AS location,
  abs(c_acctbal)::DOUBLE AS rating, c_custkey % 30 AS reviews_positive, c_custkey % 7 AS reviews_negative, c_custkey % 9 AS safe_deals, c_custkey % 6 = 0 AS verified,
  (c_custkey % 20) || ' лет' AS registered_raw, '2 часа назад' AS last_seen_raw, 'About ' || c_mktsegment AS about, c_mktsegment || '|Spark' AS skills, '{BASE}/a/' || c_custkey || '.jpg' AS avatar_url
  FROM {PROFILE_PAGES} JOIN nation ON c_nationkey = n_nationkey""")
def x17(spark, sf):
    return profiles(spark, sf).select(
        "username", F.col("page").cast("long").alias("page"), "user_id", "name", "role", "location", F.col("rating").cast("double").alias("rating"),
        *[F.col(c).cast("long").alias(c) for c in ("reviews_positive", "reviews_negative", "safe_deals")], "verified", "registered_raw", "last_seen_raw", "about",
        F.array_join("skills", "|").alias("skills"), "avatar_url",
    )


@query("a14_tab_counts", f"SELECT 'c-' || c_custkey AS username, page, c_custkey % 11 AS projects_count, c_custkey % 3 AS vacancies_count, 0 AS contests_count FROM {PROFILE_PAGES}")
def a14(spark, sf):
    return profiles(spark, sf).select("username", *[F.col(c).cast("long").alias(c) for c in ("page", "projects_count", "vacancies_count", "contests_count")])


@query("e4_ordered_distinct_skills", f"SELECT 'c-' || c_custkey AS username, page, c_mktsegment || '|Spark' AS skills FROM {PROFILE_PAGES}")
def e4(spark, sf):
    return profiles(spark, sf).select("username", F.col("page").cast("long").alias("page"), F.array_join("skills", "|").alias("skills"))


SECTIONS = "WITH x AS (SELECT *, o_orderkey % 3 + 1 AS page FROM orders), y AS (SELECT * FROM x UNION ALL SELECT * REPLACE (page + 1 AS page) FROM x WHERE o_orderkey % 5 = 0 AND page < 3) "


MOOD = "CASE o_orderkey % 4 WHEN 0 THEN 'Положительный отзыв' WHEN 1 THEN 'Отрицательный отзыв' ELSE 'Просто отзыв' END"


@query("x18_reviews", SECTIONS + f"""SELECT 'c-' || o_custkey AS username, page, 's-' || (o_orderkey % 100) AS author, 'Author' AS author_name,
  CASE o_orderkey % 4 WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' END AS sentiment, 'Author/' || {MOOD} || ' о заказе ' || o_orderkey AS text FROM y""")
def x18(spark, sf):
    rows = profiles(spark, sf).select("username", F.col("page").cast("long").alias("page"), F.explode_outer("reviews").alias("r")).filter("r IS NOT NULL")
    return rows.select("username", "page", F.col("r.author.username").alias("author"), F.col("r.author.name").alias("author_name"), "r.sentiment",
                       F.replace("r.text", F.lit("\n"), F.lit("/")).alias("text"))


@query("x19_portfolio", SECTIONS + f"""SELECT 'c-' || o_custkey AS username, page, 'Work ' || o_orderkey AS title, '{BASE}/users/c-' || o_custkey || '/portfolio/item-' || o_orderkey || '/' AS url,
  '{BASE}/i/' || o_orderkey || '.jpg' AS image_url, (o_orderkey || {W})::DOUBLE AS price_min, (o_orderkey || {W})::DOUBLE AS price_max, 'RUB' AS currency FROM y""")
def x19(spark, sf):
    """The number of the work and the price after it are one number, as groups of digits next to each other are."""
    rows = profiles(spark, sf).select("username", F.col("page").cast("long").alias("page"), F.explode_outer("portfolio").alias("w")).filter("w IS NOT NULL")
    return rows.select("username", "page", "w.title", "w.url", "w.image_url", F.col("w.price.amount_min").cast("double").alias("price_min"),
                       F.col("w.price.amount_max").cast("double").alias("price_max"), "w.price.currency")


@query("e3_distinct_section_rows", SECTIONS + "SELECT 'c-' || o_custkey AS username, min(page) AS page, 'Work ' || o_orderkey AS title FROM y GROUP BY o_custkey, o_orderkey")
def e3(spark, sf):
    rows = profile.section_rows(profiles(spark, sf).select("username", "page", "portfolio"), "portfolio")
    return rows.select("username", F.col("page").cast("long").alias("page"), "title")


@query("e5_section_union", SECTIONS + """SELECT 'c-' || o_custkey AS username, section, count(DISTINCT o_orderkey) AS n, min(page) AS first_page
FROM y, (SELECT unnest(['projects', 'reviews', 'portfolio']) AS section) GROUP BY ALL""")
def e5(spark, sf):
    """The three sections of every user over all pages, each entry once."""
    # The three verbs read the same pages: these are parsed once, and stored as parsed.
    html = materialize(dom.parse_html(render.profile_html(spark, sf)))
    found = {
        "projects": verbs.user_projects(html, fields=["page"]).ok, "reviews": verbs.user_reviews(html, "Market.example").ok,
        "portfolio": verbs.user_portfolio(html, "Market.example").ok,
    }
    rows = [df.select("username", F.lit(name).alias("section"), F.col("page").cast("long").alias("page")) for name, df in found.items()]
    return reduce(DataFrame.unionByName, rows).groupBy("username", "section").agg(F.count("*").alias("n"), F.min("page").alias("first_page"))


@query("w3_last_page_wins", SECTIONS + "SELECT 'c-' || o_custkey AS username, o_orderkey + 5500000 AS id, max(page) AS page, min(page) AS first_page FROM y GROUP BY o_custkey, o_orderkey")
def w3(spark, sf):
    cards = render.profile_html(spark, sf).withColumn("username", F.regexp_extract("url", r"/users/([^/]+)", 1))
    found = catalog.catalog_items(catalog.catalog_pages(cards, fingerprint=False, markup=False))
    merged = crawl.last_page_wins(found.select("username", "id", "page", "pos", "title"))
    return merged.select("username", "id", F.col("page").cast("long").alias("page"), F.col("first_page").cast("long").alias("first_page"))


@query("j4_profiles_with_sections", SECTIONS + """, n AS (SELECT o_custkey, count(DISTINCT o_orderkey) AS works FROM y WHERE page <= 2 GROUP BY o_custkey)
SELECT 'c-' || c_custkey AS username, works, CASE WHEN works IS NOT NULL THEN 'c-' || c_custkey END AS owner FROM customer LEFT JOIN n ON c_custkey = o_custkey""")
def j4(spark, sf):
    # Read twice, for the profiles and for their works; the pages are parsed once.
    parsed = materialize(profiles(spark, sf).select("username", "page", "name", "portfolio"))
    works = profile.section_rows(parsed, "portfolio")
    nested = profile.with_sections(parsed.filter("page = 1").drop("page"), 2, portfolio=works)
    owner = F.regexp_extract(F.get("portfolio", F.lit(0))["url"], r"/users/([^/]+)/", 1)
    return nested.select("username", F.when(F.col("portfolio").isNotNull(), F.size("portfolio")).cast("long").alias("works"), owner.alias("owner"))


@query("a11_categories", f"""SELECT DISTINCT p_type AS name, '{BASE}/projects/category/' || lower(p_type) || '/' AS url, lower(p_type) AS slug, NULL AS parent FROM part
UNION SELECT DISTINCT p_type || ' sub', '{BASE}/projects/category/' || lower(p_type) || '/sub/', lower(p_type) || '/sub', lower(p_type) FROM part""")
def a11(spark, sf):
    parsed = dom.parse_html(render.category_html(spark, sf))
    links = parsed.select(
        F.regexp_extract("url", r"brand=(\d+)", 1).cast("long").alias("brand"),
        F.posexplode(generic.links(F.col("nodes"), F.col("texts"), split_base(F.col("url")))).alias("pos", "l"),
    )
    rows = links.select(F.col("l.url").alias("url"), F.col("l.text").alias("name"), (F.col("brand") * 100000 + F.col("pos")).alias("ord"))
    return crawl.distinct_categories(rows).select("name", "url", "slug", "parent")


# ---- many crawls in one table ------------------------------------------------------

BRANDS = """WITH r AS (SELECT p_partkey AS id, replace(lower(p_brand), '#', '-') AS slug,
  row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS n FROM part), b AS (SELECT id, slug, n // 10 + 1 AS page FROM r) """


def brand_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Every brand is one category listing of ten parts a page; brands that end in 5 use unknown words."""
    slug = F.replace(F.lower("p_brand"), F.lit("#"), F.lit("-"))
    by_brand = Window.partitionBy("p_brand")
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), slug.alias("slug"),
        F.floor((F.row_number().over(by_brand.orderBy("p_partkey")) - 1) / 10).cast("long").alias("n"),
        F.ceil(F.count("*").over(by_brand) / 10).cast("long").alias("pages"),
    )
    card = F.concat(
        F.lit('<article><h2><a href="/projects/'), F.col("id").cast("string"), F.lit('/">Part</a></h2><p>'),
        F.when(F.col("slug").endswith("5"), "Нечто").otherwise("Заказ"), F.lit("</p></article>"),
    )
    listed = parts.groupBy("slug", "n", "pages").agg(F.array_join(F.array_sort(F.collect_list(card)), "").alias("cards"))
    start = F.concat(F.lit(f"{BASE}/projects/category/"), "slug", F.lit("/"))
    following = F.when(F.col("n") + 1 < F.col("pages"), F.concat(F.lit('<a rel="next" href="'), start, F.lit("page-"), (F.col("n") + 2).cast("string"), F.lit('/">n</a>')))
    return listed.select(
        F.when(F.col("n") == 0, start).otherwise(F.concat(start, F.lit("page-"), (F.col("n") + 1).cast("string"), F.lit("/"))).alias("url"),
        F.concat(F.lit("<body><main>"), "cards", F.coalesce(following, F.lit("")), F.lit("</main></body>")).alias("html"),
    )


@query("w4_many_crawls", BRANDS + "SELECT slug, page, id FROM b WHERE NOT ends_with(slug, '5')")
def w4_many(spark, sf):
    found = verbs.projects(brand_pages(spark, sf)).ok
    return found.select(urls.listing_category(F.col("crawl")).alias("slug"), F.col("page").cast("long").alias("page"), "id")


@query("p6_category_filter", BRANDS + "SELECT page, id FROM b WHERE slug = 'brand-13'")
def p6_category(spark, sf):
    found = verbs.projects(brand_pages(spark, sf), category="/projects/category/brand-13/").ok
    return found.select(F.col("page").cast("long").alias("page"), "id")


@query("p12_failed_channel", BRANDS + "SELECT DISTINCT slug, page, 'selector_drift' AS error FROM b WHERE ends_with(slug, '5')")
def p12_failed(spark, sf):
    failed = verbs.projects(brand_pages(spark, sf)).failed
    return failed.select(urls.listing_category(F.col("crawl")).alias("slug"), F.col("page").cast("long").alias("page"), F.col("error.kind").alias("error"))


@query("p12_people_status", """WITH p AS (SELECT DISTINCT s_suppkey // 30 + 1 AS page FROM supplier)
SELECT page, 'ok' AS status FROM p UNION ALL SELECT max(page) + 1, 'catalog_end' FROM p""")
def p12_people(spark, sf):
    found = people.people_pages(render.people_html(spark, sf))
    return found.select(F.col("page").cast("long").alias("page"), quality.page_status().alias("status"))


# ---- the whole crawl -------------------------------------------------------------



def stored_state(spark: SparkSession, sf: str, found: DataFrame) -> DataFrame:
    """State of an earlier run: ids not divisible by 7, every 11th with another hash."""
    key = F.col("id") - render.ITEM_OFFSET
    return found.filter(key % 7 != 0).select(
        "id", F.when(key % 11 == 0, "altered").otherwise(F.col("content_hash")).alias("content_hash")
    )


def crawl_scan(spark: SparkSession, sf: str, stop_after_known: int) -> incremental.IncrementalScan:
    """Rendered catalog to items, filtered to orders, cut, compared with the stored state."""
    rows = verbs.crawl_rows(render.catalog_html(spark, sf)).withColumn("namespace", F.lit("projects"))
    found = rows.filter(F.col("id").isNotNull()).select(
        "namespace", "page", "pos", "id", "title", "kind", "content_hash"
    )
    unique = first_per_key(found.select("id", "content_hash", "page", "pos"), F.col("id"), ["page", "pos"])
    index = rows.select("namespace", "page", "next_url").distinct()
    return incremental.incremental_scan(
        found, index, stored_state(spark, sf, unique), stop_after_known=stop_after_known
    )


SCAN_SQL = ITEMS + """, c AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY page, pos) AS nth FROM items WHERE kind = 'order'),
k AS (SELECT *, nth > 1 OR NOT (o_orderkey % 7 = 0 OR o_orderkey % 11 = 0) AS known FROM c),
i AS (SELECT *, sum(CASE WHEN known THEN 0 ELSE 1 END) OVER (ORDER BY page, pos ROWS UNBOUNDED PRECEDING) AS island FROM k),
s AS (SELECT *, sum(CASE WHEN known THEN 1 ELSE 0 END) OVER (PARTITION BY island ORDER BY page, pos ROWS UNBOUNDED PRECEDING) AS streak FROM i),
e AS (SELECT min(page * 1000 + pos) AS stop FROM s WHERE streak >= {n}) """


@query("new_items_flagship", SCAN_SQL.format(n=1000) + "SELECT id, page, 'Item & order ' || o_orderkey AS title FROM s, e WHERE NOT known AND (stop IS NULL OR page * 1000 + pos <= stop)")
def flagship(spark, sf):
    return crawl_scan(spark, sf, 1000).emitted.select("id", F.col("page").cast("long").alias("page"), "title")


@query("l4_stop_after_known", SCAN_SQL.format(n=6) + "SELECT id, page FROM s, e WHERE NOT known AND (stop IS NULL OR page * 1000 + pos <= stop)")
def l4(spark, sf):
    return crawl_scan(spark, sf, 6).emitted.select("id", F.col("page").cast("long").alias("page"))


@query("t3_checkpoint_row", SCAN_SQL.format(n=6) + f"""SELECT 'projects' AS namespace, (stop // 1000 + 1)::BIGINT AS next_page, '{BASE}/projects/page-' || (stop // 1000 + 1) || '/' AS next_url, 6 AS consecutive_known FROM e""")
def t3(spark, sf):
    return crawl_scan(spark, sf, 6).checkpoints.select("namespace", F.col("next_page").cast("long").alias("next_page"), "next_url", F.col("consecutive_known").cast("long").alias("consecutive_known"))


