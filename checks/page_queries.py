"""Queries over the table of raw pages and over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.render import dealt, table
from pagelake.functions import hashing, urls
from pagelake.operators import catalog, detail, dom, generic, quality, robots
from pagelake.session import materialize
from pagelake.sources import pages as sources

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return dealt(table(spark, sf, "pages"))


def with_status(df: DataFrame) -> DataFrame:
    """Pages of a crawl that met every kind of response, by page number."""
    k = F.col("page_id") % 12
    code = F.element_at(
        F.array(*[F.lit(c) for c in (200, 404, 429, 503, 401, 403, 200, 200, 503, 200, 500, 200)]), (k + 1).cast("int")
    )
    extra = (
        F.when(k == 6, '<div class="g-recaptcha"></div><div class="hcaptcha"></div>')
        .when(k == 7, "<p>Необходимо авторизоваться</p>")
        .when(k == 8, '<div id="CF-CHL-x"></div>')
        .when(k == 9, '<div class="g-recaptcha">captcha</div>')
        .otherwise("")
    )
    url = F.when(k == 11, F.concat(F.col("url"), F.lit("&next=Challenge"))).otherwise(F.col("url"))
    return df.select("page_id", url.alias("url"), F.concat("html", extra).alias("html"), code.alias("status_code"))


CLASS_SQL = """CASE page_id % 12 WHEN 0 THEN 'ok' WHEN 1 THEN 'http_error' WHEN 2 THEN 'rate_limited' WHEN 3 THEN 'retryable'
  WHEN 4 THEN 'auth_required' WHEN 5 THEN 'auth_required' WHEN 6 THEN 'blocked' WHEN 7 THEN 'auth_required' WHEN 8 THEN 'blocked'
  WHEN 9 THEN 'ok' WHEN 10 THEN 'retryable' WHEN 11 THEN 'blocked' END"""


@query("s1_page_scan", "SELECT page_id, url, length(html) AS html_chars FROM pages")
def s1(spark, sf):
    return sources.read_pages(spark, f"{sf}/pages.parquet").select("page_id", "url", F.length("html").alias("html_chars"))


@query("s2_raw_html", "SELECT url, html FROM pages")
def s2(spark, sf):
    return sources.raw_html(table(spark, sf, "pages"))


@query("p11_response_class", f"SELECT page_id, {CLASS_SQL} AS response_class FROM pages")
def p11(spark, sf):
    return with_status(pages(spark, sf)).select(
        "page_id", quality.response_class(F.col("url"), F.col("html"), F.col("status_code")).alias("response_class")
    )


@query("response_summary", rf"""
WITH p AS (SELECT {CLASS_SQL} AS response_class, coalesce(nullif(regexp_extract(url, '^https?://[^/?#]+/([^/?#]+)', 1), ''), 'root') AS endpoint,
  regexp_matches(url, '^https?://([^/?#]*\.)?example\.(com|org)[/?#]') AS allowed FROM pages)
SELECT response_class, endpoint, count(*) AS pages, sum(CASE WHEN allowed THEN 1 ELSE 0 END)::BIGINT AS allowed_pages FROM p GROUP BY 1, 2""")
def response_summary(spark, sf):
    judged = with_status(pages(spark, sf)).select(
        quality.response_class(F.col("url"), F.col("html"), F.col("status_code")).alias("response_class"),
        urls.endpoint(F.col("url")).alias("endpoint"),
        urls.url_problem(F.col("url"), ["example.com", "example.org"]).isNull().alias("allowed"),
    )
    return judged.groupBy("response_class", "endpoint").agg(
        F.count("*").alias("pages"), F.count_if("allowed").alias("allowed_pages")
    )


@query("k6_blocked_records", f"""SELECT page_id, body_bytes, least(body_bytes, 5000) AS kept_bytes, page_id AS request_header, FALSE AS has_cookie
  FROM (SELECT page_id, strlen(html) + CASE page_id % 12 WHEN 6 THEN strlen('<div class="g-recaptcha"></div><div class="hcaptcha"></div>') WHEN 8 THEN strlen('<div id="CF-CHL-x"></div>') ELSE 0 END AS body_bytes FROM pages WHERE {CLASS_SQL} = 'blocked')""")
def k6(spark, sf):
    headers = F.create_map(
        F.lit("X-Request"), F.col("page_id").cast("string"), F.lit("Set-Cookie"), F.lit("secret"), F.lit("authorization"), F.lit("secret")
    )
    judged = with_status(pages(spark, sf)).withColumn("headers", headers).filter(
        quality.response_class(F.col("url"), F.col("html"), F.col("status_code")) == "blocked"
    )
    kept = sources.blocked_records(judged.withColumn("url", F.col("page_id").cast("string")), 5000)
    return kept.select(
        F.col("url").cast("long").alias("page_id"), F.col("body_bytes").cast("long").alias("body_bytes"),
        F.octet_length("body").cast("long").alias("kept_bytes"), F.col("headers")["X-Request"].cast("long").alias("request_header"),
        (F.map_contains_key("headers", "Set-Cookie") | F.map_contains_key("headers", "authorization")).alias("has_cookie"),
    )


ROBOTS_TEXT = "# rules\nUser-agent: other\nDisallow: /\n\nUser-agent: *\nAllow: /en/1\nDisallow: /en/\nDisallow: /fr/ # closed\nDisallow:\n"


def robots_files(df: DataFrame) -> DataFrame:
    """A robots text for every host but those that start with ``blog.``."""
    hosts = df.select(urls.host(F.col("url")).alias("host")).distinct().filter(~F.col("host").startswith("blog."))
    return hosts.withColumn("text", F.lit(ROBOTS_TEXT))


@query("s6_robots_rules", r"""WITH h AS (SELECT DISTINCT regexp_extract(url, '^https?://([^/?#]*)', 1) AS host FROM pages)
SELECT host, r.* FROM h, (VALUES ('other', 0, FALSE, '/'), ('*', 1, TRUE, '/en/1'), ('*', 2, FALSE, '/en/'), ('*', 3, FALSE, '/fr/'), ('*', 4, TRUE, '')) AS r(agent, ord, allow, prefix)
WHERE NOT starts_with(host, 'blog.')""")
def s6(spark, sf):
    return robots.rule_rows(robots.robots_rules(robots_files(table(spark, sf, "pages"))))


ROBOTS_SQL = r"""WITH p AS (SELECT page_id, regexp_extract(url, '^https?://([^/?#]*)', 1) AS host, regexp_extract(url, '^https?://[^/?#]*([^#]*)', 1) AS target FROM pages)
SELECT page_id, CASE WHEN starts_with(host, 'blog.') THEN {missing} WHEN starts_with(target, '/en/1') THEN TRUE
  WHEN starts_with(target, '/en/') OR starts_with(target, '/fr/') THEN FALSE ELSE TRUE END AS allowed FROM p"""


HOSTS = "WITH h AS (SELECT DISTINCT regexp_extract(url, '^https?://([^/?#]*)', 1) AS host FROM pages) "


@query("s6_crawl_delay", HOSTS + "SELECT host, 'b' AS agent, 0::BIGINT AS ord, '/x' AS prefix FROM h")
def s6_delay(spark, sf):
    """A delay closes the list of agents, so the rules after it belong to the next agent alone."""
    files = table(spark, sf, "pages").select(urls.host(F.col("url")).alias("host")).distinct().withColumn(
        "text", F.lit("User-agent: a\nCrawl-delay: 5\nUser-agent: b\nRequest-rate: 1/5\nDisallow: /x\n")
    )
    return robots.rule_rows(robots.robots_rules(files)).select("host", "agent", F.col("ord").cast("long").alias("ord"), "prefix")


@query("p10_encoded_paths", "SELECT page_id, page_id % 4 = 3 AS allowed FROM pages")
def p10_encoded(spark, sf):
    """Both ways of writing a path are one path; so are escapes in either case."""
    p = table(spark, sf, "pages")
    place = F.element_at(F.array(F.lit("/café/"), F.lit("/caf%c3%a9/"), F.lit("/a<d?"), F.lit("/free/")), (F.col("page_id") % 4 + 1).cast("int"))
    asked = p.select("page_id", F.concat(F.lit("https://"), urls.host(F.col("url")), place, F.col("page_id").cast("string")).alias("url"))
    files = p.select(urls.host(F.col("url")).alias("host")).distinct().withColumn(
        "text", F.lit("User-agent: *\nDisallow: /caf%C3%A9/\nDisallow: /a%3Cd\n")
    )
    return robots.robots_allowed(asked, robots.robots_rules(files), "crawler").select("page_id", "allowed")


@query("p10_robots_allowed", ROBOTS_SQL.format(missing="TRUE"))
def p10(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url")
    return robots.robots_allowed(p, robots.robots_rules(robots_files(p)), "crawler/1.0").select("page_id", "allowed")


@query("j6_robots_fail_closed", ROBOTS_SQL.format(missing="FALSE"))
def j6(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url")
    return robots.robots_allowed(p, robots.robots_rules(robots_files(p)), "crawler/1.0", fail_closed=True).select("page_id", "allowed")


TOKENS_SQL = """
WITH t AS (SELECT page_id, 'tag:' || lower(unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1))) AS token FROM pages),
c AS (SELECT page_id, 'class:' || unnest(regexp_extract_all(html, 'class="([a-z]+)"', 1)) AS token FROM pages),
l AS (SELECT page_id, 'link_bucket:' || least(len(regexp_extract_all(html, '<a href')) // 10, 10) AS token FROM pages),
a AS (SELECT DISTINCT page_id, token FROM (SELECT * FROM t UNION ALL SELECT * FROM c UNION ALL SELECT * FROM l))"""


@query("c20_structural_tokens", TOKENS_SQL + " SELECT page_id, token FROM a")
def c20(spark, sf):
    return quality.structure(pages(spark, sf).select("page_id", "html")).select("page_id", F.explode("tokens").alias("token"))


@query("c21_structural_fingerprint", TOKENS_SQL + r" SELECT page_id, substr(sha256(string_agg(token, E'\n' ORDER BY token)), 1, 16) AS fingerprint FROM a GROUP BY page_id")
def c21(spark, sf):
    return quality.structure(pages(spark, sf).select("page_id", "html")).select(
        "page_id", F.col("structural_fingerprint").alias("fingerprint")
    )


def surface(column: str = "url"):
    """Pages compare with others of the same host and language."""
    return F.regexp_extract(column, r"^https?://([^?#]*?/[a-z]{2})/", 1)


DRIFT_SQL = TOKENS_SQL + r""",
s AS (SELECT page_id, regexp_extract(url, '^https?://([^?#]*?/[a-z]{2})/', 1) AS surface FROM pages),
b AS (SELECT surface, min(page_id) AS base_id FROM s GROUP BY surface),
n AS (SELECT page_id, count(*) AS n FROM a GROUP BY page_id),
m AS (SELECT s.page_id, b.base_id, count(x.token) AS shared FROM s JOIN b USING (surface) JOIN a y ON y.page_id = s.page_id
  LEFT JOIN a x ON x.page_id = b.base_id AND x.token = y.token GROUP BY 1, 2),
d AS (SELECT m.page_id, m.base_id, shared::DOUBLE / (n1.n + n2.n - shared) AS similarity FROM m JOIN n n1 ON n1.page_id = m.page_id JOIN n n2 ON n2.page_id = m.base_id)"""


def drift(spark, sf):
    # The pages are parsed once: their tokens are stored, then compared with those of one page per surface.
    tokens = materialize(quality.structure(pages(spark, sf)).withColumn("surface", surface()))
    baseline = tokens.groupBy("surface").agg(
        F.min_by("tokens", "page_id").alias("tokens"), F.min("page_id").alias("base_id")
    )
    scored = quality.drift_against_baseline(tokens, baseline.select("surface", "tokens"), "surface")
    return scored.join(baseline.select("surface", "base_id"), "surface")


@query("j7_baseline_similarity", DRIFT_SQL + " SELECT page_id, base_id, round(similarity, 9) AS similarity FROM d")
def j7(spark, sf):
    return drift(spark, sf).select("page_id", "base_id", F.round("similarity", 9).alias("similarity"))


@query("e2_drift_search", DRIFT_SQL + " SELECT page_id, round(similarity, 9) AS similarity FROM d WHERE similarity < 0.9")
def e2(spark, sf):
    return drift(spark, sf).filter("similarity < 0.9").select("page_id", F.round("similarity", 9).alias("similarity"))


@query("e1_jaccard", rf"""
WITH w AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '[^\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]+')) AS words FROM documents)
SELECT a.doc_id, round(CASE WHEN len(list_distinct(list_concat(a.words, b.words))) = 0 THEN 1.0
  ELSE len(list_intersect(a.words, b.words))::DOUBLE / len(list_distinct(list_concat(a.words, b.words))) END, 9) AS similarity
FROM w a JOIN w b ON b.doc_id = a.doc_id + 1""")
def e1(spark, sf):
    d = dealt(table(spark, sf, "documents"))
    words = d.select(
        "doc_id",
        F.array_distinct(F.filter(F.split(F.lower("text"), r"(?U)[\s\x1c-\x1f]+"), lambda x: x != "")).alias("words"),
    )
    following = words.select((F.col("doc_id") - 1).alias("doc_id"), F.col("words").alias("next_words"))
    return words.join(following, "doc_id").select(
        "doc_id", F.round(hashing.jaccard(F.col("words"), F.col("next_words")), 9).alias("similarity")
    )


LINKS_SQL = r"""
WITH r AS (SELECT page_id, url AS base, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href, unnest(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)) AS raw,
  generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) AS ord FROM pages),
u AS (SELECT page_id, ord, CASE WHEN starts_with(href, 'http') THEN href ELSE regexp_extract(base, '^(https?://[^/?#]*)', 1) || href END AS url,
  trim(replace(replace(replace(replace(replace(raw, '&quot;', '"'), '&#x27;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')) AS text FROM r)"""


@query("x5_links", LINKS_SQL + " SELECT page_id, url, arg_min(nullif(text, ''), ord) AS text, row_number() OVER (PARTITION BY page_id ORDER BY min(ord)) - 1 AS pos FROM u GROUP BY page_id, url")
def x5(spark, sf):
    parsed = dom.parse_html(pages(spark, sf))
    links = generic.links(F.col("nodes"), F.col("texts"), urls.split_base(F.col("url")))
    return parsed.select("page_id", F.posexplode(links).alias("pos", "l")).select("page_id", "pos", "l.url", "l.text")


ENTITIES = r"replace(replace(replace(replace(replace({}, '&quot;', '\"'), '&#x27;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')".replace('\\"', '"')


@query("x7_headings", rf"""WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, '<h1>(.*?)</h1>', 1)) AS raw FROM pages)
SELECT page_id, 1 AS level, trim(regexp_replace({ENTITIES.format("raw")}, '\s+', ' ', 'g')) AS text FROM h WHERE trim(raw) <> ''""")
def x7(spark, sf):
    parsed = dom.parse_html(pages(spark, sf))
    return parsed.select("page_id", F.explode(generic.headings(F.col("nodes"), F.col("texts"))).alias("h")).select("page_id", "h.*")


@query("x9_lists", LINKS_SQL + " SELECT page_id, string_agg(text, '|' ORDER BY ord) AS items FROM u WHERE text <> '' GROUP BY page_id")
def x9(spark, sf):
    parsed = dom.parse_html(pages(spark, sf))
    return parsed.select("page_id", F.explode(generic.lists(F.col("nodes"), F.col("texts"))).alias("l")).select(
        "page_id", F.array_join("l", "|").alias("items")
    )


@query("x11_generic_page", LINKS_SQL + rf""",
k AS (SELECT page_id, count(DISTINCT url) AS links FROM u GROUP BY page_id)
SELECT page_id, url AS source_url, nullif(trim(regexp_replace({ENTITIES.format("regexp_extract(html, '<title>(.*?)</title>', 1)")}, '\s+', ' ', 'g')), '') AS title,
  coalesce(links, 0) AS links, len(regexp_extract_all(html, '<h1>')) AS headings, NULL AS canonical_url FROM pages LEFT JOIN k USING (page_id)""")
def x11(spark, sf):
    page = generic.generic_page(pages(spark, sf))
    return page.select(
        "page_id", "source.source_url", "title", F.size("links").cast("long").alias("links"),
        F.size("headings").cast("long").alias("headings"), "canonical_url",
    )


# ---- trees whose shape is known: parts as elements, numbered in document order -----------------

PER_TREE = 30
#: Part i of a tree lies one level below the part before at most; i + min over the parts so far of (height - place) is that depth.
TREE = f"""WITH p AS (SELECT p_partkey AS k, p_partkey // {PER_TREE} AS page, row_number() OVER (PARTITION BY p_partkey // {PER_TREE} ORDER BY p_partkey) AS i,
  1 + p_size % 5 AS height FROM part),
d AS (SELECT *, i + least(0, min(height - i) OVER (PARTITION BY page ORDER BY i)) AS depth FROM p),
l AS (SELECT *, coalesce(lead(depth) OVER (PARTITION BY page ORDER BY i), 0) <= depth AS leaf, max(i) OVER (PARTITION BY page) AS n FROM d),
t AS (SELECT *, CASE WHEN leaf THEN ['p', 'span', 'h2'][k % 3 + 1] ELSE ['div', 'section', 'article'][k % 3 + 1] END AS tag,
  CASE WHEN k % 4 <> 0 THEN 'text ' || k END AS words FROM l),
e AS (SELECT t.*, coalesce((SELECT min(o.i) FROM t AS o WHERE o.page = t.page AND o.i > t.i AND o.depth <= t.depth), n + 1) - 1 AS last,
  coalesce((SELECT max(o.i) FROM t AS o WHERE o.page = t.page AND o.i < t.i AND o.depth = t.depth - 1), 0) AS parent FROM t) """


def tree_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One page per thirty parts: nested elements whose depths come from the sizes of the parts."""
    place = Window.partitionBy("page").orderBy("k")
    p = table(spark, sf, "part").select(
        F.col("p_partkey").alias("k"), F.floor(F.col("p_partkey") / PER_TREE).alias("page"), (1 + F.col("p_size") % 5).alias("height"))
    p = p.withColumn("i", F.row_number().over(place))
    depth = F.col("i") + F.least(F.lit(0), F.min(F.col("height") - F.col("i")).over(place))
    p = p.withColumn("depth", depth).withColumn("leaf", F.coalesce(F.lead("depth").over(place), F.lit(0)) <= F.col("depth"))
    names = F.when(F.col("leaf"), F.array(*map(F.lit, ("p", "span", "h2")))).otherwise(F.array(*map(F.lit, ("div", "section", "article"))))
    p = p.withColumn("tag", F.get(names, (F.col("k") % 3).cast("int")))
    # The thirty elements of a page; what ends after an element is closed from the innermost on.
    rows = p.groupBy("page").agg(F.sort_array(F.collect_list(F.struct("i", "depth", "tag", "k"))).alias("e"))
    following = lambda i: F.coalesce(F.get("e", i + 1)["depth"], F.lit(0))
    # The open element at depth d after element i is the last one up to i with that depth.
    open_at = lambda i, d: F.element_at(F.filter(F.slice("e", 1, i + 1), lambda x: x["depth"] == d), -1)["tag"]
    depths = lambda e, i: F.when(e["depth"] >= following(i), F.sequence(e["depth"], following(i) + F.when(following(i) == 0, 1).otherwise(0), F.lit(-1)))
    closing = lambda e, i: F.coalesce(F.array_join(F.transform(depths(e, i), lambda d: F.concat(F.lit("</"), open_at(i, d), F.lit(">"))), ""), F.lit(""))
    words = lambda e: F.when(e["k"] % 4 != 0, F.concat(F.lit("text "), e["k"].cast("string"))).otherwise("")
    parts = F.transform("e", lambda e, i: F.concat(F.lit("<"), e["tag"], F.lit(' data-k="'), e["k"].cast("string"), F.lit('">'), words(e), closing(e, i)))
    return dealt(rows.select("page", F.concat(F.lit("<main>"), F.array_join(parts, ""), F.lit("</main>")).alias("html")))


@query("x0_nodes", TREE + """SELECT page, i + 2 AS pre, last + 2 AS last, parent + 2 AS parent, tag, k::VARCHAR AS k FROM e
UNION ALL SELECT DISTINCT page, o.pre, n + 2, o.pre - 1, o.tag, NULL FROM e, (VALUES (0, 'html'), (1, 'body'), (2, 'main')) AS o(pre, tag)""")
def x0(spark, sf):
    """Places of all elements, those around the tree included."""
    parsed = dom.parse_html(tree_pages(spark, sf))
    return parsed.select("page", F.explode("nodes").alias("n")).select(
        "page", *[F.col(f"n.{c}").cast("long").alias(c) for c in ("pre", "last", "parent")], "n.tag", F.col("n.attrs")["data-k"].alias("k"))


@query("x1_node_text", TREE + """SELECT e.page, e.i AS pre, string_agg(w.words, ' ' ORDER BY w.i) AS line, string_agg(w.words, '/' ORDER BY w.i) AS lines
FROM e LEFT JOIN e AS w ON w.page = e.page AND w.i BETWEEN e.i AND e.last AND w.words IS NOT NULL GROUP BY e.page, e.i""")
def x1(spark, sf):
    parsed = dom.parse_html(tree_pages(spark, sf))
    texts = F.col("texts")
    found = F.transform(F.slice("nodes", 4, F.size("nodes")), lambda n: F.struct(
        (n["pre"] - 2).cast("long").alias("pre"), dom.text_of(texts, n).alias("line"),
        F.replace(dom.multiline_text_of(texts, n), F.lit("\n"), F.lit("/")).alias("lines")))
    return parsed.select("page", F.explode(found).alias("f")).select("page", "f.*")


@query("x8_paragraphs", TREE + "SELECT page, row_number() OVER (PARTITION BY page ORDER BY i) - 1 AS pos, words AS text FROM e WHERE tag = 'p' AND words IS NOT NULL")
def x8(spark, sf):
    parsed = dom.parse_html(tree_pages(spark, sf))
    found = generic.texts_of(F.col("nodes"), F.col("texts"), dom.match("p"))
    return parsed.select("page", F.posexplode(found).alias("pos", "text")).withColumn("pos", F.col("pos").cast("long"))


@query("x3_meta_map", """SELECT p_partkey, 'size' AS name, CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE p_size::VARCHAR END AS content FROM part
UNION ALL SELECT p_partkey, 'og:type', p_type || ' & co' FROM part UNION ALL SELECT p_partkey, 'both', p_name FROM part""")
def x3(spark, sf):
    """Names come twice for every third part, by property or name; unnamed and empty ones do not count."""
    meta = lambda key, name, value: F.concat(F.lit(f'<meta {key}="{name}" content="'), value, F.lit('">'))
    html = table(spark, sf, "part").select("p_partkey", F.concat(
        F.lit("<head>"), meta("name", "size", F.col("p_size").cast("string")), meta("property", "og:type", F.concat("p_type", F.lit(" &amp; co"))),
        meta("name", "empty", F.lit("")), meta("content2", "x", F.col("p_name")), F.lit('<meta name="both" property="other" content="'), "p_name", F.lit('">'),
        F.when(F.col("p_partkey") % 3 == 0, meta("property", "size", F.col("p_brand"))).otherwise(""), F.lit("</head><body></body>")).alias("html"))
    parsed = dom.parse_html(dealt(html))
    return parsed.select("p_partkey", F.explode(generic.meta_map(F.col("nodes"))).alias("name", "content"))


@query("x2_first_text", rf"""SELECT page_id, nullif(trim(regexp_replace({ENTITIES.format("regexp_extract(html, '<h1>(.*?)</h1>', 1)")}, '\s+', ' ', 'g')), '') AS heading,
  NULL AS icon, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang FROM pages""")
def x2(spark, sf):
    parsed = dom.parse_html(pages(spark, sf))
    nodes, texts = F.col("nodes"), F.col("texts")
    return parsed.select(
        "page_id",
        dom.first_text(texts, nodes, [dom.match(cls="missing"), dom.match("h1"), dom.match("p")]).alias("heading"),
        dom.first_attr(nodes, [dom.match("link", equals=("rel", "icon"))], "href").alias("icon"),
        dom.first_attr(nodes, [dom.match("body"), dom.match("html")], "lang").alias("lang"),
    )


@query("x6_images", """SELECT page_id, 'https://img.example.org/' || page_id || '.png' AS url, 'Page ' || page_id AS alt, 0 AS pos FROM pages
UNION ALL SELECT page_id, 'https://market.example.org/lazy.png', NULL, 1 FROM pages""")
def x6(spark, sf):
    key = F.col("page_id").cast("string")
    tags = F.concat(
        F.lit('<img src="https://img.example.org/'), key, F.lit('.png" alt=" Page '), key, F.lit(' "><img data-src="/lazy.png"><img src="/lazy.png" alt="x"><img alt="none">')
    )
    source = pages(spark, sf).select("page_id", F.concat("html", tags).alias("html"))
    parsed = dom.parse_html(source)
    found = generic.images(F.col("nodes"), urls.split_base(F.lit("https://market.example.org/projects/")))
    return parsed.select("page_id", F.posexplode(found).alias("pos", "i")).select("page_id", "pos", "i.url", "i.alt")


@query("x4_json_ld", """SELECT page_id, '{"@type":"Thing","name":"n' || page_id || '"}' AS block FROM pages""")
def x4(spark, sf):
    blocks = F.concat(
        F.lit('<script type="application/ld+json">{ "name": "n'), F.col("page_id").cast("string"),
        F.lit('", "@type": "Thing" }</script><script type="application/ld+json">{broken</script>'),
    )
    parsed = dom.parse_html(pages(spark, sf).select("page_id", F.concat("html", blocks).alias("html")))
    return parsed.select("page_id", F.explode(generic.json_ld(F.col("ld"))).alias("block"))


@query("x10_tables", """WITH c AS (SELECT r_regionkey, r_name, n_nationkey AS k, CASE WHEN n_nationkey % 4 = 0 THEN '' ELSE n_name END || '|' || n_nationkey AS cells
  FROM nation JOIN region ON n_regionkey = r_regionkey), n AS (SELECT r_regionkey, r_name, count(*) AS n FROM c GROUP BY ALL)
SELECT r_regionkey, 0 AS t, r_name || '|key' AS headers, row_number() OVER (PARTITION BY r_regionkey ORDER BY k) AS i, cells FROM c
UNION ALL SELECT r_regionkey, 0, r_name || '|key', 0, '' FROM n
UNION ALL SELECT r_regionkey, 0, r_name || '|key', n + 1, 'outer inner ' || r_name || '|inner ' || r_name FROM n
UNION ALL SELECT r_regionkey, 0, r_name || '|key', n + 2, 'inner ' || r_name FROM n
UNION ALL SELECT r_regionkey, 1, '', 0, 'inner ' || r_name FROM n""")
def x10(spark, sf):
    """A table per region with a row of one empty cell, a header row, cells without end tags, and a table in its last row."""
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    name = F.when(F.col("n_nationkey") % 4 == 0, "").otherwise(F.col("n_name"))
    row = F.concat(F.lit("<tr><td>"), name, F.lit("<td>"), F.col("n_nationkey").cast("string"), F.lit("</td></tr>"))
    html = n.groupBy("r_regionkey", "r_name").agg(F.sort_array(F.collect_list(F.struct("n_nationkey", row.alias("row")))).alias("rows")).select(
        "r_regionkey",
        F.concat(F.lit("<body><table><tr><td></td></tr><tr><th>"), F.col("r_name"), F.lit("</th><th>key</th></tr>"), F.array_join(F.col("rows.row"), ""),
                 F.lit("<tr><td>outer<table><tr><td>inner "), "r_name", F.lit("</td></tr></table></td></tr></table></body>")).alias("html"),
    )
    found = dom.parse_html(html).select("r_regionkey", F.posexplode(generic.tables(F.col("nodes"), F.col("texts"))).alias("t", "found"))
    return found.select("r_regionkey", "t", F.array_join("found.headers", "|").alias("headers"), F.posexplode("found.rows").alias("i", "row")).select(
        "r_regionkey", "t", "headers", "i", F.array_join("row", "|").alias("cells"))


@query("l5_text_cut", """SELECT doc_id, substr(regexp_replace('https://e.org/' || text, '[^a-zA-Z0-9_.-]+', '_', 'g'), 1, 160) AS failure_key, least(100, strlen(text)) AS kept FROM documents WHERE text IS NOT NULL""")
def l5(spark, sf):
    """The key and the first bytes under which a page is kept whose URL and body are the text of a document."""
    docs = table(spark, sf, "documents").filter("text IS NOT NULL").select(
        "doc_id", "text", F.concat(F.lit("https://e.org/"), F.regexp_replace("text", "\\s", " ")).alias("url"))
    bodies = sources.blocked_records(docs.select(F.col("doc_id").cast("string").alias("url"), F.col("text").alias("html")), 100)
    kept = bodies.select(F.col("url").cast("long").alias("doc_id"), F.octet_length("body").cast("long").alias("kept"))
    return docs.select("doc_id", urls.failure_key(F.concat(F.lit("https://e.org/"), F.col("text"))).alias("failure_key")).join(kept, "doc_id")


@query("j8_realign_results", """SELECT page_id, -page_id AS ord, CASE WHEN page_id % 3 <> 0 THEN length(html) END AS html_chars, CASE WHEN page_id % 3 = 0 THEN 'missing_page' END AS error FROM pages""")
def j8(spark, sf):
    """Results come back in any order and partly not at all; each request gets its own, or the reason there is none."""
    p = table(spark, sf, "pages")
    requests = p.select(F.col("page_id").alias("id"), (-F.col("page_id")).alias("ord"))
    none = F.lit(None).cast("struct<kind:string,message:string>")
    results = p.filter(F.col("page_id") % 3 != 0).select(F.col("page_id").alias("id"), F.length("html").alias("html_chars"), none.alias("error"))
    found = detail.with_details(requests, results)
    return found.select(F.col("id").alias("page_id"), "ord", F.col("detail.html_chars").alias("html_chars"), F.col("error.kind").alias("error"))


# ---- selectors given by the caller ------------------------------------------------------------

CHOICES = {
    "in_main": "main span",
    "child": "section > p",
    "listed": "article[data-k], h2, div span",
    "deep": "main div section *",
    "ends": "[data-k$='7']",
    "holds": "p[data-k*=\"1\" i]",
}


@query("u3_css_selectors", TREE + """, a AS (SELECT e.*, EXISTS (SELECT 1 FROM e AS o WHERE o.page = e.page AND o.i < e.i AND o.last >= e.i AND o.tag = 'div') AS in_div,
  EXISTS (SELECT 1 FROM e AS o JOIN e AS s ON s.page = o.page AND s.i > o.i AND s.i <= o.last AND s.tag = 'section'
          WHERE o.page = e.page AND o.tag = 'div' AND s.i < e.i AND s.last >= e.i) AS in_both,
  (SELECT tag FROM e AS o WHERE o.page = e.page AND o.i = e.parent) AS above FROM e)
SELECT 'in_main' AS name, page, i AS pre FROM a WHERE tag = 'span' UNION ALL SELECT 'child', page, i FROM a WHERE tag = 'p' AND above = 'section'
UNION ALL SELECT 'listed', page, i FROM a WHERE tag IN ('article', 'h2') OR tag = 'span' AND in_div
UNION ALL SELECT 'deep', page, i FROM a WHERE in_both UNION ALL SELECT 'ends', page, i FROM a WHERE k % 10 = 7
UNION ALL SELECT 'holds', page, i FROM a WHERE tag = 'p' AND contains(k::VARCHAR, '1')""")
def u3(spark, sf):
    """Elements that selectors find among the trees."""
    parsed = dom.parse_html(tree_pages(spark, sf))
    found = F.array(*(
        F.struct(F.lit(name).alias("name"), F.transform(dom.select(F.col("nodes"), css), lambda n: (n["pre"] - 2).cast("long")).alias("pre"))
        for name, css in CHOICES.items()))
    each = parsed.select("page", F.explode(found).alias("f"))
    return each.select("f.name", "page", F.explode("f.pre").alias("pre"))


OTHER_MARKUP = catalog.Selectors(
    description=["q[data-role*='SUMM' i]"], price=["i > b[data-cost]", "i.cost"], card="div.tile",
    listing_root=[("offers", "div#offers")], next_link="a.onward[href]",
)


@query("u3_other_markup", """SELECT p_partkey AS id, p_partkey // 20 + 1 AS page, 'Offer ' || p_name AS title, 'About ' || p_type || ' of ' || p_brand AS description,
  CAST(floor(p_retailprice) AS DOUBLE) AS amount, 'offers' AS root, p_partkey // 20 < (SELECT max(p_partkey // 20) FROM part) AS has_next FROM part""")
def u3_markup(spark, sf):
    """A site with markup of its own, read with selectors for cards, texts, prices, root and next link."""
    part = table(spark, sf, "part")
    key, text_ = F.col("p_partkey"), F.col("p_partkey").cast("string")
    tile = F.concat(
        F.lit('<div class="tile wide"><div><h4><a href="/projects/'), text_, F.lit('/">Offer '), "p_name", F.lit('</a></h4></div><q data-role="Summary text">About '),
        "p_type", F.lit(" of "), "p_brand", F.lit('</q>'),
        F.when(key % 2 == 0, F.concat(F.lit('<i class="cost">'), F.floor("p_retailprice").cast("string"), F.lit(" руб</i>")))
        .otherwise(F.concat(F.lit('<i><b data-cost="1">'), F.floor("p_retailprice").cast("string"), F.lit(" руб</b></i>"))), F.lit("</div>"))
    listed = part.groupBy((F.floor(key / 20) + 1).cast("int").alias("page")).agg(
        F.sort_array(F.collect_list(F.struct(key.alias("k"), tile.alias("tile")))).alias("tiles"))
    last = listed.agg(F.max("page")).first()[0]
    onward = F.when(F.col("page") < last, F.concat(F.lit('<a class="onward" href="/projects/page-'), (F.col("page") + 1).cast("string"), F.lit('/">more</a>'))).otherwise("")
    pages_ = dealt(listed).select(
        "page", F.concat(F.lit("https://market.example.org/projects/page-"), F.col("page").cast("string"), F.lit("/")).alias("url"),
        F.concat(F.lit('<body><div class="tile"><a href="/projects/1/">advert</a></div><div id="offers">'), F.array_join(F.col("tiles.tile"), ""), onward, F.lit("</div></body>")).alias("html"))
    found = catalog.catalog_pages(pages_, False, OTHER_MARKUP)
    items = catalog.catalog_items(found.withColumn("root", F.col("root_selector")), keep_pages=True, selectors=OTHER_MARKUP)
    return items.select("id", F.col("page").cast("long").alias("page"), "title", "description", F.col("budget.amount_min").cast("double").alias("amount"), "root", "has_next")
