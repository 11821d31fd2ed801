"""Scalar functions over whole tables, each with SQL that derives the answer another way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.render import amount, date_text, grouped, table
from pagelake import constants as K
from pagelake.functions import dates, hashing, money, text, urls

QUERIES: dict = {}
SQL: dict[str, str] = {}
BASE = "https://market.example.org"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def stamp(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd HH:mm:ss")


WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"


@query("c1_clean_text", rf"SELECT doc_id, nullif(trim(regexp_replace(text, '{WS}', ' ', 'g')), '') AS cleaned FROM documents")
def c1(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


@query("c2_parse_int", "SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_partkey * 1000 + p_size END AS number FROM part")
def c2(spark, sf):
    p = table(spark, sf, "part")
    number = F.col("p_partkey") * 1000 + F.col("p_size")
    words = F.when(F.col("p_partkey") % 5 == 0, F.col("p_type")).otherwise(
        F.concat(F.lit("about "), grouped(number), F.lit(" pieces"))
    )
    return p.select("p_partkey", text.parse_int(words).alias("number"))


@query("c3_parse_decimal", """SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN -CAST(p_retailprice AS DECIMAL(12,2)) ELSE CAST(p_retailprice AS DECIMAL(12,2)) END::DOUBLE AS number FROM part""")
def c3(spark, sf):
    p = table(spark, sf, "part")
    plain = F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    k = F.col("p_partkey") % 5
    words = (
        F.when(k == 0, "none").when(k == 1, F.concat(F.lit("now -"), plain, F.lit(" off")))
        .when(k == 2, F.concat(F.lit("rate "), F.replace(plain, F.lit("."), F.lit(","))))
        .otherwise(F.concat(F.lit("rate: "), plain))
    )
    return p.select("p_partkey", text.parse_decimal(words).cast("double").alias("number"))


@query("c3_exact_numbers", """SELECT p_partkey, (p_partkey + 1) || '234567890123456789.1234500000' AS number, (3000000000 + p_partkey)::VARCHAR AS responses,
  (5000000000 + p_partkey)::VARCHAR AS page FROM part""")
def c3_exact(spark, sf):
    """Numbers beyond what a long or four decimals hold, and counters beyond an int, as text."""
    key = (F.col("p_partkey") + 1).cast("string")
    big = F.concat(F.lit("from "), key, F.lit(" 234 567 890 123 456 789,12345 on"))
    count = F.concat((F.col("p_partkey") + 3_000_000_000).cast("string"), F.lit(" ответов"))
    link = F.concat(F.lit(f"{BASE}/projects/page-"), (F.col("p_partkey") + 5_000_000_000).cast("string"), F.lit("/"))
    return table(spark, sf, "part").select(
        "p_partkey", text.parse_decimal(big).cast("string").alias("number"),
        text.label_int(count, "responses").cast("string").alias("responses"), urls.page_number(link).cast("string").alias("page"),
    )


def money_text(k: Column, price: Column) -> Column:
    whole = amount(price)
    return (
        F.when(k == 0, F.concat(F.lit("от "), grouped(whole), F.lit(" ₽")))
        .when(k == 1, F.concat(grouped(whole), F.lit(" руб. – "), grouped(whole * 2), F.lit(" руб. Срок: 2 дня")))
        .when(k == 2, F.concat(F.lit("$"), grouped(whole), F.lit(" usd")))
        .when(k == 3, "по договоренности")
        .when(k == 4, F.concat(grouped(whole), F.lit(" €, по результатам собеседования")))
        .when(k == 5, F.concat(grouped(whole), F.lit(","), F.lit("25")))
        .otherwise("  ")
    )


MONEY_SQL = """
WITH m AS (SELECT p_partkey, p_partkey % 7 AS k, CAST(floor(p_retailprice + 0.5) AS BIGINT) AS w FROM part)
SELECT p_partkey,
  CASE WHEN k IN (0,1,2,4) THEN w WHEN k = 5 THEN w + 0.25 END::DOUBLE AS amount_min,
  CASE WHEN k IN (0,2,4) THEN w WHEN k = 1 THEN 2 * w WHEN k = 5 THEN w + 0.25 END::DOUBLE AS amount_max,
  CASE WHEN k IN (0,1) THEN 'RUB' WHEN k = 2 THEN 'USD' WHEN k = 4 THEN 'EUR' END AS currency,
  CASE WHEN k < 6 THEN k = 3 END AS negotiable,
  CASE WHEN k < 6 THEN k = 4 END AS interview_based,
  {extra}
FROM m"""


@query("c4_money", MONEY_SQL.format(extra="CASE WHEN k = 3 THEN 'по договоренности' WHEN k < 6 THEN 'other' END AS raw_kind"))
def c4(spark, sf):
    p = table(spark, sf, "part")
    m = money.parse_money(money_text(F.col("p_partkey") % 7, F.col("p_retailprice")))
    return p.select("p_partkey", m.alias("m")).select(
        "p_partkey",
        F.col("m.amount_min").cast("double").alias("amount_min"),
        F.col("m.amount_max").cast("double").alias("amount_max"),
        "m.currency", "m.negotiable", "m.interview_based",
        F.when(F.col("m.raw") == "по договоренности", F.col("m.raw")).when(F.col("m.raw").isNotNull(), "other").alias("raw_kind"),
    )


@query("p2_representative_amount", """WITH m AS (SELECT p_partkey, p_size % 3 AS lo, p_size AS hi FROM part)
SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN hi WHEN lo <> 0 THEN lo ELSE hi END::DOUBLE AS amount FROM m""")
def p2(spark, sf):
    p = table(spark, sf, "part")
    low = F.when(F.col("p_partkey") % 4 != 0, F.col("p_size") % 3).cast("decimal(38,10)")
    m = F.struct(low.alias("amount_min"), F.col("p_size").cast("decimal(38,10)").alias("amount_max"))
    return p.select("p_partkey", m.alias("m")).select(
        "p_partkey", money.representative_amount(F.col("m")).cast("double").alias("amount")
    )


# Local times become instants; of a local hour that occurs twice in autumn the first one is meant.
@query("c5_ru_datetime", """
WITH w AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN o_orderdate + INTERVAL 12 HOUR + INTERVAL 30 MINUTE
  WHEN 1 THEN o_orderdate + INTERVAL 9 HOUR + INTERVAL 5 MINUTE WHEN 2 THEN o_orderdate - INTERVAL 1 DAY
  WHEN 3 THEN o_orderdate + INTERVAL 10 HOUR - to_minutes(o_orderkey % 500)
  WHEN 4 THEN o_orderdate + INTERVAL 10 HOUR - to_days(CAST(7 * (o_orderkey % 9) AS INTEGER)) END AS wall FROM orders)
SELECT o_orderkey, strftime(least(timezone('UTC', timezone('Europe/Moscow', wall)),
  timezone('UTC', timezone('Europe/Moscow', wall - INTERVAL 1 HOUR)) + INTERVAL 1 HOUR), '%Y-%m-%d %H:%M:%S') AS published FROM w""")
def c5(spark, sf):
    o = table(spark, sf, "orders")
    key, date = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    k = key % 6
    words = (
        F.when(k == 0, F.concat(date_text(date), F.lit(" в 12:30")))
        .when(k == 1, "сегодня в 9:05")
        .when(k == 2, "Вчера")
        .when(k == 3, F.concat((key % 500).cast("string"), F.lit(" минут назад")))
        .when(k == 4, F.concat((key % 9).cast("string"), F.lit(" недели назад")))
        .otherwise("31 февраля 2026")
    )
    # Seen at ten in the morning, Moscow time, of the order's day.
    now = F.to_utc_timestamp(date + F.make_dt_interval(F.lit(0), F.lit(10), F.lit(0), F.lit(0)), "Europe/Moscow")
    return o.select("o_orderkey", stamp(dates.parse_ru_datetime(words, now)).alias("published"))


@query("c6_http_date", "SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN '2026-07-25 12:00:00' ELSE strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y-%m-%d %H:%M:%S') END AS fetched FROM orders")
def c6(spark, sf):
    o = table(spark, sf, "orders")
    at = F.timestamp_seconds(F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 86400)
    header = F.when(F.col("o_orderkey") % 10 == 0, "yesterday").otherwise(
        F.concat(F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    )
    return o.select("o_orderkey", stamp(dates.response_time(header, F.lit("2026-07-25 12:00:00").cast("timestamp"))).alias("fetched"))


@query("c7_retry_after", """SELECT event_id, CASE event_id % 4 WHEN 0 THEN value WHEN 1 THEN 0.0
  WHEN 2 THEN greatest(0.0, epoch(date_trunc('second', ts)) - epoch(TIMESTAMP '2024-01-02 00:00:00')) END AS seconds FROM events""")
def c7(spark, sf):
    e = table(spark, sf, "events")
    k = F.col("event_id") % 4
    header = (
        F.when(k == 0, F.col("value").cast("string")).when(k == 1, F.concat(F.lit("-"), F.col("value").cast("string")))
        .when(k == 2, F.concat(F.date_format(F.col("ts").cast("timestamp"), "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
        .otherwise("soon")
    )
    now = F.lit("2024-01-02 00:00:00").cast("timestamp")
    return e.select("event_id", dates.parse_retry_after(header, now).alias("seconds"))


@query("c9_project_id", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 4 THEN o_orderkey * 1000003 END AS project_id FROM orders")
def c9(spark, sf):
    o = table(spark, sf, "orders")
    ident = (F.col("o_orderkey") * 1000003).cast("string")
    k = F.col("o_orderkey") % 5
    url = (
        F.when(k == 0, F.concat(F.lit(BASE + "/projects/"), ident, F.lit("/some-title.html?ref=1#top")))
        .when(k == 1, F.concat(F.lit("/projects/"), ident, F.lit("/")))
        .when(k == 2, F.concat(F.lit(BASE + "/projects/"), ident))
        .when(k == 3, F.concat(F.lit(BASE + "/projects/"), ident, F.lit(".html")))
        .otherwise(F.concat(F.lit(BASE + "/projects/"), ident, F.lit("/offers")))
    )
    return o.select("o_orderkey", urls.project_id(url).alias("project_id"))


@query("c10_username", "SELECT c_custkey, CASE WHEN c_custkey % 4 < 3 THEN 'c-' || c_custkey END AS username, CASE WHEN c_custkey % 4 = 3 THEN 'c-' || c_custkey ELSE 'c-' || c_custkey END AS handle FROM customer")
def c10(spark, sf):
    c = table(spark, sf, "customer")
    name = F.concat(F.lit("c-"), F.col("c_custkey").cast("string"))
    k = F.col("c_custkey") % 4
    url = (
        F.when(k == 0, F.concat(F.lit(BASE + "/users/"), name, F.lit("/?tab=1")))
        .when(k == 1, F.concat(F.lit("/users/"), name))
        .when(k == 2, F.concat(F.lit(BASE + "/users/"), name, F.lit("/portfolio/")))
        .otherwise(F.concat(F.lit("/"), name, F.lit("/")))
    )
    return c.select("c_custkey", urls.username(url).alias("username"), urls.handle(BASE, url).alias("handle"))


@query("c11_absolute_url", r"""
WITH p AS (SELECT page_id, page_id % 8 AS k, url, regexp_extract(url, '^(https?)', 1) AS scheme,
  regexp_extract(url, '^https?://([^/?#]*)', 1) AS host, regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) AS path,
  regexp_extract(url, '(\?[^#]*)', 1) AS query FROM pages),
q AS (SELECT *, scheme || '://' || host AS site, regexp_extract(path, '^(.*/)[^/]*$', 1) AS dir FROM p)
SELECT page_id, CASE k WHEN 0 THEN site || '/a/b.html' WHEN 1 THEN site || dir || 'c/d' WHEN 2 THEN site || path || '?q=1'
  WHEN 3 THEN site || path || query || '#frag' WHEN 4 THEN scheme || '://other.example.org/x'
  WHEN 5 THEN 'mailto:someone@example.org' WHEN 6 THEN site || '/y/z'
  WHEN 7 THEN NULL END AS resolved FROM q""")
def c11(spark, sf):
    p = table(spark, sf, "pages")
    k = F.col("page_id") % 8
    value = (
        F.when(k == 0, "/a/b.html").when(k == 1, "c/d").when(k == 2, "?q=1").when(k == 3, "#frag")
        .when(k == 4, "//other.example.org/x").when(k == 5, "mailto:someone@example.org")
        .when(k == 6, "/x/../y/./z").otherwise("")
    )
    return p.select("page_id", urls.absolute_url(F.col("url"), value).alias("resolved"))


@query("c12_with_page", r"""SELECT page_id, CASE
  WHEN url LIKE '%?page=2&ref=x' THEN replace(url, '?page=2&', '?page=7&')
  WHEN url LIKE '%#top' THEN replace(url, '#top', '?page=7#top')
  WHEN url LIKE '%?utm_source=feed' THEN url || '&page=7'
  ELSE url || '?page=7' END AS paged FROM pages""")
def c12(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.with_page(F.col("url"), F.lit(7)).alias("paged"))


@query("c13_page_number", "SELECT page_id, CASE WHEN url LIKE '%?page=2%' THEN 2 WHEN page_id % 2 = 0 THEN page_id END::BIGINT AS page FROM pages")
def c13(spark, sf):
    p = table(spark, sf, "pages")
    listed = F.when(
        (F.col("page_id") % 2 == 0) & ~F.col("url").contains("?"),
        F.concat(F.lit(BASE + "/projects/page-"), F.col("page_id").cast("string"), F.lit("/")),
    ).when(
        (F.col("page_id") % 2 == 0) & ~F.col("url").contains("?page"),
        F.concat(F.lit(BASE + "/projects/page-"), F.col("page_id").cast("string"), F.lit("/?page=x")),
    ).otherwise(F.col("url"))
    return p.select("page_id", urls.page_number(listed).cast("long").alias("page"))


@query("c14_url_builders", f"""SELECT p_partkey,
  CASE p_partkey % 4 WHEN 0 THEN '{BASE}/projects/' WHEN 1 THEN 'https://x.example.org/list' ELSE '{BASE}/projects/category/' || lower(p_type) || '/' END AS listing,
  CASE p_partkey % 4 WHEN 0 THEN '{BASE}/freelancers/' WHEN 1 THEN 'https://x.example.org/list/' WHEN 2 THEN '{BASE}/freelancers/projects/category/' || lower(p_type) || '/'
    ELSE '{BASE}/freelancers/' || lower(p_type) || '/' END || CASE WHEN p_size = 1 THEN '' ELSE 'page-' || p_size || '/' END AS people,
  CASE WHEN p_partkey % 2 = 0 THEN '{BASE}/projects/' || p_partkey || '/' ELSE '{BASE}/projects/' || p_partkey || '/t.html' END AS detail,
  '{BASE}/users/u-' || p_partkey || '/' AS profile FROM part""")
def c14(spark, sf):
    p = table(spark, sf, "part")
    k = F.col("p_partkey") % 4
    slug = F.lower("p_type")
    category = (
        F.when(k == 0, None).when(k == 1, "https://x.example.org/list")
        .when(k == 2, F.concat(F.lit("/projects/category/"), slug, F.lit("/"))).otherwise(F.concat(F.lit("/"), slug, F.lit("/")))
    )
    key = F.col("p_partkey").cast("string")
    project = F.when(F.col("p_partkey") % 2 == 0, key).otherwise(F.concat(F.lit("/projects/"), key, F.lit("/t.html")))
    user = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("u-"), key)).otherwise(F.concat(F.lit(BASE + "/users/u-"), key, F.lit("/")))
    return p.select(
        "p_partkey", urls.listing_url(BASE, category).alias("listing"),
        urls.people_url(BASE, category, F.col("p_size")).alias("people"),
        urls.detail_url(BASE, project).alias("detail"), urls.user_url(BASE, user).alias("profile"),
    )


@query("c15_endpoint", r"SELECT page_id, coalesce(nullif(regexp_extract(url, '^https?://[^/?#]+/([^/?#]+)', 1), ''), 'root') AS endpoint FROM pages")
def c15(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.endpoint(F.col("url")).alias("endpoint"))


@query("c16_append_params", f"""SELECT p_partkey, '{BASE}/projects/?search=' || replace(p_name, ' ', '+') || '&kind=1&kind=' || (2 + p_size % 2) || '&with_budget=' || (p_size % 2) AS url FROM part""")
def c16(spark, sf):
    p = table(spark, sf, "part")
    pair = lambda k, v: F.struct(F.lit(k).alias("k"), v.cast("string").alias("v"))
    pairs = F.array(
        pair("search", F.col("p_name")), pair("kind", F.lit(1)), pair("kind", 2 + F.col("p_size") % 2), pair("with_budget", F.col("p_size") % 2)
    )
    return p.select("p_partkey", urls.append_params(F.lit(f"{BASE}/projects/"), pairs).alias("url"))


@query("c17_redact_url", """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'https://***@proxy.example.org:8080/a?token=***&x=1#f'
  WHEN c_custkey % 3 = 1 THEN 'http://h.example.org/p?monkey=***&q=' || c_custkey ELSE 'https://h.example.org/users/' || c_custkey || '/' END AS safe FROM customer""")
def c17(spark, sf):
    c = table(spark, sf, "customer")
    key = F.col("c_custkey").cast("string")
    url = (
        F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("https://u"), key, F.lit(":pw@Proxy.example.org:8080/a?token=t"), key, F.lit("&x=1#f")))
        .when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("http://h.example.org/p?monkey=s"), key, F.lit("&q="), key))
        .otherwise(F.concat(F.lit("https://h.example.org/users/"), key, F.lit("/")))
    )
    return c.select("c_custkey", urls.redact_url(url).alias("safe"))


@query("c18_content_fingerprint", rf"SELECT page_id, substr(sha256(trim(regexp_replace(html, '{WS}', ' ', 'g'))), 1, 16) AS fingerprint FROM pages")
def c18(spark, sf):
    return table(spark, sf, "pages").select("page_id", hashing.content_fingerprint(F.col("html")).alias("fingerprint"))


@query("c19_record_hash", """SELECT o_orderkey, sha256('{"customer":' || o_custkey || ',"id":' || o_orderkey || ',"kind":"' || o_orderpriority || '","status":' ||
  CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE '"' || o_orderstatus || '"' END || '}') AS content_hash FROM orders""")
def c19(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", hashing.record_hash([
        F.col("o_custkey").alias("customer"), F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("kind"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
    ]).alias("content_hash"))


@query("c22_kind_from_text", """SELECT o_orderkey, CASE WHEN o_orderpriority[1] = '5' THEN 'contest' WHEN o_orderpriority[1] = '4' THEN 'vacancy'
  WHEN o_orderpriority[1] = '3' THEN 'unknown' ELSE 'order' END AS kind FROM orders""")
def c22(spark, sf):
    digit = F.substring("o_orderpriority", 1, 1)
    words = (
        F.when(digit == "5", "КОНКУРС и заказ").when(digit == "4", "Заказ, Вакансия (A)").when(digit == "3", "Разное")
        .when(digit == "2", "Новый проект").otherwise("Заказ")
    )
    return table(spark, sf, "orders").select("o_orderkey", text.kind(words).alias("kind"))


@query("c23_status_from_text", """SELECT o_orderkey, CASE WHEN o_orderkey % 6 < 2 THEN 'executor_selected' WHEN o_orderkey % 6 < 4 THEN 'closed' WHEN o_orderkey % 6 = 4 THEN 'open' ELSE 'unknown' END AS status FROM orders""")
def c23(spark, sf):
    words = F.element_at(F.array(*[F.lit(w) for w in (
        "Исполнитель определен, закрыт", "исполнитель выбран", "Заказ закрыт", "Завершён", "Откликнуться", "Ждём")]), (F.col("o_orderkey") % 6 + 1).cast("int"))
    return table(spark, sf, "orders").select("o_orderkey", text.status(words).alias("status"))


@query("c27_title_fields", """SELECT c_custkey, c_name AS name, c_custkey AS user_id, CASE WHEN c_custkey % 2 = 0 THEN 'customer' ELSE 'freelancer' END AS role,
  n_name AS location FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def c27(spark, sf):
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    title = F.concat(
        F.when(F.col("c_custkey") % 2 == 0, "Заказчик ").otherwise("Фрилансер "), F.col("c_name"), F.lit(" ID:"),
        F.col("c_custkey").cast("string"), F.lit(" - работа, Market.example, "), F.col("n_name"),
    )
    return c.select("c_custkey", text.title_fields(title, "Market.example").alias("t")).select("c_custkey", "t.*")


@query("c28_sentiment", """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'negative' WHEN 1 THEN 'negative' WHEN 2 THEN 'positive' END AS sentiment FROM orders""")
def c28(spark, sf):
    words = F.element_at(F.array(*[F.lit(w) for w in (
        "Отрицательный отзыв", "плюс и минус", "Положительно", "Нейтрально")]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return table(spark, sf, "orders").select("o_orderkey", text.sentiment(words).alias("sentiment"))


@query("c29_attachment_test", """SELECT p_partkey, p_partkey % 6 < 4 AS attachment FROM part""")
def c29(spark, sf):
    ends = F.element_at(F.array(*[F.lit(w) for w in (
        "a.pdf", "b.DOCX?v=1", "c.jpeg", "d.7z", "e.html", "f.pdfx")]), (F.col("p_partkey") % 6 + 1).cast("int"))
    return table(spark, sf, "part").select("p_partkey", urls.is_attachment(F.concat(F.lit(BASE + "/f/"), ends)).alias("attachment"))


@query("c30_split_place", "SELECT c_custkey, c_name AS name, CASE WHEN c_custkey % 3 > 0 THEN n_name || ', ' || c_mktsegment END AS location FROM customer JOIN nation ON c_nationkey = n_nationkey")
def c30(spark, sf):
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    value = F.when(F.col("c_custkey") % 3 > 0, F.concat_ws(", ", "c_name", "n_name", "c_mktsegment")).otherwise(F.col("c_name"))
    return c.select("c_custkey", text.split_place(value).alias("s")).select("c_custkey", "s.*")


@query("p4_kind_alias", """SELECT event_id, CASE event_type WHEN 'view' THEN 'order' WHEN 'click' THEN 'vacancy' WHEN 'signup' THEN 'contest' WHEN 'purchase' THEN 'contest' END AS kind FROM events""")
def p4(spark, sf):
    words = (
        F.when(F.col("event_type") == "view", " Заказы ").when(F.col("event_type") == "click", "VACANCIES")
        .when(F.col("event_type") == "signup", "3").when(F.col("event_type") == "purchase", "конкурс").otherwise("other")
    )
    return table(spark, sf, "events").select("event_id", text.normalize_kind(words).alias("kind"))


@query("p7_allowed_host", r"SELECT page_id, regexp_matches(url, '^https?://([^/?#]*\.)?example\.com[/?#]') AS allowed FROM pages")
def p7(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", urls.is_allowed_host(F.concat(F.upper(urls.host(F.col("url"))), F.lit(".")), ["example.com"]).alias("allowed")
    )


@query("p8_url_policy", r"SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'bad_scheme' WHEN NOT regexp_matches(url, '^https?://([^/?#]*\.)?example\.(com|org)[/?#]') THEN 'bad_host' END AS problem FROM pages")
def p8(spark, sf):
    url = F.when(F.col("page_id") % 5 == 0, F.regexp_replace("url", "^https?", "ftp")).otherwise(F.col("url"))
    return table(spark, sf, "pages").select("page_id", urls.url_problem(url, ["example.com", "example.org"]).alias("problem"))


@query("p9_redirect_policy", r"""
WITH p AS (SELECT page_id, url, lead(url) OVER (ORDER BY page_id) AS target FROM pages),
h AS (SELECT *, regexp_extract(url, '^(https?)', 1) AS s1, regexp_extract(target, '^(https?)', 1) AS s2,
  regexp_extract(url, '^https?://([^/?#]*)', 1) AS h1, regexp_extract(target, '^https?://([^/?#]*)', 1) AS h2 FROM p WHERE target IS NOT NULL)
SELECT page_id, CASE WHEN s1 = 'https' AND s2 = 'http' THEN 'refused_downgrade'
  WHEN NOT regexp_matches(h2, '(^|\.)example\.(com|org)$') THEN 'bad_host'
  WHEN s1 <> s2 OR h1 <> h2 THEN 'cross_origin' ELSE 'same_origin' END AS verdict FROM h""")
def p9(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "url")
    hops = p.join(p.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("target")), "page_id")
    return hops.select("page_id", urls.redirect_verdict(F.col("url"), F.col("target"), ["example.com", "example.org"]).alias("verdict"))


@query("k5_failure_key", "SELECT page_id, substr(regexp_replace(url, '[^a-zA-Z0-9_.-]+', '_', 'g'), 1, 160) AS failure_key FROM pages")
def k5(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.failure_key(F.col("url")).alias("failure_key"))


@query("s9_frontier_urls", f"""SELECT p_partkey, page, '{BASE}/freelancers/' || CASE WHEN page = 1 THEN '' ELSE 'page-' || page || '/' END AS url
  FROM (SELECT p_partkey, unnest(range(1, p_size + 1)) AS page FROM part)""")
def s9(spark, sf):
    from pagelake.operators.crawl import frontier

    p = table(spark, sf, "part").select("p_partkey", F.lit(1).cast("long").alias("first"), F.col("p_size").cast("long").alias("n"))
    return frontier(p, "first", "n").select("p_partkey", "page", urls.people_url(BASE, F.lit(None).cast("string"), F.col("page")).alias("url"))


@query("j5_alias_lookup", """SELECT o_orderkey, CASE o_orderpriority[1] WHEN '1' THEN 'order' WHEN '2' THEN 'vacancy' WHEN '3' THEN 'contest' END AS kind FROM orders""")
def j5(spark, sf):
    aliases = spark.createDataFrame(list(K.KIND_ALIASES.items()), "alias string, kind string")
    o = table(spark, sf, "orders").withColumn("alias", F.substring("o_orderpriority", 1, 1))
    return o.join(aliases, "alias", "left").select("o_orderkey", "kind")


