"""Extraction rule by rule: small pages built around one rule each, several pages per query."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pagelake.functions import urls
from pagelake.functions.hashing import jaccard
from pagelake.operators import catalog, crawl, detail, dom, generic, people, profile, quality
from pagelake.operators.html_tree import build_tree
from pagelake.plans import verbs

SITE = "https://shop.example.net"


def table(spark, *pages):
    """Pages from (path, html) or (path, html, page)."""
    rows = [(SITE + p[0], p[2] if len(p) > 2 else 1, p[1]) for p in pages]
    return spark.createDataFrame(rows, "url string, page int, html string").withColumn(
        "fetched_at", F.lit(datetime(2025, 3, 10, 9)).cast("timestamp")
    )


def body(*parts):
    return "<html><body><main>" + "".join(parts) + "</main></body></html>"


def offer(number, *inside, tag="section", mark='class="catalog-item wide"', words="Конкурс"):
    return f'<{tag} {mark}>{"".join(inside)}<p>{words}</p><h3><a href="/projects/{number}">Offer {number}</a></h3></{tag}>'


def by_path(df):
    return {r.url.removeprefix(SITE): r for r in df.collect()}


# ---- listings ----------------------------------------------------------------------------------


def test_every_card_rule_finds_the_smallest_card(spark):
    """Cards by element, class and data-id, one inside another, and none at all."""
    page = body(
        offer(11, tag="article", mark=""),
        offer(12, mark='class="project"'),
        offer(13, tag="li", mark='data-id="qa-lenta-x"'),
        f'<article>outer words {offer(14, mark="class=b-post")}</article>',
        '<div>Вакансия <span>by parent <a href="/projects/15/long-name.html?x=1">Offer 15</a></span></div>',
        '<div>apart<h2>Заказ <a href="/projects/16/">Offer 16</a></h2><i>tail</i></div>',
    )
    found = catalog.catalog_items(catalog.catalog_pages(table(spark, ("/projects/", page)))).orderBy("pos").collect()
    assert [i.id for i in found] == [11, 12, 13, 14, 15, 16]
    assert [i.kind for i in found] == ["contest"] * 4 + ["unknown", "order"]
    assert found[3].card_text == "Конкурс\nOffer 14" and found[4].card_text == "by parent\nOffer 15"
    assert found[5].card_text == "apart\nЗаказ\nOffer 16\ntail"


def test_repeated_and_unusable_links(spark):
    page = body(offer(5), offer(5), '<article><a href="/projects/6"><img src=i.png></a></article>',
                '<article><a href="/projects/six/">x</a><a href="/projects/?p=7">y</a></article>')
    row = catalog.catalog_pages(table(spark, ("/projects/", page))).first()
    assert (row.candidate_links_found, row.parsed_count, [c.id for c in row.cards]) == (3, 1, [5])


PRICES = [
    ('<b class="x-price">1 234 567,89 $</b>', Decimal("1234567.89"), Decimal("1234567.89"), "USD", "css"),
    ("<p>7 руб – 9 руб</p>", 7, 9, "RUB", "text_fallback"),
    ('<i itemprop="price">до 0,00001 €</i>', Decimal("0.00001"), Decimal("0.00001"), "EUR", "css"),
    ('<i class="budget">12345678901234567890 ₽</i>', Decimal("12345678901234567890"), Decimal("12345678901234567890"), "RUB", "css"),
    ("<p>по договоренности</p>", None, None, None, "text_fallback"),
    ("", None, None, None, "missing"),
]


def test_prices(spark):
    page = body(*[offer(100 + k, html) for k, (html, *_) in enumerate(PRICES)])
    got = catalog.catalog_items(catalog.catalog_pages(table(spark, ("/projects/", page)))).orderBy("pos").collect()
    for item, (_, low, high, currency, source) in zip(got, PRICES, strict=True):
        money = item.budget
        assert item.field_sources["budget"] == source
        assert (money and (money.amount_min, money.amount_max, money.currency)) in ((low, high, currency), None)
    assert got[4].budget.negotiable and got[3].budget.raw == "12345678901234567890 ₽"


def test_descriptions(spark):
    long_one, longer = "words of an offer, twenty and more", "even more words of an offer than the other has"
    page = body(
        offer(1, f'<div itemprop="description">{long_one}</div><p>{longer}</p>'),
        offer(2, f"<p>{long_one}</p><p>{longer}</p>"),
        offer(3, "<p>too short</p>"),
        offer(4, f"<p>{longer} Откликнуться</p>"),
    )
    got = catalog.catalog_items(catalog.catalog_pages(table(spark, ("/projects/", page)))).orderBy("pos").collect()
    assert [(i.description, i.field_sources["description"]) for i in got] == [
        (long_one, "css"), (longer, "text_fallback"), (None, "missing"), (None, "missing")]


def test_given_selectors(spark):
    page = body(offer(1, '<em class="cost">5 $</em><q>short note</q>'), offer(2, '<b class="price">6 $</b>'))
    own = catalog.Selectors(description=[dom.match("q")], price=[dom.match(cls="cost")], title=[dom.match("h5")])
    got = verbs.projects(table(spark, ("/projects/", page)), types=[], selectors=own).ok.orderBy("pos").collect()
    assert [(i.description, i.budget.amount_min, i.field_sources["budget"]) for i in got] == [("short note", 5, "css"), (None, 6, "text_fallback")]
    one = verbs.project_details(table(spark, ("/projects/1/", body("<h1>Not this</h1><h5>This</h5>"))), selectors=own).ok.first()
    assert one.title == "This"


def test_counters_beyond_an_int(spark):
    page = body(offer(1, "<p>5000000000 ответов, больше 70 просмотров</p>"), offer(9_000_000_000, words="Вакансия (Дом, Двор)"))
    a, b = catalog.catalog_items(catalog.catalog_pages(table(spark, ("/projects/", page)))).orderBy("pos").collect()
    assert a.responses_count == 5_000_000_000 and a.views_raw == "больше 70 просмотр"
    assert (b.id, b.location, b.kind) == (9_000_000_000, "Дом, Двор", "vacancy")


NEXT = [
    ("/projects/", '<a rel="next" href="?page=3">more</a>', f"{SITE}/projects/?page=3"),
    ("/projects/", '<a aria-label="Следующая" href="/projects/page-2/">></a>', f"{SITE}/projects/page-2/"),
    ("/projects/", '<a href="?page=12">12</a><a href="?page=2">2</a>', f"{SITE}/projects/?page=2"),
    ("/projects/page-1/", '<a href="/projects/page-22/">22</a>', None),
    ("/projects/?q=a", "", None),
]


def test_next_page(spark):
    got = catalog.catalog_pages(table(spark, *[(f"{p}{'&' if '?' in p else '?'}k={k}", body(offer(1), html)) for k, (p, html, _) in enumerate(NEXT)]))
    found = {int(r.url[-1]): r for r in got.collect()}
    for k, (_, _, want) in enumerate(NEXT):
        assert found[k].next_url == want and found[k].has_next == (want is not None)
    assert urls.page_number(F.lit("x/page-5000000000/")) is not None
    assert spark.range(1).select(urls.page_number(F.lit(f"{SITE}/page-5000000000/"))).first()[0] == 5_000_000_000


def test_pages_without_items(spark):
    got = by_path(catalog.catalog_pages(table(
        spark, ("/projects/?a", body("<p>По запросу ничего не найдено</p>"), 4), ("/projects/?b", body("<p>Hello</p>"), 4),
        ("/projects/?c", body('<p>Нет проектов</p><a rel=next href="?page=5">n</a>'), 4), ("/projects/?d", None, 4))))
    assert [(got[f"/projects/?{k}"].warnings, got[f"/projects/?{k}"].confidence) for k in "abcd"] == [
        (["catalog_end"], 0.8), ([], 0.2), ([], 0.2), ([], 0.2)]


# ---- the verbs on a table of many crawls -----------------------------------------------------------


def listing(path, number, ids, last, words="Заказ"):
    following = "" if last else f'<a rel="next" href="{path}page-{number + 1}/">n</a>'
    return path if number == 1 else f"{path}page-{number}/", body(*[offer(i, words=words) for i in ids], following), number


def two_categories(spark):
    """One listing of a single page, one of two, one with an unreadable page, one that only has vacancies."""
    root = "/projects/category/"
    return table(
        spark, listing(f"{root}dev/", 1, [1, 2], True), listing(f"{root}art/", 1, [3, 2], False), listing(f"{root}art/", 2, [4, 3], True),
        (f"{root}odd/", body("<p>nothing here</p>"), 1), (f"{root}odd/page-2/", body(offer(6, words="Заказ")), 2),
        listing(f"{root}jobs/", 1, [7], True, "Вакансия"), listing(f"{root}strange/", 1, [8], True, "Нечто"),
    )


def test_crawls_end_by_themselves(spark):
    pages = two_categories(spark)
    got = verbs.projects(pages)
    assert sorted((r.crawl.split("/")[-2], r.id) for r in got.ok.collect()) == [
        ("art", 2), ("art", 3), ("art", 4), ("dev", 1), ("dev", 2), ("odd", 6)]
    assert sorted((r.crawl.split("/")[-2], r.error.kind) for r in got.failed.collect()) == [("odd", "empty_page"), ("strange", "selector_drift")]
    with pytest.raises(RuntimeError, match="selector_drift|empty_page"):
        verbs.projects(pages, fail_fast=True)
    one = verbs.projects(pages.withColumn("job", F.lit("all")).filter(~F.col("url").contains("odd")), crawl_key="job")
    assert {r.crawl for r in one.ok.collect()} == {"all"}


def test_category_is_chosen_by_listing(spark):
    for asked in ("art", "/projects/category/art/", f"{SITE}/projects/category/art"):
        got = verbs.projects(two_categories(spark), category=asked)
        assert sorted(r.id for r in got.ok.collect()) == [2, 3, 4]
    assert verbs.projects(two_categories(spark), category="none").ok.count() == 0


def test_blocked_pages_are_reported(spark):
    pages = table(spark, ("/projects/", body(offer(1, words="Заказ"), '<div class="g-recaptcha"></div>')))
    got = verbs.projects(pages.withColumn("status_code", F.lit(403)))
    assert got.ok.count() == 0 and [r.error.kind for r in got.failed.collect()] == ["blocked"]


def test_people_crawls(spark):
    card = '<li class="row"><a href="/users/{0}/">{0}, Town</a><p>Сроки и цены</p></li>'
    pages = table(
        spark, ("/freelancers/", body(card.format("kim"), card.format("lee"), '<a rel=next href="/freelancers/page-2/">n</a>')),
        ("/freelancers/page-2/", body(card.format("kim"), card.format("ada")), 2), ("/freelancers/law/", body("<p>gone</p>")))
    got = verbs.freelancers(pages)
    assert sorted((r.username, r.name, r.location) for r in got.ok.collect()) == [("ada", "ada", "Town"), ("kim", "kim", "Town"), ("lee", "lee", "Town")]
    assert [(r.url, r.error.kind) for r in got.failed.collect()] == [(f"{SITE}/freelancers/law/", "empty_page")]


# ---- details -----------------------------------------------------------------------------------


def test_titles_in_order_of_trust(spark):
    ld = '<script type="application/ld+json">{"name": "From data"}</script>'
    og = '<meta property="og:title" content="From meta">'
    pages = table(
        spark, ("/projects/1/", f"<head>{og}{ld}</head>" + body("<h1>From heading</h1>")), ("/projects/2/", f"<head>{og}</head>" + body("<h1>From heading</h1>")),
        ("/projects/3/", f"<head>{og}</head>" + body("<p>x</p>")), ("/projects/4/", body("<p>x</p>")), ("/other/5/", body("<h1>y</h1>")))
    got = verbs.project_details(pages)
    assert {r.id: (r.title, r.field_sources["title"]) for r in got.ok.collect()} == {
        1: ("From data", "json_ld"), 2: ("From heading", "css"), 3: ("From meta", "open_graph")}
    assert sorted(r.error.kind for r in got.failed.collect()) == ["parse_error"] * 2
    with pytest.raises(RuntimeError, match="parse_error"):
        got.raise_for_errors()


def test_executors_and_customers(spark):
    """The executor is the first profile linked after the innermost element with the announcement."""
    def said(*parts):
        return body("<h1>T</h1>", '<a href="/users/owner/">O</a>', *parts)

    links = '<a href="/users/first/">1</a><a href="/users/second/">2</a>'
    pages = table(
        spark, ("/projects/1/", said("<div><p>Заказчик выбрал исполнителя</p></div>", links)),
        ("/projects/2/", said('<div><a href="/users/inside/">i</a> Заказчик выбрал исполнителя', links, "</div>")),
        ("/projects/3/", said(links)), ("/projects/4/", said("<p>заказчик <b>выбрал</b> исполнителя</p>", links)),
        ("/projects/5/", said("<ul><li>Заказчик выбрал исполнителя<li>", links, "<li>Заказчик выбрал исполнителя", '<a href="/users/third/">3</a></ul>')))
    got = {r.id: r for r in detail.detail_pages(pages).collect()}
    assert {i: r.executor and r.executor.username for i, r in got.items()} == {1: "first", 2: "inside", 3: None, 4: None, 5: "first"}
    assert {r.customer.username for r in got.values()} == {"owner"}


def test_breadcrumbs_dates_and_files(spark):
    pages = table(
        spark,
        ("/projects/1/", body('<ol class="site-breadcrumbs"><li><a href=/a>A</a><li><a href=/b>B</a></ol><h1>T</h1>'
                              "<p>Опубликовано 2 января 2025 в 23:05</p><p>Последнее изменение: 3 дня назад</p>"
                              "<a href='/f/plan.DOCX?v=2'>Plan</a><a href='/f/plan.html'>No</a>")),
        ("/projects/2/", body("<h1>T</h1>", *[f'<a href="/projects/category/c{k}/">C{k}</a>' for k in range(6)])))
    one, two = (r for _, r in sorted(by_path(detail.detail_pages(pages)).items()))
    assert (one.category, one.subcategory, [a.url for a in one.attachments]) == ("A", "B", [f"{SITE}/f/plan.DOCX?v=2"])
    assert (one.published_at, one.updated_at) == (datetime(2025, 1, 2, 20, 5), datetime(2025, 3, 7, 9))
    assert (two.category, two.subcategory, two.attachments) == ("C2", "C3", [])


# ---- profiles and people -------------------------------------------------------------------------


def test_profiles(spark):
    full = ("<head><title>Фрилансер Р. Орлов ID: 77 - профиль, Shop.example, Край (центр)</title></head>" + body(
        '<div class="b-profile"><h2>Орлов</h2></div><img src=/me.png class="big userpic">'
        "<p>Рейтинг 2 048,5</p><p>Отзывы + 6000000000 - 3</p><p>Все (4) Вакансии (1) Конкурсы (2)</p><p>На сайте 5 дней (заходил вчера)</p>"
        '<ul class="specialization-list"><li><a>Law</a><li><a>Art</a><li><a>Law</a></ul><i title="Верифицирован">v</i>'
        '<div class="opinion"><a href="/users/pat/">Pat</a> Отрицательный, но плюс за скорость</div><div class="opinion">ok</div>'
        '<ul class="portfolio"><li><a href="w/1">Work</a> 50 $<li><a href="w/1">again</a></ul>'))
    got = by_path(profile.profile_pages(table(spark, ("/users/orlov", full), ("/users/bare/", body("<p>-</p>"))), "Shop.example"))
    u = got["/users/orlov"]
    assert (u.username, u.user_id, u.role, u.location, u.name) == ("orlov", 77, "freelancer", "Край", "Орлов")
    assert (u.rating, u.reviews_positive, u.reviews_negative) == (Decimal("2048.5"), 6_000_000_000, 3)
    assert (u.projects_count, u.vacancies_count, u.contests_count, u.verified) == (4, 1, 2, True)
    assert (u.registered_raw, u.last_seen_raw, u.skills, u.avatar_url) == ("5 дней", "вчера", ["Law", "Art"], f"{SITE}/me.png")
    assert [(r.author.username, r.sentiment) for r in u.reviews] == [("pat", "negative")]
    assert [(w.title, w.price.amount_min) for w in u.portfolio] == [("Work", 50)]
    empty = got["/users/bare/"]
    assert (empty.username, empty.reviews, empty.portfolio, empty.verified, empty.rating) == ("bare", [], [], False, None)


def test_sections_over_pages(spark):
    opinion = '<div class="opinion">An opinion of number {}</div>'
    pages = table(spark, *[("/users/u/", body("<h1>U</h1>", *[opinion.format(k) for k in ks], offer(20 + n, words="Заказ")), n) for n, ks in ((1, [1, 2]), (2, [2, 3]), (3, [4]))])
    u = verbs.users(pages, "S", full=True, page_count=2).first()
    assert [r.text[-1] for r in u.reviews] == ["1", "2", "3"] and [p.id for p in u.projects] == [21, 22]
    with pytest.raises(ValueError):
        profile.with_sections(pages, True)


def test_people_cards(spark):
    page = body(
        '<div class="list"><div class="b-user-row"><a href="/users/mo/">Mo, Lake, East</a><p>Право: договоры</p><p>Опыт: два года</p>'
        '<p>Портфолио: 6 работ</p><p>31 отзыв</p><p>Рейтинг: 12,5</p><a href="/users/mo/portfolio/a/">A</a></div></div>',
        '<div class="b-user-row"><a href="/users/plain/">Plain</a><p>no sign of a card</p></div>',
        '<p><a href="/users/mo/orders/">not a person</a></p>')
    pages = people.people_pages(table(spark, ("/freelancers/", page)))
    assert pages.withColumn("s", quality.page_status()).first().s == "ok"
    [p] = people.people_items(pages).collect()
    assert (p.name, p.location, p.specialization, p.experience_raw) == ("Mo", "Lake, East", "Право: договоры", "два года")
    assert (p.portfolio_count, p.reviews_count, p.rating, [x.url for x in p.portfolio_links]) == (6, 31, Decimal("12.5"), [f"{SITE}/users/mo/portfolio/a/"])


# ---- any page ------------------------------------------------------------------------------------


def test_generic_fields(spark):
    head = ('<head><title> A  title </title><meta name=keywords content=k1><meta name=keywords content=k2><meta property="og:type" content=t>'
            '<link rel="alternate canonical" href="//cdn.example.net/c"></head>')
    page = head + body(
        "<h2>Two</h2><h1>One</h1>", "<p>First</p><p></p>", "<ol><li>a<li>b<ul><li>c</ul></ol>",
        "<table><tr><th>H<th>I<tr><td>1<td></table>", '<a href="#top">top</a><a href="b?c#d">rel</a><img data-src="/lazy.png" src="/real.png">')
    g = generic.generic_page(table(spark, ("/dir/page", page))).first()
    assert (g.title, [h.text for h in g.headings], g.paragraphs) == ("A title", ["Two", "One"], ["First"])
    assert g.metadata["og:type"] == "t" and set(g.metadata) == {"keywords", "og:type"}
    assert (g.tables[0].headers, g.tables[0].rows[0][0]) == (["H", "I"], "1")
    assert f"{SITE}/dir/b?c#d" in [x.url for x in g.links]


def tags(html):
    t = build_tree(html)
    return [f"{'.' * depth}{t.tag[i]}:{'|'.join(t.texts[t.s0[i]:t.s1[i]])}" for i in range(len(t.tag)) for depth in [_depth(t, i)]]


def _depth(t, i):
    depth = 0
    while t.parent[i] >= 0:
        i, depth = t.parent[i], depth + 1
    return depth


@pytest.mark.parametrize(("html", "want"), [
    ("<a href=/x/>T</a>", ["html:T", ".body:T", "..a:T"]),
    ("<a href=/x/ />T</a>", ["html:T", ".body:T", "..a:"]),
    ("<a href='/x/'/>T", ["html:T", ".body:T", "..a:"]),
    ("<a href=/x/ class=c>T</a>U", ["html:T|U", ".body:T|U", "..a:T"]),
    ("<dl><dt>a<dd>b<dt>c</dl>", ["html:a|b|c", ".body:a|b|c", "..dl:a|b|c", "...dt:a", "...dd:b", "...dt:c"]),
    ("<p>a<div>b</div>", ["html:a|b", ".body:a|b", "..p:a", "..div:b"]),
    ("<em>a<div>b</em>c</div>", ["html:a|b|c", ".body:a|b|c", "..em:a|b|c", "...div:b|c"]),
    ("x<!-- <p> --><style>p{}</style>&lt;", ["html:x|<", ".body:x|<", "..style:"]),
    ("", []),
])
def test_tree_recovery(html, want):
    assert tags(html) == want


def test_large_tables_and_lists_stay_linear():
    """The tokeniser itself: ten times the rows take about ten times as long."""
    import time

    def seconds(rows):
        html = body("<table>", "<tr><td>a<td>b" * rows, "</table>")
        start = time.perf_counter()
        assert build_tree(html).tag.count("td") == 2 * rows
        return time.perf_counter() - start

    seconds(500)
    assert seconds(20_000) < 40 * max(seconds(2_000), 0.005)


def test_structure_ignores_volatile_names(spark):
    rows = quality.structure(table(spark, ("/1", body('<i class="box z20240101">a</i>')), ("/2", body('<i class="z777777 box">b</i>')), ("/3", body("<b>a</b>")))).collect()
    prints = {r.url[-1]: r for r in rows}
    assert prints["1"].structural_fingerprint == prints["2"].structural_fingerprint != prints["3"].structural_fingerprint
    pair = spark.createDataFrame([(prints["1"].tokens, prints["3"].tokens)], "l array<string>, r array<string>")
    assert 0 < pair.select(jaccard(F.col("l"), F.col("r"))).first()[0] < 1


@pytest.mark.parametrize(("path", "html", "status", "want"), [
    ("/a", "<p>hcaptcha</p>", 429, "blocked"), ("/challenge", "", 200, "blocked"), ("/a", "cf-chl-x", 503, "blocked"),
    ("/a", "Войдите в аккаунт", 200, "auth_required"), ("/a", None, 403, "auth_required"), ("/a", "x", 408, "retryable"),
    ("/a", "x", 410, "http_error"), ("/a", "a story about robots", 200, "ok"),
])
def test_response_classes(spark, path, html, status, want):
    df = table(spark, (path, html)).withColumn("status_code", F.lit(status))
    assert df.select(quality.response_class(F.col("url"), F.col("html"), F.col("status_code"))).first()[0] == want


def test_blocked_input_stops_a_run(spark):
    df = table(spark, ("/a", "x")).withColumn("response_class", F.lit("blocked"))
    with pytest.raises(RuntimeError, match="/a"):
        quality.stop_if_blocked(df)
    quality.stop_if_blocked(df.filter("false"))


@pytest.mark.parametrize("names", ["7", ["order", ""], "unknown"])
def test_unknown_kinds_are_refused(names):
    with pytest.raises(ValueError, match="unknown type"):
        crawl.normalize_kinds(names)


def test_known_kinds():
    assert crawl.normalize_kinds((" Конкурсы", "VACANCY")) == {"contest", "vacancy"} and crawl.normalize_kinds(None) == set()
    assert crawl.page_limit("all") is None and crawl.page_limit(3) == crawl.start_of(3) == 3
    for wrong in (False, 0, 1.0, "3"):
        with pytest.raises(ValueError):
            crawl.page_limit(wrong)


def test_matches_below_matches(spark):
    df = dom.parse_html(table(spark, ("/", "<div class='k m'><span>1<b>2</b></span></div><span>3</span>")))
    spans = dom.select_within(F.col("nodes"), dom.match(cls="m"), dom.match("span"))
    assert df.select(F.transform(spans, lambda n: dom.text_of(F.col("texts"), n))).first()[0] == ["1 2"]
