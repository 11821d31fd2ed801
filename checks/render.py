"""HTML of a marketplace rendered by Spark from the given tables, so extraction can be checked.

One catalog item and one detail page per order, one profile per customer, one people card per
supplier.  The SQL that checks a query never sees this HTML.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.constants import MONTHS_GENITIVE
from pagelake.session import configure

BASE = "https://market.example.org"
FETCHED_AT = "2026-07-25 12:00:00"
ITEM_OFFSET = 5_500_000
PER_PAGE = 30
NBSP = " "


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame) -> DataFrame:
    """Rendered pages leave joins and groups in a few partitions; deal them to all cores, as files of a page table would be."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def together(df: DataFrame, *keys: str) -> DataFrame:
    """Bring the rows of a page together while they are still columns of the tables, a fraction of their markup.

    What is rendered and grouped by the same keys afterwards stays where it is, in enough parts for all cores.
    """
    spark = df.sparkSession
    parts = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(parts, *keys)


def fetched_at() -> Column:
    return F.lit(FETCHED_AT).cast("timestamp")


def grouped(number: Column) -> Column:
    """Whole number with its thousands set apart by no-break spaces."""
    return F.replace(F.format_number(number, 0), F.lit(","), F.lit(NBSP))


def amount(price: Column) -> Column:
    return F.floor(price + 0.5).cast("long")


def price_text(key: Column, price: Column) -> Column:
    whole = amount(price)
    return (
        F.when(key % 4 == 0, F.concat(F.lit("от "), grouped(whole), F.lit(" ₽")))
        .when(key % 4 == 1, F.concat(grouped(whole), F.lit(" ₽ – "), grouped(whole * 2), F.lit(" ₽")))
        .when(key % 4 == 2, F.concat(grouped(whole), F.lit(" $")))
        .otherwise("по договоренности")
    )


def date_text(date: Column) -> Column:
    months = F.array(*[F.lit(m) for m in MONTHS_GENITIVE])
    return F.concat_ws(" ", F.dayofmonth(date).cast("string"), F.get(months, F.month(date) - 1), F.year(date).cast("string"))


def kind_text(priority: Column, place: Column) -> Column:
    digit = F.substring(priority, 1, 1)
    return (
        F.when(digit == "5", "Конкурс")
        .when(digit == "4", F.concat(F.lit("Вакансия ("), place, F.lit(")")))
        .otherwise("Заказ")
    )


def orders_with_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("place")
    )
    people = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey"
    ).join(nation, "c_nationkey")
    return table(spark, sf_dir, "orders").join(people, "o_custkey")


def listing_page_url(page: Column) -> Column:
    return F.when(page == 1, f"{BASE}/projects/").otherwise(
        F.concat(F.lit(f"{BASE}/projects/page-"), page.cast("string"), F.lit("/"))
    )


def item_html() -> Column:
    key = F.col("o_orderkey")
    ident = (key + ITEM_OFFSET).cast("string")
    status = F.when(F.col("o_orderstatus") == "F", "<div>Заказ закрыт</div>").when(
        F.col("o_orderstatus") == "O", "<div>Откликнуться</div>"
    ).otherwise("")
    kind = kind_text(F.col("o_orderpriority"), F.col("place"))
    # "Заказ закрыт" must not turn a vacancy into an order: vacancy and contest words win anyway.
    return F.concat(
        F.lit('<article class="project-card"><h2><a href="/projects/'), ident,
        F.lit('/item.html">Item &amp; order '), key.cast("string"), F.lit("</a></h2>"),
        F.lit('<div class="project-price">'), price_text(key, F.col("o_totalprice")), F.lit("</div>"),
        F.lit('<p class="project-description">Work of '), F.col("c_name"), F.lit(" with priority "),
        F.col("o_orderpriority"), F.lit("</p>"),
        F.lit('<a href="/users/c-'), F.col("o_custkey").cast("string"), F.lit('/">'), F.col("c_name"), F.lit(" &amp; Co</a>"),
        F.lit("<div>"), kind, F.lit(" "), date_text(F.col("o_orderdate")), F.lit(", 12:30</div>"),
        status,
        F.lit("<div>"), (key % 50).cast("string"), F.lit(" ответов</div></article>"),
    )


def last_catalog_page(spark: SparkSession, sf_dir: str) -> int:
    top = table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0]
    return top // PER_PAGE + 1


def catalog_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages: ``page, url, html, fetched_at``."""
    orders = orders_with_people(spark, sf_dir)
    # Items fill pages 1..last, every 97th item reaches one page further; two kinds of pages follow.
    last_page = last_catalog_page(spark, sf_dir)
    drift_pages = last_page // 500 + 1
    end_page = last_page + 2 + drift_pages

    page = (F.floor(F.col("o_orderkey") / PER_PAGE) + 1).cast("int")
    pos = (F.col("o_orderkey") % PER_PAGE).cast("int")
    own = F.struct(page.alias("page"), pos.alias("pos"))
    # Every 97th item shows up again at the end of the following page.
    again = F.struct((page + 1).alias("page"), (pos + PER_PAGE).alias("pos"))
    spots = F.when(F.col("o_orderkey") % 97 == 0, F.array(own, again)).otherwise(F.array(own))
    placed = orders.select("*", F.explode(spots).alias("spot")).select("*", F.col("spot.page").alias("page"), F.col("spot.pos").alias("pos"))
    cards = together(placed.drop("spot"), "page").select("page", "pos", item_html().alias("card"))
    # At most two times PER_PAGE cards meet on a page, so the array is bounded.
    full = cards.groupBy("page").agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("pos", "card"))),
                lambda c: c["card"],
            ),
            "",
        ).alias("body")
    )
    # One extra page per 500 has links without text (drift), and the final page ends the catalog.
    drift = spark.range(1, drift_pages + 1).select(
        (F.col("id") + last_page + 1).cast("int").alias("page"),
        F.concat(
            F.lit('<article class="project-card"><h2><a href="/projects/'), F.col("id").cast("string"),
            F.lit('/x.html"></a></h2></article>'),
        ).alias("body"),
    )
    end = spark.range(1).select(
        F.lit(end_page).alias("page"), F.lit("<div>Ничего не найдено</div>").alias("body")
    )
    bodies = full.unionByName(drift).unionByName(end)
    link = F.when(
        F.col("page") < end_page,
        F.concat(
            F.lit('<a rel="next" href="/projects/page-'), (F.col("page") + 1).cast("string"),
            F.lit('/">Следующая</a>'),
        ),
    ).otherwise("")
    return bodies.select(
        "page",
        listing_page_url(F.col("page")).alias("url"),
        F.concat(
            F.lit('<!doctype html><html><head><meta charset="utf-8"><title>Catalog</title></head><body><main id="projects-list">'),
            F.col("body"), link, F.lit("</main></body></html>"),
        ).alias("html"),
        fetched_at().alias("fetched_at"),
    )


def detail_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail pages: ``url, html, fetched_at``; items with an id divisible by 101 have none."""
    key = F.col("o_orderkey")
    ident = (key + ITEM_OFFSET).cast("string")
    body = F.concat(
        F.lit('<!doctype html><html><head><title>Item '), key.cast("string"),
        F.lit(': page</title><meta property="og:title" content="Item &amp; order">'),
        F.when(key % 10 == 0, F.concat(F.lit('<script type="application/ld+json">{"@type":"Thing","name":"Named '), key.cast("string"), F.lit('"}</script>'))).otherwise(""),
        F.lit('</head><body><main><nav class="breadcrumb"><a href="/projects/">All</a><a href="/projects/category/'),
        F.lower("o_orderstatus"), F.lit('/">Status '), F.col("o_orderstatus"),
        F.lit('</a><a href="/projects/category/'), F.lower("o_orderstatus"), F.lit("/"), F.substring("o_orderpriority", 1, 1),
        F.lit('/">Priority '), F.col("o_orderpriority"), F.lit("</a></nav>"),
        F.when(key % 10 == 1, "").otherwise(F.concat(F.lit("<h1>Item "), key.cast("string"), F.lit("</h1>"))),
        F.lit("<div>Бюджет: "), price_text(key, F.col("o_totalprice")), F.lit("</div>"),
        F.lit('<a href="/users/c-'), F.col("o_custkey").cast("string"), F.lit('/">'), F.col("c_name"), F.lit("</a>"),
        F.lit("<div itemprop=description>Details of order "), key.cast("string"), F.lit(" for <b>"), F.col("c_name"), F.lit("</b></div>"),
        F.when(key % 3 == 0, F.concat(F.lit('<div>Заказчик выбрал исполнителя: <a href="/users/s-'), (key % 100).cast("string"), F.lit('/">Worker</a></div>'))).otherwise(""),
        F.when(key % 2 == 0, F.concat(F.lit('<a href="/files/'), key.cast("string"), F.lit('.pdf">Spec</a>'))).otherwise(""),
        F.lit("<p>Опубликован "), date_text(F.col("o_orderdate")), F.lit(" в 12:30</p><p>Последнее изменение: "),
        date_text(F.col("o_orderdate")), F.lit(" в 13:10</p><div>"), (key % 50).cast("string"), F.lit(" ответов</div></main></body></html>"),
    )
    return dealt(orders_with_people(spark, sf_dir).filter((key + ITEM_OFFSET) % 101 != 0)).select(
        F.concat(F.lit(f"{BASE}/projects/"), ident, F.lit("/item.html")).alias("url"),
        body.alias("html"), fetched_at().alias("fetched_at"),
    )


def section_page(key: Column) -> Column:
    """The page of a user's sections an order is shown on."""
    return (key % 3 + 1).cast("int")


def profile_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile pages: three per customer (the profile and two further section pages).

    Every order of the customer is one review, one portfolio link and one project card on the page
    ``o_orderkey % 3 + 1``; orders divisible by 5 are repeated, unchanged, on the next page.
    """
    orders = orders_with_people(spark, sf_dir)
    key = F.col("o_orderkey")
    text_ = key.cast("string")
    mood = F.when(key % 4 == 0, "Положительный отзыв").when(key % 4 == 1, "Отрицательный отзыв").otherwise("Просто отзыв")
    review = F.concat(
        F.lit('<section class="review"><a href="/users/s-'), (key % 100).cast("string"), F.lit('/">Author</a><p>'), mood,
        F.lit(" о заказе "), text_, F.lit("</p></section>"),
    )
    work = F.concat(
        F.lit('<div class="portfolio"><a href="/users/c-'), F.col("o_custkey").cast("string"), F.lit("/portfolio/item-"), text_,
        F.lit('/">Work '), text_, F.lit('</a><img src="/i/'), text_, F.lit('.jpg"> '), amount(F.col("o_totalprice")).cast("string"), F.lit(" ₽</div>"),
    )
    page = section_page(key)
    spots = F.when((key % 5 == 0) & (page < 3), F.array(page, page + 1)).otherwise(F.array(page))
    placed = together(orders.select("*", F.explode(spots).alias("page")), "o_custkey", "page")
    blocks = placed.select("o_custkey", "page", key.alias("k"), F.concat(review, work, item_html()).alias("block"))
    # The arrays hold the orders of one rendered page of one customer.
    sections = blocks.groupBy("o_custkey", "page").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "block"))), lambda b: b["block"]), "").alias("body"),
    )
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("place"))
    people = table(spark, sf_dir, "customer").join(nation, "c_nationkey").withColumn(
        "page", F.explode(F.array(*[F.lit(i) for i in (1, 2, 3)]))
    )
    role = F.when(F.col("c_custkey") % 2 == 0, "Заказчик").otherwise("Фрилансер")
    cust = F.col("c_custkey").cast("string")
    joined = together(people, "c_custkey", "page").join(sections.withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey", "page"], "left")
    html = F.concat(
        F.lit("<!doctype html><html><head><title>"), role, F.lit(" "), F.col("c_name"), F.lit(" ID:"), cust,
        F.lit(" - работа, Market.example, "), F.col("place"),
        F.lit('</title><meta name="description" content="Profile"></head><body><main><h1>'), F.col("c_name"),
        F.lit('</h1><img class="avatar" src="/a/'), cust, F.lit('.jpg"><div>На сайте '), (F.col("c_custkey") % 20).cast("string"),
        F.lit(" лет (заходил 2 часа назад)</div><div>+ "), (F.col("c_custkey") % 30).cast("string"), F.lit(" - "), (F.col("c_custkey") % 7).cast("string"),
        F.lit("</div><div>Рейтинг "), F.round(F.abs("c_acctbal"), 2).cast("decimal(12,2)").cast("string"),
        F.lit("</div><div>Безопасные сделки "), (F.col("c_custkey") % 9).cast("string"),
        F.lit("</div><div>Все ("), (F.col("c_custkey") % 11).cast("string"), F.lit(") Вакансии ("), (F.col("c_custkey") % 3).cast("string"),
        F.lit(") Конкурсы (0)</div>"),
        F.when(F.col("c_custkey") % 6 == 0, '<span class="badge-verified"></span>').otherwise(""),
        F.lit('<section class="about">About '), F.col("c_mktsegment"), F.lit('</section><div class="skill"><a href="/freelancers/a/">'),
        F.col("c_mktsegment"), F.lit('</a><a href="/freelancers/b/">Spark</a><a href="/freelancers/a/">'), F.col("c_mktsegment"), F.lit("</a></div>"),
        F.coalesce("body", F.lit("")), F.lit("</main></body></html>"),
    )
    return joined.select(
        F.concat(F.lit(f"{BASE}/users/c-"), cust, F.lit("/")).alias("url"), "page", html.alias("html"), fetched_at().alias("fetched_at")
    )


def people_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """People listing pages: ``page, url, html, fetched_at``; thirty suppliers per page."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("place"))
    suppliers = table(spark, sf_dir, "supplier").join(nation, "s_nationkey")
    last = table(spark, sf_dir, "supplier").agg(F.max("s_suppkey")).first()[0] // PER_PAGE + 1
    key = F.col("s_suppkey")
    ident = key.cast("string")
    name = F.when(key % 3 == 0, F.col("s_name")).otherwise(F.concat_ws(", ", "s_name", "place"))
    card = F.concat(
        F.lit('<article class="freelancer-card"><a href="/users/s-'), ident, F.lit('/">'), name, F.lit("</a>"),
        F.when(key % 2 == 0, F.concat(F.lit('<img src="/a/'), ident, F.lit('.jpg">'))).otherwise(""),
        F.lit("<div>Программирование: Spark</div><div>Опыт: "), (key % 20).cast("string"), F.lit(" лет</div><div>Портфолио: "),
        (key % 90).cast("string"), F.lit(" работ</div><div>"), (key % 40).cast("string"), F.lit(" отзывов</div>"),
        F.lit("<div>Рейтинг: "), F.abs("s_acctbal").cast("decimal(12,2)").cast("string"), F.lit("</div>"),
        F.lit('<a href="/users/s-'), ident, F.lit('/portfolio/p-'), ident, F.lit('/">Work</a></article>'),
    )
    page = (F.floor(key / PER_PAGE) + 1).cast("int")
    # Every seventh person is listed again on the next page.
    spots = F.when(
        (key % 7 == 0) & (page < last), F.array(F.struct(page.alias("page"), key.alias("k")), F.struct((page + 1).alias("page"), key.alias("k")))
    ).otherwise(F.array(F.struct(page.alias("page"), key.alias("k"))))
    bodies = suppliers.select(F.explode(spots).alias("s"), card.alias("card")).groupBy(F.col("s.page").alias("page")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s.k", "card"))), lambda c: c["card"]), "").alias("body")
    )
    end = spark.range(1).select(F.lit(last + 1).alias("page"), F.lit("<p>no one</p>").alias("body"))
    link = F.when(F.col("page") < last + 1, F.concat(F.lit('<a rel="next" href="/freelancers/page-'), (F.col("page") + 1).cast("string"), F.lit('/">Next</a>'))).otherwise("")
    return dealt(bodies.unionByName(end)).select(
        "page",
        F.when(F.col("page") == 1, f"{BASE}/freelancers/").otherwise(F.concat(F.lit(f"{BASE}/freelancers/page-"), F.col("page").cast("string"), F.lit("/"))).alias("url"),
        F.concat(F.lit("<!doctype html><html><head><title>People</title></head><body><main>"), "body", link, F.lit("</main></body></html>")).alias("html"),
        fetched_at().alias("fetched_at"),
    )


def category_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of category links, one page per brand: ``url, html``."""
    part = table(spark, sf_dir, "part").select("p_brand", "p_type").distinct()
    slug = F.lower("p_type")
    link = F.concat(
        F.lit('<li><a href="/projects/category/'), slug, F.lit('/">'), F.col("p_type"), F.lit('</a></li><li><a href="/projects/category/'),
        slug, F.lit('/sub/">'), F.col("p_type"), F.lit(" sub</a></li>"),
    )
    return part.groupBy("p_brand").agg(F.array_join(F.sort_array(F.collect_list(link)), "").alias("body")).select(
        F.concat(F.lit(f"{BASE}/projects/?brand="), F.substring_index("p_brand", "#", -1)).alias("url"),
        F.concat(F.lit("<html><body><ul>"), "body", F.lit("</ul></body></html>")).alias("html"),
    )
