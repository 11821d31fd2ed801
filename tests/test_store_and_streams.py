"""The keyed store, the stream of projects and the keyed change tracker."""

import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from pagelake.plans import verbs
from pagelake.sources import pages as sources
from pagelake.sources import state as st
from pagelake.sources import store as keyed
from pagelake.streaming import jobs, projects

SCHEMA = "id long, v string"


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def content(df):
    return {r.id: r.v for r in df.collect()}


# ---- store -------------------------------------------------------------------------------------


def test_last_batch_wins_and_replays_replace(spark, tmp_path):
    table = keyed.Store(spark, f"{tmp_path}/s").table("t", SCHEMA, "id")
    assert content(table.read()) == {} and table.lookup(rows(spark, (1, "x")).select("id")).first().v is None
    table.upsert(rows(spark, (1, "a"), (2, "a"), (None, "a")), 1)
    table.upsert(rows(spark, (2, "b"), (3, "b")), 2)
    assert content(table.read()) == {1: "a", 2: "b", 3: "b", None: "a"}
    table.upsert(rows(spark, (2, "c")), 2)
    assert content(table.read()) == {1: "a", 2: "c", None: "a"}
    assert content(table.read(before=2)) == {1: "a", 2: "a", None: "a"} and content(table.read(before=1)) == {}
    table.upsert(rows(spark), 3)
    assert content(table.read()) == {1: "a", 2: "c", None: "a"}


def test_random_batches_equal_a_dictionary(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "BUCKET_ROWS", 5)
    rng, table, plain = random.Random(3), keyed.Store(spark, f"{tmp_path}/s").table("t", SCHEMA, "id"), {}
    for batch in range(6):
        new = {rng.randrange(60): f"{batch}-{k}" for k in range(rng.choice([3, 40]))}
        table.upsert(rows(spark, *new.items()), batch)
        plain |= new
        if batch == 3:
            table.compact()
        asked = rng.sample(range(60), 4)
        keys = spark.createDataFrame([(i,) for i in asked], "id long")
        assert content(table.read()) == plain
        assert content(table.lookup(keys)) == {i: plain.get(i) for i in asked}
        assert sorted(r.id for r in table.contains(keys).collect()) == sorted(i for i in asked if i in plain)
    assert len(table.folders()) == 4 and max(f.buckets for f in table.folders()) > 1


def test_lookups_read_only_buckets_that_hold_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "BUCKET_ROWS", 10)
    table = keyed.Store(spark, f"{tmp_path}/s").table("t", SCHEMA, "id")
    table.upsert(spark.range(600).selectExpr("id", "'a' AS v"), 1)
    assert table.folders()[0].buckets == 64
    keys = spark.createDataFrame([(7,), (8,)], "id long")
    found = table._current(table.folders(), table._touched(keys, table.folders()))
    assert "PartitionFilters: [isnotnull(bucket" in found._jdf.queryExecution().executedPlan().toString().replace("isnotnull(buckets", "isnotnull(bucket")
    read = {r.f for r in found.select(F.input_file_name().alias("f")).distinct().collect()}
    assert 1 <= len(read) <= 2 and content(found).keys() >= {7, 8}


def test_a_batch_is_visible_in_all_tables_or_in_none(spark, tmp_path):
    store = keyed.Store(spark, f"{tmp_path}/s")
    one, two = store.table("one", SCHEMA, "id"), store.table("two", SCHEMA, "id")
    store.commit(1, {one: rows(spark, (1, "a")), two: rows(spark, (1, "a"))})
    failing = rows(spark, (1, "b")).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        store.commit(2, {one: rows(spark, (1, "b"), (2, "b")), two: failing})
    assert content(one.read()) == {1: "a"} == content(two.read())
    store.commit(2, {one: rows(spark, (1, "b")), two: rows(spark, (1, "b"))})
    assert content(one.read()) == {1: "b"} == content(two.read())


def test_two_writers_cannot_take_one_version(spark, tmp_path):
    store = keyed.Store(spark, f"{tmp_path}/s")
    one, two = store.table("one", SCHEMA, "id"), store.table("two", SCHEMA, "id")
    one.upsert(rows(spark, (1, "a")), 1)
    old = store.manifest()
    two.upsert(rows(spark, (1, "b")), 1)
    with pytest.raises(keyed.CommitConflict):
        store._publish(keyed.Manifest(old.version + 1, {}))
    real, calls = store.manifest, []
    # The second writer reads the manifest before the first has published, then meets its version and tries again.
    store.manifest = lambda version=None: (calls.append(1), old if len(calls) == 1 else real(version))[1]
    one.upsert(rows(spark, (2, "c")), 2)
    store.manifest = real
    assert len(calls) == 2 and content(one.read()) == {1: "a", 2: "c"} and content(two.read()) == {1: "b"}


def test_vacuum_keeps_what_recent_manifests_name(spark, tmp_path):
    store = keyed.Store(spark, f"{tmp_path}/s")
    table = store.table("t", SCHEMA, "id")
    for batch in range(4):
        table.upsert(rows(spark, (batch, "a")), batch)
    under_way = table.read()
    table.compact()
    assert len(table.folders()) == 2 and content(under_way) == content(table.read()) == dict.fromkeys(range(4), "a")
    assert store.vacuum(keep=2) == []
    table.upsert(rows(spark, (9, "b")), 4)
    assert len(store.vacuum(keep=2)) == 3 and content(table.read()) == {**dict.fromkeys(range(4), "a"), 9: "b"}
    assert store.manifest().version == 6 and len(store._versions()) == 2


def test_state_and_checkpoints_of_one_folder_share_commits(spark, tmp_path):
    state, marks = st.state_table(spark, f"{tmp_path}/s"), st.checkpoint_table(spark, f"{tmp_path}/s")
    verbs.new_projects(listing(spark, "a", 3), state, marks, batch=1)
    assert state.store.manifest().version == 1
    first = {r.id for r in state.read().collect()}
    again = verbs.new_projects(listing(spark, "a", 3), state, marks, batch=1)
    assert {r.id for r in again.ok.collect()} == first and state.store.manifest().version == 2


def test_an_unreadable_page_is_asked_for_again(spark, tmp_path):
    state, marks = st.state_table(spark, f"{tmp_path}/s"), st.checkpoint_table(spark, f"{tmp_path}/s")
    first = verbs.new_projects(listing(spark, "a", 4, bad=(3,)), state, marks, batch=1, types=[])
    assert {r.page for r in first.ok.collect()} == {1, 2} and [(r.page, r.error.kind) for r in first.failed.collect()] == [(3, "empty_page")]
    assert marks.read().first().next_page == 3
    second = verbs.new_projects(listing(spark, "a", 4), state, marks, batch=2, types=[])
    assert {r.page for r in second.ok.collect()} == {3, 4} and second.failed.count() == 0
    assert {r.id for r in state.read().collect()} == set(range(100, 117))


# ---- stream of projects -------------------------------------------------------------------------


def listing(spark, name, pages, bad=(), shift=0):
    def card(i, p):
        kind = "Вакансия" if i % 5 == 4 else "Заказ"
        return f'<article class="project-card"><h2><a href="/projects/{i}/x.html">Item {i}</a></h2><div>{kind}, {p} ответов</div><b>{i} 000 руб</b></article>'

    made = []
    for p in range(1, pages + 1):
        # The last id of a page comes again on the next one, with another text.
        ids = range(shift + 100 + (p - 1) * 4, shift + 100 + p * 4 + 1)
        nxt = f'<a rel="next" href="/projects/{name}/page-{p + 1}/">n</a>' if p < pages else ""
        body = "<div>Just a moment... Checking your browser. cf-browser-verification captcha</div>" if p in bad else "".join(card(i, p) for i in ids)
        suffix = "" if p == 1 else f"page-{p}/"
        made.append((f"https://m.example.org/projects/{name}/{suffix}", p, f"<body><main>{body}{nxt}</main></body>"))
    return spark.createDataFrame(made, "url string, page int, html string").withColumn("fetched_at", F.lit("2026-07-25 12:00:00").cast("timestamp"))


def arrive(df, path, order):
    for some in order:
        df.join(df.sparkSession.createDataFrame(some, "name string, page int").select(
            F.col("page").alias("p"), F.concat(F.lit("/"), "name", F.lit("/")).alias("n")),
            (F.col("page") == F.col("p")) & F.col("url").contains(F.col("n"))).drop("p", "n").coalesce(1).write.mode("append").parquet(path)


PAGE = "url string, page int, html string, fetched_at timestamp"


def run(spark, folder, checkpoint="ck", **options):
    stream = sources.stream_pages(spark, f"{folder}/in", PAGE, 1)
    projects.stream_projects(stream, f"{folder}/out", f"{folder}/{checkpoint}", once=True, **options).awaitTermination(300)
    return projects.stream_results(spark, f"{folder}/out")


def essence(df):
    return sorted((r.crawl, r.page, r.pos, r.id, r.title, r.kind) for r in df.collect())


def test_stream_of_projects_equals_the_batch_verb(spark, tmp_path):
    # c goes on after its end, and lacks a page that all later ones wait for.
    pages = listing(spark, "a", 4, bad=(2,)).unionByName(listing(spark, "b", 3, shift=500)).unionByName(listing(spark, "c", 2))
    order = [[("a", 3), ("b", 1)], [("a", 1), ("c", 2)], [("b", 3)], [("a", 2), ("b", 2), ("c", 1), ("a", 4)], [("a", 1)]]
    arrive(pages, f"{tmp_path}/in", order)
    got = run(spark, tmp_path, types=["order", "vacancy"], min_budget=101_000)
    want = verbs.projects(pages, types=["order", "vacancy"], min_budget=101_000)
    assert essence(got.ok) == essence(want.ok) and got.ok.count() > 15
    assert sorted((r.crawl, r.page, r.error.kind) for r in got.failed.collect()) == sorted((r.crawl, r.page, r.error.kind) for r in want.failed.collect())
    states = {r.crawl.rsplit("/", 2)[-2]: r for r in projects.crawl_states(st.Store(spark, f"{tmp_path}/out")).read().collect()}
    assert [(states[k].next_page, states[k].ended, len(states[k].waiting)) for k in "abc"] == [(5, True, 0), (4, True, 0), (3, True, 0)]


def test_stream_of_projects_waits_for_missing_pages_and_survives_replay(spark, tmp_path):
    pages = listing(spark, "a", 4)
    arrive(pages, f"{tmp_path}/in", [[("a", 1)], [("a", 3)]])
    first = run(spark, tmp_path)
    assert {r.page for r in first.ok.collect()} == {1}
    # A batch that is run again, as after a lost commit of the stream, changes nothing.
    store = st.Store(spark, f"{tmp_path}/out")
    before = essence(first.ok), store.manifest().version
    newest = max(int(n) for n in os.listdir(f"{tmp_path}/ck/commits") if n.isdigit())
    lost = shutil.ignore_patterns(str(newest), f".{newest}.crc")
    shutil.copytree(f"{tmp_path}/ck", f"{tmp_path}/ck2", ignore=lambda at, names: lost(at, names) if at.endswith("commits") else set())
    again = run(spark, tmp_path, "ck2")
    assert essence(again.ok) == before[0] and store.manifest().version > before[1]
    arrive(pages, f"{tmp_path}/in", [[("a", 2)]])
    assert {r.page for r in run(spark, tmp_path, "ck2").ok.collect()} == {1, 2, 3}


def test_patience_gives_up_missing_pages(spark, tmp_path):
    pages = listing(spark, "a", 6)
    arrive(pages, f"{tmp_path}/in", [[("a", 1)], [("a", 3)], [("a", 4)], [("a", 5)], [("a", 6)]])
    got = run(spark, tmp_path, patience=2)
    assert {r.page for r in got.ok.collect()} == {1, 3, 4, 5, 6}


# ---- verbs per user and page ---------------------------------------------------------------------


def profile_page(name, page, ids):
    body = "".join(
        f'<section class="review"><a href="/users/s-1/">A</a><p>Положительный отзыв номер {i}</p></section>'
        f'<div class="portfolio"><a href="/users/{name}/portfolio/{i}/">Work {i}</a></div>'
        f'<article class="project-card"><h2><a href="/projects/{i}/x.html">Item {i} of page {page}</a></h2></article>' for i in ids)
    return f"https://m.example.org/users/{name}/" if name else "https://m.example.org/about/", page, f"<title>T</title><body><main><h1>N</h1>{body}</main></body>"


def test_sections_of_users_and_their_failures(spark):
    pages = spark.createDataFrame([profile_page("u", 1, [1, 2]), profile_page("u", 2, [2, 3]), profile_page("v", 1, [9]), profile_page("", 1, [5])], "url string, page int, html string")
    owned = verbs.user_projects(pages)
    assert sorted((r.username, r.id, r.title) for r in owned.ok.collect()) == [
        ("u", 1, "Item 1 of page 1"), ("u", 2, "Item 2 of page 2"), ("u", 3, "Item 3 of page 2"), ("v", 9, "Item 9 of page 1")]
    assert [(r.page, r.error.kind) for r in owned.failed.collect()] == [(1, "parse_error")]
    assert sorted((r.username, r.page) for r in verbs.user_reviews(pages).ok.collect()) == [("u", 1), ("u", 1), ("u", 2), ("v", 1)]
    assert sorted((r.username, r.title) for r in verbs.user_portfolio(pages, page_count=1).ok.collect()) == [("u", "Work 1"), ("u", "Work 2"), ("v", "Work 9")]
    found = verbs.users_result(pages, "S")
    assert sorted(r.username for r in found.ok.collect()) == ["u", "v"] and found.failed.first().error.message.startswith("no user")


def test_pages_that_cannot_be_read_and_categories_of_crawls(spark):
    link = '<a href="/projects/category/{}/">{}</a>'
    pages = spark.createDataFrame([
        ("https://e.org/captcha", "a", 1, "<p>x"), ("https://e.org/2", "a", 2, "<div></div>"),
        ("https://e.org/3", "a", 3, link.format("x", "X")), ("https://e.org/4", "b", 1, link.format("x", "Again") + link.format("y", "Y"))],
        "url string, site string, page int, html string")
    found = verbs.page_result(pages)
    assert sorted((r.url[-1], r.error.kind) for r in found.failed.collect()) == [("2", "empty_page"), ("a", "blocked")] and found.ok.count() == 2
    by_crawl = verbs.categories(pages, crawl_key="site").collect()
    assert sorted((r.crawl, r.slug, r.name) for r in by_crawl) == [("a", "x", "X"), ("b", "x", "Again"), ("b", "y", "Y")]
    assert sorted((r.slug, r.name) for r in verbs.categories(pages.drop("page").filter("site = 'b'")).collect()) == [("x", "Again"), ("y", "Y")]


# ---- keyed change tracker -----------------------------------------------------------------------


def test_tracked_changes_equal_a_walk(spark, tmp_path):
    jobs.keyed_state(spark)
    rng, walk, want = random.Random(5), {}, []
    schema = "id long, page int, pos int, content_hash string, fetched_at timestamp"
    for day in range(1, 6):
        found = [(i, 1, i, rng.choice("xy"), f"2026-07-{day * 3:02d} 10:00:00") for i in rng.sample(range(12), 7)]
        for i, _, _, h, at in found:
            before = walk.get(i)
            if before != h:
                want.append((i, "new" if before is None else "changed", h, before))
            walk[i] = h
        spark.createDataFrame([(*r[:4], r[4]) for r in found], "id long, page int, pos int, content_hash string, at string").select(
            "id", "page", "pos", "content_hash", F.col("at").cast("timestamp").alias("fetched_at")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

        def step():
            stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
            changes = jobs.track_changes(stream, keep_seconds=400 * 86_400)
            writer = changes.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck")
            writer.trigger(availableNow=True).start().awaitTermination(300)

        if day in (2, 5):  # restarts in between
            step()
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted(((r.id, r.change, r.content_hash, r.previous_hash) for r in got), key=repr) == sorted(want, key=repr)
