"""Ordered operators, incremental scans, state tables, streams."""

import random

import pytest
from pyspark.sql import functions as F

from pagelake.operators import catalog, crawl, incremental, metrics, robots
from pagelake.operators.runs import cut_points, previous_value, running_total
from pagelake.plans import verbs
from pagelake.session import ensure_checkpoint_dir
from pagelake.sources import pages as sources
from pagelake.sources import state as st
from pagelake.streaming import jobs


@pytest.mark.parametrize("slices", [1, 3, 7])
def test_running_total_equals_a_sequential_walk(spark, slices):
    rng = random.Random(slices)
    # One key holds most rows, so it spans every slice.
    rows = [("hot" if i % 3 else f"k{i % 5}", i, rng.random() < 0.7) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, at int, ok boolean")
    got = running_total(
        df, ["k"], ["at"], F.col("ok").cast("long"), ~F.col("ok"), "n",
        initial=F.when(F.col("k") == "hot", 5).otherwise(0), cuts=cut_points(df, "at", slices),
    )
    expected, run = {}, {"hot": 5}
    for k, at, ok in rows:
        run[k] = run.get(k, 0) + 1 if ok else 0
        expected[at] = run[k]
    assert {r.at: r.n for r in got.collect()} == expected


@pytest.mark.parametrize("slices", [1, 4])
def test_previous_value(spark, slices):
    rows = [("a" if i % 2 else "b", i, None if i % 7 == 0 else str(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, at int, v string")
    got = {r.at: r.p for r in previous_value(df, ["k"], ["at"], "v", "p", cut_points(df, "at", slices)).collect()}
    last, expected = {}, {}
    for k, at, v in rows:
        expected[at] = last.get(k)
        last[k] = v
    assert got == expected


def walk(crawl_rows, stored, stop_after, streak):
    """The sequential rule: one item at a time, stop after so many known ones in a row."""
    seen, emitted = [], []
    stored = dict(stored)
    for page, pos, ident, digest in crawl_rows:
        known = stored.get(ident) == digest
        streak = streak + 1 if known else 0
        seen.append((page, pos))
        if not known:
            emitted.append((page, pos))
        stored[ident] = digest
        if streak >= stop_after:
            return seen, emitted, page, streak
    return seen, emitted, None, streak


@pytest.mark.parametrize("seed", range(4))
def test_incremental_scan_equals_a_sequential_walk(spark, seed):
    rng = random.Random(seed)
    rows = [(p, q, rng.randrange(60), rng.choice("xxxy")) for p in range(1, 9) for q in range(12)]
    rows = [r for i, r in enumerate(rows) if (r[0], r[2]) not in {(x[0], x[2]) for x in rows[:i]}]
    stored = {i: "x" for i in range(60) if rng.random() < 0.85}
    stop_after, streak = rng.choice([3, 6, 500]), rng.choice([0, 2])
    items = spark.createDataFrame([("n", *r) for r in rows], "namespace string, page int, pos int, id int, content_hash string")
    pages = spark.createDataFrame([("n", p, f"https://m.example.org/projects/page-{p + 1}/" if p < 8 else None) for p in range(1, 9)], "namespace string, page int, next_url string")
    state = spark.createDataFrame(list(stored.items()), "id int, content_hash string")
    marks = spark.createDataFrame([("n", "https://m.example.org/projects/page-1/", 1, streak)], "namespace string, next_url string, next_page int, consecutive_known int")
    scan = incremental.incremental_scan(items, pages, state, stop_after, marks, slices=3)
    seen, emitted, stop_page, left = walk(rows, stored, stop_after, streak)
    assert sorted((r.page, r.pos) for r in scan.seen.collect()) == seen
    assert sorted((r.page, r.pos) for r in scan.emitted.collect()) == emitted
    mark = scan.checkpoints.first()
    assert mark.consecutive_known == left
    assert mark.next_page == (stop_page + 1 if stop_page and stop_page < 8 else None)


def listing(spark, first, count, hour=12):
    def card(i):
        return f'<article class="project-card"><h2><a href="/projects/{i}/x.html">Item {i}</a></h2><div>Заказ, {i % 7} ответов</div></article>'

    rows = []
    for p in range(1, 4):
        ids = range(first + (p - 1) * count, first + p * count)
        nxt = f'<a rel="next" href="/projects/page-{p + 1}/">n</a>' if p < 3 else ""
        rows.append((f"https://m.example.org/projects/page-{p}/", p, f"<body><main>{''.join(map(card, ids))}{nxt}</main></body>"))
    return spark.createDataFrame(rows, "url string, page int, html string").withColumn("fetched_at", F.lit(f"2026-07-25 {hour}:00:00").cast("timestamp"))


def test_two_incremental_runs(spark, tmp_path):
    state, marks = st.state_table(spark, f"{tmp_path}/state"), st.checkpoint_table(spark, f"{tmp_path}/marks")
    assert verbs.new_projects(listing(spark, 100, 5), state, marks, batch=1).ok.count() == 15
    assert verbs.new_projects(listing(spark, 100, 5), state, marks, batch=2).ok.count() == 0
    # The ids moved on by two: two new items, the first at the end of the crawl.
    fresh = verbs.new_projects(listing(spark, 102, 5), state, marks, batch=3, stop_after_known=500)
    assert sorted(r.id for r in fresh.ok.collect()) == [115, 116] and fresh.failed.count() == 0
    assert state.read().count() == 17 and marks.read().first().namespace == "projects https://m.example.org/projects/"
    known = spark.createDataFrame([(100,), (999,)], "id long")
    assert [r.id for r in state.contains(known).collect()] == [100]
    assert state.lookup(known).filter("content_hash is null").first().id == 999
    state.compact()
    assert state.read().count() == 17 and len(state.folders()) == 2


def test_early_stop_leaves_a_mark_to_resume_from(spark, tmp_path):
    state, marks = st.state_table(spark, f"{tmp_path}/state"), st.checkpoint_table(spark, f"{tmp_path}/marks")
    verbs.new_projects(listing(spark, 100, 5), state, marks, batch=1)
    verbs.new_projects(listing(spark, 100, 5), state, marks, batch=2, stop_after_known=3)
    mark = marks.read().first()
    assert (mark.next_page, mark.consecutive_known) == (2, 3)


def test_projects_verb(spark):
    found = verbs.projects(listing(spark, 100, 5), page_count=2)
    assert sorted(r.id for r in found.ok.collect()) == list(range(100, 110)) and found.failed.count() == 0
    none = verbs.projects(listing(spark, 100, 5), types="contest", fail_fast=True)
    assert none.ok.count() == 0 and none.failed.count() == 0
    report, overall = verbs.health(listing(spark, 100, 5))
    assert report.first().passed == 3 and overall.first().ok


def test_state_payload_versions(spark):
    rows = [('{"payload_version":1,"payload":{"a":1}}', "ok"), ('{"a":1}', "legacy"), ('{"payload_version":9,"payload":{}}', "unsupported"),
            ("{broken", "corrupt"), ("[1]", "corrupt"), ('{"a":1} x', "corrupt"), ('{"payload_version":1,"payload":[1]}', "corrupt"), (None, "corrupt")]
    df = spark.createDataFrame(rows, "v string, expected string").withColumn("got", st.decode_status(F.col("v")))
    assert df.filter("got <> expected").collect() == []


def test_traversal_cut(spark):
    df = spark.createDataFrame([("a", 1, True), ("a", 2, False), ("a", 3, True), ("b", 1, True), ("b", 2, True)], "c string, page int, has_next boolean")
    cut = crawl.traversal_cut(df, crawl_key="c").select("c", "page")
    assert sorted(map(tuple, cut.collect())) == [("a", 1), ("a", 2), ("b", 1), ("b", 2)]
    bad = df.withColumn("bad", (F.col("c") == "b") & (F.col("page") == 1))
    cut = crawl.traversal_cut(bad, crawl_key="c", failed=F.col("bad"), batch_size=2).select("c", "page")
    assert sorted(map(tuple, cut.collect())) == [("a", 1), ("a", 2), ("b", 2)]


def test_people_dedupe_key(spark):
    rows = [(1, 0, "u", "x", "n"), (2, 0, "u", "y", "n"), (1, 1, "", "x", "n"), (2, 1, None, "x", "m"), (1, 2, None, None, "n")]
    df = spark.createDataFrame(rows, "page int, pos int, username string, url string, name string")
    assert sorted((r.page, r.pos) for r in crawl.dedupe_people(df).collect()) == [(1, 0), (1, 1), (1, 2)]


def test_robots(spark):
    text = "User-agent: bot\nDisallow: /x\n\nUser-agent: *\nDisallow: /private/\n"
    rules = robots.robots_rules(spark.createDataFrame([("e.org", text)], "host string, text string"))
    urls = spark.createDataFrame([("https://e.org/private/1",), ("https://e.org/x",), ("https://o.org/x",)], "url string")
    def decide(agent, **kw):
        return [r.allowed for r in robots.robots_allowed(urls, rules, agent, **kw).orderBy("url").collect()]

    assert decide("crawler/2") == [False, True, True]
    assert decide("MyBot/1", fail_closed=True) == [True, False, False]


def arrive(df, path, batches):
    for i in range(batches):
        df.filter(F.col("page") % batches == i).coalesce(1).write.mode("append").parquet(path)


def test_stream_equals_batch(spark, tmp_path):
    pages = listing(spark, 100, 5)
    arrive(pages, f"{tmp_path}/in", 3)
    schema = pages.schema.simpleString()[7:-1].replace(":", " ")
    stream = sources.stream_pages(spark, f"{tmp_path}/in", schema, 1)
    jobs.write_items(stream, f"{tmp_path}/out", f"{tmp_path}/ck", once=True).awaitTermination(120)
    batch = catalog.catalog_items(catalog.catalog_pages(pages))
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == sorted(r.id for r in batch.collect())


def test_stream_change_detection_survives_a_restart(spark, tmp_path):
    state = st.state_table(spark, f"{tmp_path}/state")

    def run(pages):
        arrive(pages, f"{tmp_path}/in", 1)
        schema = pages.schema.simpleString()[7:-1].replace(":", " ")
        items = incremental.with_hash(jobs.extract_items(sources.stream_pages(spark, f"{tmp_path}/in", schema)))
        jobs.detect_changes(
            items, state, f"{tmp_path}/new", f"{tmp_path}/ck", lambda: F.struct("id", "title"), once=True
        ).awaitTermination(120)
        return spark.read.parquet(f"{tmp_path}/new")

    assert run(listing(spark, 100, 5)).count() == 15
    again = run(listing(spark, 103, 5))
    assert sorted(r.id for r in again.filter("batch = 1").collect()) == [115, 116, 117]


def test_detail_stream_keeps_going_past_bad_pages(spark, tmp_path):
    rows = [("https://m.example.org/projects/1/", 0, "<body><h1>T</h1></body>"), ("https://m.example.org/x/", 0, "<body><h1>T</h1></body>")]
    pages = spark.createDataFrame(rows, "url string, page int, html string")
    arrive(pages, f"{tmp_path}/in", 1)
    stream = sources.stream_pages(spark, f"{tmp_path}/in", "url string, page int, html string")
    jobs.extract_details(stream, f"{tmp_path}/ok", f"{tmp_path}/bad", f"{tmp_path}/ck", once=True).awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/ok").first().id == 1
    assert spark.read.parquet(f"{tmp_path}/bad").first().kind == "parse_error"


def test_live_metrics_equal_batch_and_handlers_cannot_stop_them(spark, tmp_path):
    rows = [(f"2026-01-01 0{i % 3}:1{i % 6}:00", "success" if i % 4 else "failure", "root", 0.5, f"https://u:p@e.org/?token=t{i}", None, i) for i in range(60)]
    events = spark.createDataFrame(rows, "t string, phase string, endpoint string, elapsed double, url string, proxy string, page int").withColumn("ts", F.col("t").cast("timestamp"))
    arrive(events, f"{tmp_path}/in", 1)
    stream = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in")
    q = jobs.live_metrics(stream, "1 hour").writeStream.format("memory").queryName("live").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(map(tuple, spark.table("live").collect())) == sorted(map(tuple, metrics.windowed_metrics(events, "ts", "1 hour").collect()))

    urls = []

    def handler(batch, batch_id):
        urls.extend(r.url for r in batch.select("url").collect())
        raise ValueError("handler")

    full = events.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (("status_code", "int"), ("error_kind", "string"), ("bytes", "long"))])
    for hour in range(3):  # a restart after every file
        full.filter(F.col("page") % 3 == hour).coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")
        log = spark.readStream.schema(full.schema).parquet(f"{tmp_path}/log")
        writer = log.writeStream.foreachBatch(jobs.observed(handler if hour < 2 else (lambda b, i: None), f"{tmp_path}/counters"))
        writer.option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination(120)
    counted = jobs.live_counters(spark, f"{tmp_path}/counters").first()
    assert counted.event_handler_failures_total == 2 and counted.failures_total == 15
    assert len(urls) == 40 and all("token=***" in u and "u:p" not in u for u in urls)


def test_stream_dedupe_and_block_stop(spark, tmp_path):
    rows = [(1, "2026-01-01 00:00:00", 0), (1, "2026-01-01 01:00:00", 0), (2, "2026-01-01 00:00:00", 0)]
    items = spark.createDataFrame(rows, "id long, t string, page int").withColumn("fetched_at", F.col("t").cast("timestamp"))
    arrive(items, f"{tmp_path}/in", 1)
    stream = jobs.dedupe_stream(spark.readStream.schema(items.schema).parquet(f"{tmp_path}/in"))
    stream.writeStream.format("memory").queryName("deduped").trigger(availableNow=True).start().awaitTermination(120)
    assert sorted(r.id for r in spark.table("deduped").collect()) == [1, 2]

    pages = spark.createDataFrame([("https://e.org/captcha", "x", 200, 0)], "url string, html string, status_code int, page int")
    arrive(pages, f"{tmp_path}/blocked", 1)
    done = []
    query = spark.readStream.schema(pages.schema).parquet(f"{tmp_path}/blocked").writeStream.foreachBatch(
        jobs.guarded(lambda b, i: done.append(i))
    ).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="anti-bot"):
        query.awaitTermination(120)
    assert done == []


def test_sinks(spark, tmp_path):
    pages = spark.createDataFrame([("https://e.org/a?b=1", "<p>x", "empty_page"), ("https://e.org/c", "y", "selector_drift")], "url string, html string, error_kind string")
    sources.quarantine(pages, f"{tmp_path}/q")
    back = spark.read.parquet(f"{tmp_path}/q")
    assert back.filter("error_kind = 'empty_page'").first().failure_key == "https_e.org_a_b_1"
    sources.export_json(spark.createDataFrame([(1, None)], "a int, b string"), f"{tmp_path}/j")
    assert spark.read.text(f"{tmp_path}/j").first().value == '{"a":1,"b":null}'
    events = spark.createDataFrame([("start", "https://u:p@e.org/?key=1", None)], "phase string, url string, proxy string")
    sources.write_events(events, f"{tmp_path}/e")
    assert sources.read_events(spark, f"{tmp_path}/e").first().url == "https://***@e.org/?key=***"


def test_html_folder_and_baseline(spark, tmp_path):
    (tmp_path / "html").mkdir()
    (tmp_path / "html" / "a.html").write_text("<h1>A</h1>\n<p>b", encoding="utf-8")
    assert sources.read_html_folder(spark, f"{tmp_path}/html").first().html == "<h1>A</h1>\n<p>b"
    (tmp_path / "base.json").write_text('{"surface":"s","tokens":["tag:p"]}', encoding="utf-8")
    assert sources.read_baseline(spark, f"{tmp_path}/base.json").first().tokens == ["tag:p"]


def test_checkpoint_folder_comes_from_the_session(spark):
    assert ensure_checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_incremental_scan_reads_each_input_once(spark, tmp_path):
    items = spark.range(200).selectExpr(
        "'n' AS namespace", "id div 10 + 1 AS page", "id % 10 AS pos", "id", "'x' AS content_hash", "'p' AS payload")
    items.write.parquet(f"{tmp_path}/items")
    spark.range(1, 21).selectExpr("'n' AS namespace", "id AS page", "'u' AS next_url").write.parquet(f"{tmp_path}/pages")
    items.filter("id % 3 = 0").select("id", "content_hash").write.parquet(f"{tmp_path}/state")
    read = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in ("items", "pages", "state")}
    scan = incremental.incremental_scan(read["items"], read["pages"], read["state"], 5)
    # Plans print a long location only in part unless told otherwise.
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    for result, most in ((scan.emitted, {"items": 1, "pages": 0, "state": 0}), (scan.checkpoints, {"items": 0, "pages": 1, "state": 0})):
        plan = result._jdf.queryExecution().optimizedPlan().toString()
        files = result._jdf.queryExecution().executedPlan().toString()
        assert plan and {n: files.count(f"{tmp_path}/{n}]") for n in read} == most
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert scan.emitted.count() == 133 and "payload" in scan.emitted.columns


@pytest.mark.parametrize("seed", range(2))
def test_sessions_of_a_hot_key(spark, seed):
    rng = random.Random(seed)
    rows = [("hot" if rng.random() < 0.6 else rng.choice(["a", None]), rng.randrange(40_000)) for _ in range(500)]
    df = spark.createDataFrame(rows, "k string, s long").select("k", F.timestamp_seconds("s").alias("ts"))
    got = sorted((str(r.k), r.session_start.timestamp(), r.session_end.timestamp(), r.events)
                 for r in metrics.session_metrics(df, "ts", "5 minutes", "k").collect())
    want = []
    for key in {k for k, _ in rows}:
        times = sorted(s for k, s in rows if k == key)
        runs = [[times[0]]]
        for t in times[1:]:
            runs[-1].append(t) if t <= runs[-1][-1] + 300 else runs.append([t])
        offset = df.filter(F.lit(True)).selectExpr("timestamp_seconds(0) AS z").first().z.timestamp()
        want += [(str(key), r[0] + offset, r[-1] + 300 + offset, len(r)) for r in runs]
    assert got == sorted(want)


def test_latest_per_endpoint_of_a_hot_endpoint(spark):
    rows = [("hot", i, float(i)) for i in range(3_000)] + [("cold", i, float(i)) for i in range(5)] + [("hot", 9_999, None)]
    df = spark.createDataFrame(rows, "endpoint string, ts long, elapsed double")
    got = metrics.latest_latencies_by_endpoint(df, ["ts"], 1_500)
    assert sorted((r.endpoint, r.ts) for r in got.collect()) == [("cold", i) for i in range(5)] + [("hot", i) for i in range(1_500, 3_000)]
    assert got.filter("endpoint = 'hot'").agg(F.min("recency"), F.max("recency")).first() == (1, 1_500)


def test_robots_group_ends(spark):
    text = "User-agent: a\nCrawl-delay: 9\nUser-agent: b\nDisallow: /\n\nUser-agent: c\nDisallow: /caf%C3%A9\nDisallow: /x%zz\n"
    files = spark.createDataFrame([("h.example", text)], "host string, text string")
    rules = robots.robots_rules(files)

    def allowed(agent, *paths):
        df = spark.createDataFrame([(f"http://h.example{p}",) for p in paths], "url string")
        return {r.url[16:]: r.allowed for r in robots.robots_allowed(df, rules, agent).collect()}

    assert allowed("a/1", "/q") == {"/q": True} and allowed("b", "/q") == {"/q": False}
    assert allowed("c", "/café", "/caf%c3%a9/1", "/cafe", "/x%zz", "/a+b") == {
        "/café": False, "/caf%c3%a9/1": False, "/cafe": True, "/x%zz": False, "/a+b": True}
