"""Work is done once and by many tasks: plans without repeated extraction, streams in several files, few trips to the state."""

from __future__ import annotations

import gc
from datetime import datetime

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from checks import catalog_queries, render, stream_queries
from pagelake.functions import text as T
from pagelake.operators import catalog, dom, html_tree, profile
from pagelake.plans import verbs
from pagelake.streaming import jobs

URL = "https://market.example.org/users/c-1/"
BLOCK = '<div class="portfolio"><a href="/users/c-1/portfolio/item-{0}/">Work {0}</a></div><article><h2><a href="/projects/{0}/">Item {0}</a></h2><p>Заказ</p></article>'


def profile_rows(spark, *numbers):
    html = "<main>" + "".join(BLOCK.format(n) for n in numbers) + "</main>"
    return spark.createDataFrame([(URL, html, 1), (URL, html, 2), (URL, None, 3)], "url string, html string, page int")


def filters(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in plan.splitlines() if "Filter (" in line]


def test_cards_are_not_computed_for_a_filter_too(spark):
    items = catalog.catalog_items(catalog.catalog_pages(profile_rows(spark, 1, 2), fingerprint=False))
    assert not [line for line in filters(items) if "transform" in line or "size(" in line]
    assert sorted((r.page, r.pos, r.id, r.kind) for r in items.collect()) == [(p, i, i + 1, "order") for p in (1, 2) for i in (0, 1)]


def test_readers_of_card_texts_do_without_their_elements(spark):
    pages = profile_rows(spark, 1, 2)
    whole = catalog.catalog_items(catalog.catalog_pages(pages, fingerprint=False))
    plain = catalog.catalog_items(catalog.catalog_pages(pages, fingerprint=False, markup=False))
    assert plain.columns == [c for c in whole.columns if c not in catalog.MARKUP_FIELDS]
    assert sorted(map(str, plain.collect())) == sorted(map(str, whole.select(plain.columns).collect()))
    few = [df.select("id", "kind")._jdf.queryExecution().optimizedPlan().toString().count("slice(") for df in (whole, plain)]
    assert few[1] < few[0]


def test_sections_are_not_computed_for_a_filter_too(spark):
    rows = profile.section_rows(profile.profile_pages(profile_rows(spark, 1, 2), "s"), "portfolio")
    assert not [line for line in filters(rows) if "transform" in line or "size(" in line]
    assert sorted((r.username, r.page, r.pos, r.title) for r in rows.collect()) == [("c-1", 1, 0, "Work 1"), ("c-1", 1, 1, "Work 2")]


def test_unread_fields_of_a_section_stay_out_of_the_shuffle(spark):
    rows = profile.section_rows(profile.profile_pages(profile_rows(spark, 1), "s"), "portfolio").select("username", "page", "title")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    grouped = next(line for line in plan.splitlines() if "Aggregate [" in line)
    assert grouped.count("first(") == 1 and "min_by" not in grouped


def written(spark, run):
    """How many tables ``run`` stores, and in how many Python stages their plans parse pages."""
    from pyspark.sql import DataFrameWriter

    plans, write = [], DataFrameWriter.parquet

    def spy(self, path, *args, **kwargs):
        plans.append(self._df._jdf.queryExecution().optimizedPlan().toString())
        return write(self, path, *args, **kwargs)

    DataFrameWriter.parquet = spy
    try:
        result = run()
    finally:
        DataFrameWriter.parquet = write
    plans.append(result._jdf.queryExecution().optimizedPlan().toString())
    return result, sum(p.count("MapInArrow") for p in plans)


def test_health_parses_each_page_once(spark):
    pages = profile_rows(spark, 1, 2)
    report, parsed = written(spark, lambda: verbs.health({"profile": pages, "detail": pages}, "s")[0])
    assert parsed == 2
    rows = {r.surface: (r.structures, r["pages"], r.passed) for r in report.collect()}
    # All pages have one URL, so they count as one structure; nothing names the user or the project.
    assert rows == {"profile": (1, 3, 0), "detail": (1, 3, 0)}


def small_tables(spark, tmp_path):
    for name, rows in {
        "nation": "select 0L n_nationkey, 'n' n_name", "customer": "select 1L c_custkey, 'c' c_name, 0L c_nationkey, 1.5D c_acctbal, 'M' c_mktsegment",
        "orders": "select id o_orderkey, 1L o_custkey, 'O' o_orderstatus, 10.0D o_totalprice, date'1995-01-02' o_orderdate, '1-URGENT' o_orderpriority from range(95, 99)",
    }.items():
        spark.sql(rows).write.parquet(str(tmp_path / f"{name}.parquet"))


def test_pages_are_rendered_after_the_shuffle(spark, tmp_path):
    small_tables(spark, tmp_path)
    for pages, found in ((render.catalog_html, 4), (render.profile_html, 3)):
        df = pages(spark, str(tmp_path))
        plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
        dealt = [i for i, line in enumerate(plan) if "Repartition" in line]
        below = [plan[j] for i in dealt for j in range(i + 1, len(plan)) if all(depth[k] > depth[i] for k in range(i + 1, j + 1))]
        assert dealt and not any("project-description" in line for line in below)
        assert any("project-description" in line for line in plan)
        assert df.count() == found


def test_no_search_for_cycles_while_pages_are_parsed(monkeypatch):
    seen, arrays = [], html_tree._dom_arrays
    monkeypatch.setattr(html_tree, "_dom_arrays", lambda pages: seen.append(gc.isenabled()) or arrays(pages))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["<p>a<b>b<div>c</div></p>d<br/><i/>", None])], names=["k", "html"])
    [out] = html_tree.parse_batches(iter([batch]))
    assert seen == [False] and gc.isenabled()
    first, second = out.to_pylist()
    assert second["nodes"] == [] and first["texts"] == ["a", "b", "c", "d"]
    # A block ends the paragraph around it, also through inline elements.
    assert [(n["tag"], n["parent"], n["last"], n["s0"], n["s1"]) for n in first["nodes"]] == [
        ("html", -1, 6, 0, 4), ("body", 0, 6, 0, 4), ("p", 1, 3, 0, 2), ("b", 2, 3, 1, 2), ("div", 1, 4, 2, 3), ("br", 1, 5, 4, 4), ("i", 1, 6, 4, 4)]


def test_readers_of_few_fields_do_without_the_others(spark, tmp_path):
    small_tables(spark, tmp_path)
    first = catalog_queries.w1(spark, str(tmp_path))
    plan = first._jdf.queryExecution().optimizedPlan().toString()
    assert "card_text" not in plan.split("Generate")[0] and "responses_count" not in plan
    assert sorted(map(tuple, first.collect())) == [(5_500_000 + k, 4, k - 95) for k in range(95, 99)]


def test_a_pattern_is_searched_once_inside_a_lambda(spark):
    found = spark.range(1).select(F.transform(F.array(F.lit("a1"), F.lit("b")), lambda x: T.clean_text(T.find(x, r"\d"))).alias("x"))
    assert found.first().x == ["1", None]
    pages = spark.range(1).select(F.transform(F.array(F.col("id").cast("string")), lambda x: T.clean_text(T.find(x, r"\d"))).alias("x"))
    assert pages._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract(") == 1


def test_a_large_part_of_a_stream_is_several_files_and_one_batch(spark):
    rows = spark.range(0, 300, 1, 4).withColumn("part", F.when(F.col("id") < 295, 0).otherwise(2))
    batches = {}

    def step(batch, batch_id):
        batches[batch_id] = (sorted(r.part for r in batch.select("part").distinct().collect()), batch.count(), batch.select("file").distinct().count())

    stream = stream_queries.arrival(rows, 3, F.col("part"), rows_per_file=100).withColumn("file", F.input_file_name())
    folder = stream_queries.st.fresh_folder(spark, "progress")
    stream.writeStream.foreachBatch(step).option("checkpointLocation", folder).trigger(availableNow=True).start().awaitTermination()
    assert [batches[i][:2] for i in sorted(batches)] == [([0], 295), ([], 0), ([2], 5)]
    assert batches[0][2] == 3


class Handle:
    """State of one id, counting the calls."""

    def __init__(self):
        self.value, self.timers, self.calls = None, [], []

    def getValueState(self, *_):  # noqa: N802
        return self

    def exists(self):
        self.calls.append("exists")
        return self.value is not None

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = value

    def listTimers(self):  # noqa: N802
        self.calls.append("listTimers")
        return iter(self.timers)

    def deleteTimer(self, at):  # noqa: N802
        self.calls.append("deleteTimer")
        self.timers.remove(at)

    def registerTimer(self, at):  # noqa: N802
        self.calls.append("registerTimer")
        self.timers.append(at)


def test_a_tracked_id_has_one_timer_and_few_calls():
    handle, tracker = Handle(), jobs.ChangeTracker(60)
    tracker.init(handle)

    def arrive(*rows):
        frame = pd.DataFrame([(1, 1, p, h, pd.Timestamp(t)) for p, (h, t) in enumerate(rows)], columns=["id", "page", "pos", "content_hash", "fetched_at"])
        return [tuple(r) for out in tracker.handleInputRows((1,), iter([frame]), None) for r in out[["change", "content_hash"]].itertuples(index=False)]

    assert arrive(("a", "2026-01-02"), ("b", "2026-01-01")) == [("new", "b"), ("changed", "a")]
    assert arrive(("a", "2026-01-01")) == []
    assert arrive(("a", "2026-01-03")) == []
    assert handle.timers == [int(datetime.fromisoformat("2026-01-03T00:01:00+00:00").timestamp() * 1000)]
    assert handle.calls == ["get", "update", "registerTimer", "get", "update", "get", "update", "deleteTimer", "registerTimer"]


def test_ids_of_a_bucket_share_the_calls_on_state():
    handle, tracker, far = Handle(), jobs.ChangeTracker(60), 2**60 + 1
    tracker.init(handle)

    def arrive(*rows):
        frame = pd.DataFrame([(i, 1, p, h, pd.Timestamp(t)) for p, (i, h, t) in enumerate(rows)], columns=["id", "page", "pos", "content_hash", "fetched_at"])
        return [tuple(r) for out in tracker.handleInputRows((7,), iter([frame]), None) for r in out[["id", "change", "previous_hash"]].itertuples(index=False)]

    class At:
        def __init__(self, at):
            self.at = int(pd.Timestamp(at).timestamp() * 1000)

        def getExpiryTimeInMs(self):  # noqa: N802
            return self.at

        getCurrentWatermarkInMs = getExpiryTimeInMs  # noqa: N815

    assert arrive((far, "a", "2026-01-02"), (2, "x", "2026-01-05"), (3, None, "2026-01-01")) == [(far, "new", None), (2, "new", None)]
    assert arrive((2, "y", "2026-01-06")) == [(2, "changed", "x")]
    # One timer, of the id that stays away longest; no call is made for each id.
    assert handle.calls == ["get", "update", "registerTimer", "get", "update"] and handle.timers == [At("2026-01-02 00:01").at]
    handle.timers.clear()
    [gone] = tracker.handleExpiredTimer((7,), At("2026-01-03"), At("2026-01-02 00:01"))
    assert [tuple(r) for r in gone.itertuples(index=False)] == [(far, "gone", None, "a", pd.Timestamp("2026-01-02"), pd.Timestamp("2026-01-02"))]
    assert handle.timers == [At("2026-01-06 00:01").at]
    assert arrive((far, "a", "2026-01-07")) == [(far, "new", None)]


def test_readers_of_the_same_profiles_parse_them_once(spark, tmp_path):
    small_tables(spark, tmp_path)
    union, parsed = written(spark, lambda: catalog_queries.e5(spark, str(tmp_path)))
    assert parsed == 1
    assert sorted(map(tuple, union.collect())) == [("c-1", s, 4, 1) for s in ("portfolio", "projects", "reviews")]
    nested, parsed = written(spark, lambda: catalog_queries.j4(spark, str(tmp_path)))
    assert parsed == 1
    # Order 95 and 98 are on page 3, 95 divisible by 5 but not repeated there; works of the first two pages are 96 and 97.
    assert list(map(tuple, nested.collect())) == [("c-1", 2, "c-1")]


def test_pages_parsed_before_give_the_same_records(spark):
    pages = profile_rows(spark, 1, 2).withColumn("note", F.lit("n"))
    parsed = dom.parse_html(pages)
    assert parsed.columns == ["url", "page", "note", *dom.DOM_NAMES] and dom.is_parsed(parsed) and not dom.is_parsed(pages)
    for read in (
        lambda df: profile.profile_pages(df, "s"), lambda df: catalog.catalog_items(catalog.catalog_pages(df, fingerprint=False)),
        lambda df: verbs.user_projects(df).ok, lambda df: verbs.user_projects(df).failed, lambda df: verbs.user_portfolio(df, "s").ok,
    ):
        own, shared = read(pages), read(parsed)
        assert own.columns == shared.columns and sorted(map(str, own.collect())) == sorted(map(str, shared.collect()))


def test_projects_of_users_with_named_fields(spark):
    pages = profile_rows(spark, 1, 2)
    whole = verbs.user_projects(pages).ok
    for fields in (["title"], ["budget", "kind"]):
        few = verbs.user_projects(pages, fields=fields).ok
        assert few.columns == ["username", "id", "page", "pos", *fields]
        assert sorted(map(str, few.collect())) == sorted(map(str, whole.select(few.columns).collect()))


def test_rows_without_an_id_leave_tracked_ids_alone(spark, tmp_path):
    schema = "id long, page int, pos int, content_hash string, fetched_at timestamp"
    for day, h in ((1, "a"), (2, "a"), (3, "b")):
        rows = spark.createDataFrame([(i, 1, p, h) for p, i in enumerate((None, 2**60 + 1, 2**60 + 2, 0))], "id long, page int, pos int, content_hash string")
        rows.withColumn("fetched_at", F.lit(f"2026-07-0{day} 10:00:00").cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    jobs.keyed_state(spark)
    found = stream_queries.landed(jobs.track_changes(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in"), buckets=2))
    want = [(i, c, h, p) for i in (None, 0, 2**60 + 1, 2**60 + 2) for c, h, p in (("changed", "b", "a"), ("new", "a", None))]
    assert sorted(((r.id, r.change, r.content_hash, r.previous_hash) for r in found.collect()), key=str) == sorted(want, key=str)
