"""Streams run to their end over the given tables, against SQL that knows only the tables and the order of arrival."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.catalog_queries import BRANDS, brand_pages
from checks.event_queries import COUNT, FAILED, HASH_SQL, LOG, T0, T1, order_items, order_state, request_events, rounded
from checks.render import fetched_at, table
from pagelake.functions import urls
from pagelake.session import materialize
from pagelake.sources import pages as sources
from pagelake.sources import state as st
from pagelake.streaming import jobs, projects

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


#: Rows of a file of a stream; up to so many are one file.
ROWS_PER_FILE = 20_000


def arrival(rows: DataFrame, parts: int, part: Column, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """``rows`` as a stream of ``parts`` micro-batches, in the order of ``part``, each of the same number of files.

    A part of few rows is one file; a larger one is written and read by many tasks.
    """
    spark, folder = rows.sparkSession, st.fresh_folder(rows.sparkSession, "arrivals")
    stored = materialize(rows.withColumn("__part", part.cast("int")))
    largest = stored.filter(F.col("__part").between(0, parts - 1)).groupBy("__part").count().agg(F.max("count")).first()[0] or 0
    files = max(1, min(-(-largest // rows_per_file), 4 * spark.sparkContext.defaultParallelism))
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    for i in range(parts):
        own = stored.filter(F.col("__part") == i).drop("__part")
        (own.repartition(files) if files > 1 else own.coalesce(1)).write.mode("append").parquet(folder)
        # Empty partitions leave no files: empty files make up for them, so that no batch takes files of the next part.
        written = len(spark.read.schema(schema).parquet(folder).inputFiles())
        for _ in range(files * (i + 1) - written):
            own.limit(0).coalesce(1).write.mode("append").parquet(folder)
    return sources.stream_pages(spark, folder, schema, files_per_trigger=files)


def landed(rows: DataFrame) -> DataFrame:
    """What a stream has appended once it has read all there is."""
    spark, out = rows.sparkSession, st.fresh_folder(rows.sparkSession, "landed")
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", out)
    writer.option("checkpointLocation", st.fresh_folder(spark, "progress")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


# ---- crawls ------------------------------------------------------------------------


@query("t1_stream_projects", BRANDS + """SELECT 'ok' AS channel, slug, page, id FROM b WHERE NOT ends_with(slug, '5')
UNION ALL SELECT DISTINCT 'failed', slug, page, NULL FROM b WHERE ends_with(slug, '5')""")
def t1(spark, sf):
    """Pages of all brands arrive in three parts that cut across the crawls, later pages before earlier ones."""
    pages = brand_pages(spark, sf).withColumn("fetched_at", fetched_at())
    number = F.coalesce(urls.page_number(F.col("url")), F.lit(1))
    path = st.fresh_folder(spark, "projects")
    projects.stream_projects(
        arrival(pages, 3, F.pmod(-number, F.lit(3))), path, st.fresh_folder(spark, "progress"), once=True).awaitTermination()
    found = projects.stream_results(spark, path)
    slug = urls.listing_category(F.col("crawl")).alias("slug")
    page = F.col("page").cast("long").alias("page")
    return found.ok.select(F.lit("ok").alias("channel"), slug, page, "id").unionByName(
        found.failed.select(F.lit("failed").alias("channel"), slug, page, F.lit(None).cast("long").alias("id")))


TRACK_SQL = """WITH o AS (SELECT o_custkey AS id, o_orderstatus AS hash, o_orderkey, o_orderdate AS day FROM orders),
w AS (SELECT *, lag(hash) OVER u AS previous, min(day) OVER (PARTITION BY id) AS first FROM o WINDOW u AS (PARTITION BY id ORDER BY day, o_orderkey))
SELECT id, CASE WHEN previous IS NULL THEN 'new' ELSE 'changed' END AS change, hash AS content_hash, previous AS previous_hash,
  strftime(first, '%Y-%m-%d') AS first_seen, strftime(day, '%Y-%m-%d') AS last_seen FROM w WHERE previous IS NULL OR previous <> hash"""


@query("t2_tracked_changes", TRACK_SQL)
def t2(spark, sf):
    """Every customer's orders as versions of one item, a third of the years in each micro-batch."""
    at = F.col("o_orderdate").cast("timestamp")
    versions = table(jobs.keyed_state(spark), sf, "orders").select(
        F.col("o_custkey").alias("id"), F.lit(1).alias("page"), F.col("o_orderkey").alias("pos"),
        F.col("o_orderstatus").alias("content_hash"), at.alias("fetched_at"))
    stream = arrival(versions, 3, F.least(F.greatest(F.floor((F.year("fetched_at") - 1992) / 3), F.lit(0)), F.lit(2)))
    found = landed(jobs.track_changes(stream, keep_seconds=100 * 365 * 86_400))
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return found.select("id", "change", "content_hash", "previous_hash", day("first_seen_at").alias("first_seen"), day("last_seen_at").alias("last_seen"))


CHANGED = "o_orderkey % 7 = 0 OR o_orderkey % 11 = 0"


@query("t2_detected_changes", f"SELECT o_orderkey AS id, {HASH_SQL.format('o_orderstatus')} AS content_hash, o_orderkey // 30 + 1 AS page FROM orders WHERE {CHANGED}")
def t2b(spark, sf):
    """Orders arrive in two micro-batches and are compared with a stored state, of which only touched buckets are read."""
    state = st.state_table(spark, st.fresh_folder(spark, "state"))
    state.upsert(order_state(spark, sf), -1)
    emit = st.fresh_folder(spark, "changes")
    jobs.detect_changes(
        arrival(order_items(spark, sf), 2, F.col("page") % 2), state, emit, st.fresh_folder(spark, "progress"),
        lambda: F.struct("id", "status"), once=True,
    ).awaitTermination()
    return spark.read.parquet(emit).select("id", "content_hash", F.col("page").cast("long").alias("page"))


# ---- one commit --------------------------------------------------------------------


@query("k3_torn_batch", f"""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 <> 0 THEN '{T0}' END AS seen_after_crash, NULL AS mark_after_crash,
  CASE WHEN o_orderkey % 3 <> 0 THEN '{T1}' WHEN o_orderkey % 7 <> 0 THEN '{T0}' END AS seen_after_replay, 5 AS mark_after_replay FROM orders""")
def k3_torn(spark, sf):
    """A batch whose writer dies after its state but before its checkpoint shows neither; run again, it shows both."""
    folder = st.fresh_folder(spark, "state")
    state, marks = st.state_table(spark, folder), st.checkpoint_table(spark, folder)
    state.upsert(order_state(spark, sf), 0)
    items = order_items(spark, sf)
    records = materialize(st.records_for(items.filter("id % 3 <> 0"), state.read(1), F.lit(T1).cast("timestamp"), F.struct("id", "status")))
    mark = spark.createDataFrame([("projects", None, 5, 3)], "namespace string, next_url string, next_page long, consecutive_known long").withColumn(
        "updated_at", F.lit(T1).cast("timestamp"))
    lost = mark.withColumn("next_url", F.raise_error(F.lit("the writer died")).cast("string"))
    try:
        st.commit_together(1, {state: records, marks: lost})
    except Exception as error:  # noqa: BLE001
        if "the writer died" not in str(error):
            raise

    def seen(name: str) -> DataFrame:
        found = state.lookup(items.select("id")).select("id", F.date_format("last_seen_at", "yyyy-MM-dd HH:mm:ss").alias(f"seen_{name}"))
        at = marks.lookup(mark.select("namespace")).select(F.col("next_page").alias(f"mark_{name}"))
        return materialize(found.crossJoin(F.broadcast(at)))

    crashed = seen("after_crash")
    st.commit_together(1, {state: records, marks: mark})
    return crashed.join(seen("after_replay"), "id")


# ---- late data -----------------------------------------------------------------------

#: Thirds of the time arrive one after the other. A tenth of the events comes one part late, which is in time, and of the
#: first two thirds another tenth three parts late, when the watermark has passed.
THIRDS, PARTS, DELAY = 3, 5, "2 days"
ARRIVALS = f"""WITH span AS (SELECT min(epoch(ts)) AS a, max(epoch(ts)) - min(epoch(ts)) AS d FROM events),
t AS (SELECT *, floor((epoch(ts) - a) * {THIRDS} / (d + 1))::INT AS third FROM events, span),
e AS (SELECT event_id, ts, user_id, event_type, third + CASE WHEN event_id % 10 = 3 AND third < 2 THEN 3 WHEN event_id % 10 = 7 THEN 1 ELSE 0 END AS part FROM t),
n AS (SELECT part, max(ts) AS top FROM e GROUP BY part),
late AS (SELECT p.part, (SELECT max(top) FROM n WHERE n.part <= p.part - 2) - INTERVAL {DELAY} AS edge FROM n AS p),
final AS (SELECT max(ts) - INTERVAL {DELAY} AS edge FROM e),
k AS (SELECT e.* FROM e JOIN late USING (part) WHERE """


def with_part(events: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    """``events`` with the micro-batch they arrive in."""
    seconds = F.unix_micros("ts") / 1e6
    whole = table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    start, length = whole.agg(F.min(seconds), F.max(seconds) - F.min(seconds)).first()
    third, tenth = F.floor((seconds - start) * THIRDS / (length + 1)), F.col("event_id") % 10
    wait = F.when((tenth == 3) & (third < 2), 3).when(tenth == 7, 1).otherwise(0)
    return events.withColumn("part", (third + wait).cast("int"))


def arriving_events(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    return arrival(with_part(e, spark, sf), PARTS, F.col("part")).drop("part")


def to_second(value) -> Column:
    return F.date_format(value, "yyyy-MM-dd HH:mm:ss")


@query("t4_stream_dedupe", ARRIVALS + """edge IS NULL OR ts > edge) SELECT event_id, part FROM (
  SELECT k.event_id, k.part, row_number() OVER (PARTITION BY k.event_id ORDER BY k.part) AS nth FROM k) WHERE nth = 1""")
def t4(spark, sf):
    """Events, each there twice; too late ones are left out, and of the others the first is kept."""
    e = arriving_events(spark, sf)
    twice = e.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    found = landed(jobs.dedupe_stream(twice, "event_id", "ts", DELAY).select("event_id", "ts"))
    return with_part(found, spark, sf).select("event_id", "part")


@query("t5_late_windows", ARRIVALS + """edge IS NULL OR time_bucket(INTERVAL 1 hour, ts) + INTERVAL 1 hour > edge)
SELECT strftime(time_bucket(INTERVAL 1 hour, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type AS endpoint, count(*) AS events
FROM k, final WHERE time_bucket(INTERVAL 1 hour, ts) + INTERVAL 1 hour <= final.edge GROUP BY 1, 2""")
def t5_windows(spark, sf):
    """Hourly counters of a stream with late events: closed hours, without what came after the watermark had passed."""
    e = arriving_events(spark, sf).select(
        "ts", F.col("event_type").alias("endpoint"), F.lit("success").alias("phase"), F.lit(0.0).alias("elapsed"))
    found = landed(jobs.live_metrics(e, "1 hour", delay=DELAY))
    return found.select(to_second("window_start").alias("window_start"), "endpoint", "events")


@query("t5_late_sessions", ARRIVALS + """edge IS NULL OR ts + INTERVAL 6 hours > edge),
g AS (SELECT user_id, ts, CASE WHEN ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 hours THEN 1 ELSE 0 END AS fresh FROM k),
s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start, strftime(max(ts) + INTERVAL 6 hours, '%Y-%m-%d %H:%M:%S') AS session_end, count(*) AS events
FROM s, final GROUP BY user_id, session, final.edge HAVING max(ts) + INTERVAL 6 hours <= final.edge""")
def t5_sessions(spark, sf):
    """Bursts of each user's events with pauses of up to six hours, from a stream with late events."""
    found = landed(jobs.live_sessions(arriving_events(spark, sf), "6 hours", "user_id", DELAY))
    return found.select("user_id", to_second("session_start").alias("session_start"), to_second("session_end").alias("session_end"), "events")


# ---- live counters ---------------------------------------------------------------------


@query("a1_live_counters", LOG + f"""SELECT {COUNT.format("phase = 'start'")} AS requests_total, {COUNT.format(FAILED)} AS failures_total,
  {COUNT.format("phase = 'blocked'")} AS blocked_total, sum(bytes)::BIGINT AS bytes_received, round(sum(elapsed), 3) AS latency_seconds_total, 2 AS event_handler_failures_total FROM r""")
def a1_live(spark, sf):
    """The request log arrives in three parts, the handler fails on two of them, and the stream is started again after each."""
    events, path, progress = request_events(spark, sf), st.fresh_folder(spark, "counters"), st.fresh_folder(spark, "progress")
    stream = arrival(events, 3, F.pmod(F.col("event_id"), F.lit(3)))

    def handler(batch: DataFrame, batch_id: int) -> None:
        if batch_id != 1:
            raise ValueError("handler")

    for _ in range(2):
        writer = stream.writeStream.foreachBatch(jobs.observed(handler, path)).option("checkpointLocation", progress)
        writer.trigger(availableNow=True).start().awaitTermination()
    found = rounded(jobs.live_counters(spark, path), "latency_seconds_total")
    return found.select("requests_total", "failures_total", "blocked_total", "bytes_received", F.round("latency_seconds_total", 3).alias("latency_seconds_total"), "event_handler_failures_total")
