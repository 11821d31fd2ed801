"""Request-log metrics and state queries, fed by the events and orders tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.page_queries import CLASS_SQL, pages, with_status
from checks.render import table
from pagelake.operators import incremental, metrics, quality
from pagelake.session import materialize
from pagelake.sources import pages as sources
from pagelake.sources import state as st

QUERIES: dict = {}
SQL: dict[str, str] = {}
ORDER = ["ts", "event_id"]


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def request_events(spark: SparkSession, sf: str) -> DataFrame:
    """The events table read as a request log."""
    e = table(spark, sf, "events")
    ident, user, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    phase = (
        F.when(ident % 50 == 7, "parse_failure").when(kind == "click", "start").when(kind == "signup", "retry")
        .when((kind == "error") & (ident % 4 == 0), "blocked").when(kind == "error", "failure").otherwise("success")
    )
    names = F.array(*[F.lit(n) for n in ("projects", "users", "freelancers", "root", "api")])
    base = e.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "value", phase.alias("phase"),
        F.concat(user.cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("request_id"),
        F.get(names, (user % 5).cast("int")).alias("endpoint"),
        F.concat(F.lit("http://u:p@proxy-"), (user % 9).cast("string"), F.lit(".example.org:8080")).alias("proxy"),
        F.concat(F.lit("https://market.example.org/p?token="), ident.cast("string")).alias("url"),
        (ident % 5 + 1).cast("int").alias("attempt"), F.lit("GET").alias("method"),
    )
    p = F.col("phase")
    return base.withColumns({
        "status_code": F.when(p == "success", 200).when((p == "retry") & (ident % 3 == 0), 429).when(p == "retry", 503)
        .when(p == "failure", 404).when(p == "blocked", 403),
        "elapsed": F.when(~p.isin("start", "parse_failure"), F.col("value") / 100),
        "bytes": F.when(~p.isin("start", "parse_failure"), ident % 1000),
        "error": F.when(p.isin("failure", "blocked", "retry"), F.concat(F.lit("E"), (ident % 13).cast("string"))),
        "error_kind": F.when((p == "parse_failure") & (ident % 100 == 7), "selector_drift").when(p == "parse_failure", "parse_error"),
    })


LOG = """WITH b AS (SELECT *, CASE WHEN event_id % 50 = 7 THEN 'parse_failure' WHEN event_type = 'click' THEN 'start' WHEN event_type = 'signup' THEN 'retry'
    WHEN event_type = 'error' AND event_id % 4 = 0 THEN 'blocked' WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS phase FROM events),
r AS (SELECT event_id, ts, user_id, phase, user_id || '-' || strftime(ts, '%Y%m%d') AS request_id,
  ['projects','users','freelancers','root','api'][(user_id % 5 + 1)::INT] AS endpoint, 'proxy-' || (user_id % 9) AS proxy, event_id % 5 + 1 AS attempt,
  CASE WHEN phase = 'success' THEN 200 WHEN phase = 'retry' AND event_id % 3 = 0 THEN 429 WHEN phase = 'retry' THEN 503 WHEN phase = 'failure' THEN 404 WHEN phase = 'blocked' THEN 403 END AS status_code,
  CASE WHEN phase NOT IN ('start','parse_failure') THEN value / 100 END AS elapsed,
  CASE WHEN phase NOT IN ('start','parse_failure') THEN event_id % 1000 END AS bytes,
  CASE WHEN phase IN ('failure','blocked','retry') THEN 'E' || (event_id % 13) END AS error,
  CASE WHEN phase = 'parse_failure' AND event_id % 100 = 7 THEN 'selector_drift' END AS drift FROM b) """
FAILED = "phase IN ('retry','failure','blocked')"
COUNT = "count(*) FILTER (WHERE {})"


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in columns})


def bare(proxy: Column) -> Column:
    return F.regexp_extract(proxy, r"@([^.]*)", 1)


@query("a1_request_counters", LOG + f"""SELECT {COUNT.format("phase = 'start'")} AS requests_total, count(status_code) AS responses_total,
  {COUNT.format("phase = 'retry'")} AS retries_total, {COUNT.format(FAILED)} AS failures_total, {COUNT.format("phase = 'blocked'")} AS blocked_total,
  {COUNT.format("status_code = 429")} AS rate_limited_total, {COUNT.format("phase = 'parse_failure'")} AS parse_failures_total, count(drift) AS selector_drift_total,
  0 AS event_handler_failures_total, sum(bytes)::BIGINT AS bytes_received, round(sum(elapsed), 4) AS latency_seconds_total FROM r""")
def a1(spark, sf):
    return rounded(metrics.request_counters(request_events(spark, sf)), "latency_seconds_total")


@query("a2_endpoint_counters", LOG + f"""SELECT endpoint, {COUNT.format("phase = 'start'")} AS requests, {COUNT.format(FAILED)} AS failures,
  {COUNT.format("phase = 'retry'")} AS retries, round(sum(elapsed), 4) AS latency_seconds_total FROM r GROUP BY endpoint""")
def a2(spark, sf):
    return rounded(metrics.endpoint_counters(request_events(spark, sf)), "latency_seconds_total")


@query("a3_latest_latencies", LOG + """, l AS (SELECT elapsed FROM r WHERE elapsed IS NOT NULL ORDER BY ts DESC, event_id DESC LIMIT 1000)
SELECT count(*) AS samples, min(elapsed) AS fastest, round(quantile_cont(elapsed, 0.5), 6) AS median, round(quantile_cont(elapsed, 0.95), 6) AS p95, max(elapsed) AS slowest FROM l""")
def a3(spark, sf):
    latest = metrics.latest_latencies(request_events(spark, sf), ORDER)
    return metrics.latency_summary(latest).withColumns({"median": F.round("median", 6), "p95": F.round("p95", 6)})


@query("a3_latest_latencies_by_endpoint", LOG + """, l AS (SELECT *, row_number() OVER (PARTITION BY endpoint ORDER BY ts DESC, event_id DESC) AS recency FROM r WHERE elapsed IS NOT NULL)
SELECT endpoint, event_id, elapsed, recency FROM l WHERE recency <= 100""")
def a3b(spark, sf):
    return metrics.latest_latencies_by_endpoint(request_events(spark, sf), ORDER, 100).select("endpoint", "event_id", "elapsed", "recency")


@query("a4_event_counter", LOG + "SELECT phase, endpoint, coalesce(status_code::VARCHAR, 'none') AS status, count(*) AS events FROM r GROUP BY 1, 2, 3")
def a4(spark, sf):
    return metrics.event_counter(request_events(spark, sf))


@query("a5_latency_histogram", LOG + """, s AS (SELECT endpoint, elapsed FROM r WHERE phase = 'success'),
bk AS (SELECT unnest([0.005,0.01,0.025,0.05,0.075,0.1,0.25,0.5,0.75,1.0,2.5,5.0,7.5,10.0,'inf'::DOUBLE]) AS le)
SELECT endpoint, least(le, 1e9)::DOUBLE AS le, count(*) FILTER (WHERE elapsed <= le) AS within, count(*) AS observations, round(sum(elapsed), 4) AS elapsed_sum FROM s, bk GROUP BY 1, 2""")
def a5(spark, sf):
    return rounded(metrics.latency_histogram(request_events(spark, sf)), "elapsed_sum").withColumn("le", F.least("le", F.lit(1e9)))


@query("a9_overall_health", f"SELECT bool_and({CLASS_SQL} = 'ok') AS ok, count(*) AS checks FROM pages")
def a9(spark, sf):
    judged = with_status(pages(spark, sf)).select(
        F.when(quality.response_class(F.col("url"), F.col("html"), F.col("status_code")) == "ok", "passed").otherwise("failed").alias("check_status")
    )
    return quality.overall_health(judged)


@query("p14_failure_category", f"""SELECT category, count(*) AS pages FROM (SELECT CASE {CLASS_SQL} WHEN 'ok' THEN NULL WHEN 'blocked' THEN 'blocked'
  WHEN 'auth_required' THEN 'authentication_required' ELSE 'unexpected_exception' END AS category FROM pages) GROUP BY category""")
def p14(spark, sf):
    kind = quality.response_class(F.col("url"), F.col("html"), F.col("status_code"))
    judged = with_status(pages(spark, sf)).select(quality.failure_category(kind).alias("category"))
    return judged.groupBy("category").agg(F.count("*").alias("pages"))


@query("a12_route_health", LOG + """SELECT proxy, count(*) FILTER (WHERE phase = 'success') AS successes, count(*) FILTER (WHERE phase IN ('failure','blocked')) AS failures,
  arg_max(error, ts) FILTER (WHERE phase IN ('failure','blocked')) AS last_error FROM r GROUP BY proxy""")
def a12(spark, sf):
    return metrics.route_health(request_events(spark, sf), ORDER).withColumn("proxy", bare(F.col("proxy")))


@query("a12_current_failure_runs", LOG + """, l AS (SELECT proxy, max(ts) FILTER (WHERE phase = 'success') AS last FROM r GROUP BY proxy)
SELECT proxy, count(*) FILTER (WHERE phase IN ('failure','blocked') AND (last IS NULL OR ts > last)) AS consecutive_failures FROM r JOIN l USING (proxy) GROUP BY proxy""")
def a12b(spark, sf):
    return metrics.current_failure_runs(request_events(spark, sf), ORDER).withColumn("proxy", bare(F.col("proxy")))


@query("a13_retry_accounting", LOG + """SELECT request_id, max(attempt) AS attempts, count(*) FILTER (WHERE phase = 'retry') AS retries,
  round(coalesce(sum(elapsed), 0), 4) AS elapsed_total, arg_max(phase, ts) AS outcome FROM r GROUP BY request_id""")
def a13(spark, sf):
    return rounded(metrics.retry_accounting(request_events(spark, sf), ORDER), "elapsed_total")


@query("w5_failure_streaks", LOG + """, f AS (SELECT *, (phase IN ('failure','blocked')) AS bad FROM r),
i AS (SELECT *, sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM f)
SELECT event_id, user_id, sum(CASE WHEN bad THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, island ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS failure_streak FROM i""")
def w5(spark, sf):
    events = request_events(spark, sf).select("event_id", "user_id", "ts", "phase")
    return metrics.failure_streaks(
        events, ["user_id"], ORDER, F.col("phase").isin("failure", "blocked")
    ).select("event_id", "user_id", "failure_streak")


@query("w5_failure_runs_over_threshold", LOG + """, f AS (SELECT *, (phase IN ('failure','blocked')) AS bad FROM r),
i AS (SELECT *, sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER (PARTITION BY endpoint ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM f),
n AS (SELECT endpoint, island, count(*) FILTER (WHERE bad) AS run FROM i GROUP BY 1, 2)
SELECT endpoint, count(*) FILTER (WHERE run >= 3) AS opened, max(run) AS longest FROM n GROUP BY endpoint""")
def w5b(spark, sf):
    events = request_events(spark, sf).select("event_id", "endpoint", "ts", "phase")
    runs = metrics.failure_streaks(events, ["endpoint"], ORDER, F.col("phase").isin("failure", "blocked"))
    return runs.groupBy("endpoint").agg(
        F.count_if(F.col("failure_streak") == 3).alias("opened"), F.max("failure_streak").alias("longest")
    )


WINDOW_SQL = """SELECT strftime({start}, '%Y-%m-%d %H:%M:%S') AS window_start, endpoint, count(*) AS events,
  count(*) FILTER (WHERE phase IN ('failure','blocked')) AS failures, round(sum(elapsed), 4) AS elapsed_sum FROM {source} GROUP BY 1, 2"""


def _windowed(df: DataFrame) -> DataFrame:
    return rounded(df, "elapsed_sum").select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "endpoint", "events", "failures", "elapsed_sum"
    )


@query("t5_tumbling_metrics", LOG + WINDOW_SQL.format(start="date_trunc('hour', ts)", source="r"))
def t5(spark, sf):
    return _windowed(metrics.windowed_metrics(request_events(spark, sf), "ts", "1 hour"))


@query("t5_sliding_metrics", LOG + WINDOW_SQL.format(
    start="w", source="(SELECT *, unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS w FROM r)"))
def t5b(spark, sf):
    return _windowed(metrics.windowed_metrics(request_events(spark, sf), "ts", "2 hours", "1 hour"))


@query("t5_session_metrics", LOG + """, g AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS starts FROM r WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sess FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start, count(*) AS events FROM s GROUP BY user_id, sess""")
def t5c(spark, sf):
    found = metrics.session_metrics(request_events(spark, sf), "ts", "6 hours", "user_id")
    return found.select("user_id", F.date_format("session_start", "yyyy-MM-dd HH:mm:ss").alias("session_start"), "events")


@query("k8_safe_event_log", "SELECT event_id, 'https://market.example.org/p?token=***' AS url, 'http://***@proxy-' || (user_id % 9) || '.example.org:8080' AS proxy FROM events")
def k8(spark, sf):
    return metrics.safe_events(request_events(spark, sf)).select("event_id", "url", "proxy")


@query("s8_event_scan", LOG + """SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, request_id, phase, endpoint, attempt, status_code, bytes, error,
  'https://market.example.org/p?token=***' AS url, count(*) AS n FROM r GROUP BY ALL""")
def s8(spark, sf):
    """The event log is written without secrets and read back."""
    path = st.fresh_folder(spark, "log")
    sources.write_events(request_events(spark, sf), path)
    found = sources.read_events(spark, path)
    return found.groupBy(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "request_id", "phase", "endpoint", "attempt", "status_code", "bytes", "error", "url",
    ).agg(F.count("*").alias("n"))


@query("s7_baseline", "SELECT p_brand AS surface, string_agg(DISTINCT 'tag:' || lower(p_type), '|' ORDER BY 'tag:' || lower(p_type)) AS tokens FROM part GROUP BY p_brand")
def s7(spark, sf):
    """A baseline of tokens per surface is stored as JSON and read back."""
    path = st.fresh_folder(spark, "baseline")
    tokens = F.sort_array(F.collect_set(F.concat(F.lit("tag:"), F.lower("p_type")))).alias("tokens")
    made = table(spark, sf, "part").groupBy(F.col("p_brand").alias("surface")).agg(tokens).withColumn("structural_fingerprint", F.sha2(F.array_join("tokens", ","), 256))
    made.write.json(path)
    return sources.read_baseline(spark, path).select("surface", F.array_join("tokens", "|").alias("tokens"))


# ---- state -------------------------------------------------------------------

T0, T1 = "2026-07-01 00:00:00", "2026-07-25 12:00:00"
HASH_SQL = "sha256('{{\"id\":' || o_orderkey || ',\"status\":\"' || {} || '\"}}')"


def order_items(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as items: thirty per page, hashed over id and status."""
    o = table(spark, sf, "orders")
    key = F.col("o_orderkey")
    return incremental.with_hash(
        o.select(
            key.alias("id"), (F.floor(key / 30) + 1).cast("int").alias("page"), (key % 30).cast("int").alias("pos"),
            F.col("o_orderstatus").alias("status"),
        ),
        ["id", "status"],
    )


def order_state(spark: SparkSession, sf: str) -> DataFrame:
    """Stored state: ids not divisible by 7; every 11th was stored with another status."""
    o = table(spark, sf, "orders").filter(F.col("o_orderkey") % 7 != 0)
    stored = incremental.with_hash(
        o.select(
            F.col("o_orderkey").alias("id"),
            F.when(F.col("o_orderkey") % 11 == 0, "X").otherwise(F.col("o_orderstatus")).alias("status"),
        ),
        ["id", "status"],
    )
    at = F.lit(T0).cast("timestamp")
    return stored.select(
        "id", at.alias("first_seen_at"), at.alias("last_seen_at"), "content_hash",
        F.lit(None).cast("timestamp").alias("source_updated_at"), st.encode_payload(F.struct("id", "status")).alias("payload"),
    )


NOW_HASH = HASH_SQL.format("o_orderstatus")
OLD_HASH = HASH_SQL.format("CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE o_orderstatus END")


def saved_state(spark: SparkSession, sf: str) -> st.KeyedTable:
    """The stored state as a table on disk."""
    saved = st.state_table(spark, st.fresh_folder(spark, "state"))
    saved.upsert(order_state(spark, sf), 0)
    return saved


@query("s3_state_lookup", f"SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 <> 0 THEN {OLD_HASH} END AS content_hash, o_orderkey % 7 <> 0 AS stored FROM orders")
def s3(spark, sf):
    found = saved_state(spark, sf).lookup(order_items(spark, sf).select("id"))
    return found.select("id", "content_hash", F.col("content_hash").isNotNull().alias("stored"))


@query("j1_items_with_state", f"SELECT o_orderkey AS id, {NOW_HASH} AS content_hash, CASE WHEN o_orderkey % 7 <> 0 THEN {OLD_HASH} END AS state_hash FROM orders")
def j1(spark, sf):
    items = order_items(spark, sf).select("id", F.col("content_hash").alias("now"))
    return saved_state(spark, sf).lookup(items).select("id", F.col("now").alias("content_hash"), F.col("content_hash").alias("state_hash"))


@query("j2_new_or_changed", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN 'new' ELSE 'changed' END AS why FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 11 = 0")
def j2(spark, sf):
    found = incremental.new_or_changed(order_items(spark, sf), order_state(spark, sf))
    return found.select("id", F.when(F.col("state_hash").isNull(), "new").otherwise("changed").alias("why"))


@query("j2_only_new", "SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 7 = 0")
def j2b(spark, sf):
    return incremental.only_new(order_items(spark, sf), order_state(spark, sf)).select("id")


@query("k2_state_upsert", f"""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN '{T1}' ELSE '{T0}' END AS first_seen_at,
  CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 3 = 0 THEN '{T0}' ELSE '{T1}' END AS last_seen_at,
  CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 3 = 0 THEN {OLD_HASH} ELSE {NOW_HASH} END AS content_hash FROM orders WHERE o_orderkey % 7 <> 0 OR o_orderkey % 3 <> 0""")
def k2(spark, sf):
    """A second run over a stored state; the same batch is written twice, as a retry would."""
    state = saved_state(spark, sf)
    seen = order_items(spark, sf).filter(F.col("id") % 3 != 0)
    records = materialize(st.records_for(seen, state.read(), F.lit(T1).cast("timestamp"), F.struct("id", "status")))
    for _ in range(2):
        state.upsert(records, 1)
    return state.read().select(
        "id", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("first_seen_at", "last_seen_at")], "content_hash"
    )


@query("w7_first_last_seen", f"""SELECT user_id AS id, CASE WHEN bool_or(ts < TIMESTAMP '2024-01-10') THEN '{T0}' ELSE '{T1}' END AS first_seen_at,
  CASE WHEN bool_or(ts >= TIMESTAMP '2024-01-10') THEN '{T1}' ELSE '{T0}' END AS last_seen_at,
  arg_max(event_type, event_id + CASE WHEN ts >= TIMESTAMP '2024-01-10' THEN 1000000000000 ELSE 0 END) AS content_hash FROM events GROUP BY user_id""")
def w7(spark, sf):
    """Two runs over the users of the events before and after a day; an id comes up many times in each."""
    state = st.state_table(spark, st.fresh_folder(spark, "state"))
    e = table(spark, sf, "events").select(
        F.col("user_id").alias("id"), F.col("event_type").alias("content_hash"), F.col("event_id").alias("page"), F.lit(0).alias("pos"),
        F.col("ts").cast("timestamp").alias("ts"),
    )
    for batch, (at, seen) in enumerate(((T0, e.filter("ts < '2024-01-10'")), (T1, e.filter("ts >= '2024-01-10'")))):
        records = st.records_for(seen, state.read(), F.lit(at).cast("timestamp"), F.struct("id"))
        state.upsert(materialize(records), batch)
    return state.read().select(
        "id", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("first_seen_at", "last_seen_at")], "content_hash"
    )


def saved_checkpoints(spark: SparkSession, sf: str) -> st.KeyedTable:
    """Three batches of checkpoint writes by time; each batch holds the last write of a namespace in it."""
    saved = st.checkpoint_table(spark, st.fresh_folder(spark, "checkpoints"))
    all_writes = checkpoints(spark, sf).withColumn("part", F.ntile(3).over(Window.partitionBy("namespace").orderBy("ts", "next_page")))
    for batch in (1, 2, 3):
        saved.upsert(st.latest(all_writes.filter(F.col("part") == batch), "namespace", "ts"), batch)
    return saved


def read_checkpoints(rows: DataFrame) -> DataFrame:
    return rows.select("namespace", "next_url", "next_page", "consecutive_known")


def checkpoints(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as a checkpoint write of its type's namespace."""
    e = table(spark, sf, "events")
    return e.select(
        F.col("event_type").alias("namespace"), F.concat(F.lit("https://market.example.org/projects/page-"), F.col("event_id").cast("string"), F.lit("/")).alias("next_url"),
        F.col("event_id").alias("next_page"), F.col("ts").cast("timestamp").alias("updated_at"), (F.col("user_id") % 20).alias("consecutive_known"),
        "ts",
    )


CHECKPOINT_SQL = """SELECT event_type AS namespace, 'https://market.example.org/projects/page-' || arg_max(event_id, ts) || '/' AS next_url, arg_max(event_id, ts) AS next_page,
  arg_max(user_id % 20, ts) AS consecutive_known FROM events {} GROUP BY event_type"""


@query("k3_checkpoint_upsert", CHECKPOINT_SQL.format(""))
def k3(spark, sf):
    return read_checkpoints(saved_checkpoints(spark, sf).read())


@query("s4_checkpoint_read", CHECKPOINT_SQL.format("WHERE event_type = 'click'"))
def s4(spark, sf):
    wanted = spark.createDataFrame([("click",)], "namespace string")
    return read_checkpoints(saved_checkpoints(spark, sf).lookup(wanted))


@query("s5_payload_decode", """SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'ok' WHEN 1 THEN 'legacy' WHEN 2 THEN 'unsupported' ELSE 'corrupt' END AS decode_status,
  CASE WHEN event_id % 6 IN (0, 1) THEN CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) END AS k FROM events""".replace("\\\\", "\\"))
def s5(spark, sf):
    e = table(spark, sf, "events")
    k, props = F.col("event_id") % 6, F.col("props")
    wrapped = lambda version, body: F.concat(F.lit(f'{{"payload_version":{version},"payload":'), body, F.lit("}"))
    value = (
        F.when(k == 0, wrapped(1, props)).when(k == 1, props).when(k == 2, wrapped(2, props)).when(k == 3, F.concat(props, F.lit("}")))
        .when(k == 4, F.concat(F.lit("["), props, F.lit("]"))).otherwise(wrapped(1, F.lit('"text"')))
    )
    return e.select(
        "event_id", st.decode_status(value).alias("decode_status"),
        F.get_json_object(st.decode_payload(value), "$.k").cast("long").alias("k"),
    )


@query("k4_payload_encode", """SELECT event_id, '{"payload_version":1,"payload":{"id":' || event_id || ',"kind":"' || event_type || '","note":' || CASE WHEN event_id % 2 = 0 THEN '"заказ"' ELSE 'null' END || '}}' AS payload FROM events""")
def k4(spark, sf):
    record = F.struct(
        F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.when(F.col("event_id") % 2 == 0, "заказ").alias("note")
    )
    return table(spark, sf, "events").select("event_id", st.encode_payload(record).alias("payload"))


@query("k1_json_export", """SELECT c_custkey, '{"name":"' || c_name || '","segment":' || CASE WHEN c_custkey % 2 = 0 THEN '"' || c_mktsegment || '"' ELSE 'null' END || '}' AS json FROM customer""")
def k1(spark, sf):
    record = F.struct(F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("segment"))
    return table(spark, sf, "customer").select("c_custkey", sources.to_json(record).alias("json"))


@query("w6_incremental_scan", """
WITH o AS (SELECT o_orderkey, o_orderkey % 5 AS ns, NOT (o_orderkey % 7 = 0 OR o_orderkey % 11 = 0) AS known FROM orders),
i AS (SELECT *, sum(CASE WHEN known THEN 0 ELSE 1 END) OVER (PARTITION BY ns ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS island FROM o),
s AS (SELECT *, sum(CASE WHEN known THEN 1 ELSE 0 END) OVER (PARTITION BY ns, island ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS streak FROM i),
e AS (SELECT ns, min(o_orderkey) AS stop FROM s WHERE streak >= 8 GROUP BY ns)
SELECT 'ns-' || s.ns AS namespace, o_orderkey AS id FROM s LEFT JOIN e ON e.ns = s.ns WHERE NOT known AND (stop IS NULL OR o_orderkey <= stop)""")
def w6(spark, sf):
    """Five crawls over the orders, each stopping after eight known items in a row."""
    items = order_items(spark, sf).withColumn("namespace", F.concat(F.lit("ns-"), (F.col("id") % 5).cast("string")))
    crawl_pages = items.select("namespace", "page").distinct().withColumn("next_url", F.lit(None).cast("string"))
    scan = incremental.incremental_scan(items, crawl_pages, order_state(spark, sf), stop_after_known=8)
    return scan.emitted.select("namespace", "id")
