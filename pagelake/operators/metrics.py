"""Aggregations over the request-event log.

Event columns: ``ts, request_id, phase, method, url, attempt, endpoint, proxy, status_code, elapsed,
bytes, error, error_kind``.  Every attempt writes a ``start`` row; a response, retry, failure, block
or parse failure writes another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelake import constants as K
from pagelake.functions.urls import redact_url
from pagelake.operators.runs import cut_points, previous_value, running_total
from pagelake.session import materialize


def _counters() -> list[Column]:
    phase, kind = F.col("phase"), F.col("error_kind")
    # A retry row stands for the failed attempt before it.
    failed = phase.isin("retry", "failure", "blocked")
    return [
        F.count_if(phase == "start").alias("requests_total"),
        F.count_if(F.col("status_code").isNotNull()).alias("responses_total"),
        F.count_if(phase == "retry").alias("retries_total"),
        F.count_if(failed).alias("failures_total"),
        F.count_if(phase == "blocked").alias("blocked_total"),
        F.count_if(F.col("status_code") == 429).alias("rate_limited_total"),
        F.count_if(phase == "parse_failure").alias("parse_failures_total"),
        F.count_if((phase == "parse_failure") & (kind == "selector_drift")).alias("selector_drift_total"),
        F.count_if(kind == "event_handler").alias("event_handler_failures_total"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes_received"),
        F.coalesce(F.sum(F.when(F.col("status_code").isNotNull(), F.col("elapsed"))), F.lit(0.0))
        .alias("latency_seconds_total"),
    ]


def request_counters(events: DataFrame) -> DataFrame:
    """One row of global counters."""
    return events.agg(*_counters())


def endpoint_counters(events: DataFrame) -> DataFrame:
    """Requests, failures, retries and latency per endpoint."""
    every = {c: i for i, c in enumerate(["requests_total", "responses_total", "retries_total", "failures_total"])}
    columns = _counters()
    return events.groupBy("endpoint").agg(
        columns[every["requests_total"]].alias("requests"),
        columns[every["failures_total"]].alias("failures"),
        columns[every["retries_total"]].alias("retries"),
        columns[-1],
    )


def latest_latencies(events: DataFrame, order: Sequence[str], samples: int = K.LATENCY_SAMPLES) -> DataFrame:
    """The latest ``samples`` latencies overall (a distributed top-k, no global sort)."""
    measured = events.filter(F.col("elapsed").isNotNull())
    return measured.orderBy(*[F.col(c).desc() for c in order]).limit(samples)


def latest_latencies_by_endpoint(
    events: DataFrame, order: Sequence[str], samples: int = K.LATENCY_SAMPLES
) -> DataFrame:
    """The latest ``samples`` latencies per endpoint.

    Every endpoint is dealt to parts that are ranked by themselves; only their latest rows meet, at
    most ``samples`` from each part, however many a hot endpoint has.
    """
    parts = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    latest = [F.col(c).desc() for c in order]
    measured = events.filter(F.col("elapsed").isNotNull()).withColumn(
        "__part", F.pmod(F.xxhash64(*order, "elapsed"), F.lit(parts))
    )
    first = F.row_number().over(Window.partitionBy("endpoint", "__part").orderBy(*latest))
    return (
        measured.withColumn("__rank", first).filter(F.col("__rank") <= samples).drop("__rank", "__part")
        .withColumn("recency", F.row_number().over(Window.partitionBy("endpoint").orderBy(*latest)))
        .filter(F.col("recency") <= samples)
    )


def latency_summary(latencies: DataFrame) -> DataFrame:
    """Count and quantiles of a bounded latency sample."""
    return latencies.agg(
        F.count("elapsed").alias("samples"),
        F.min("elapsed").alias("fastest"),
        F.percentile("elapsed", F.lit(0.5)).alias("median"),
        F.percentile("elapsed", F.lit(0.95)).alias("p95"),
        F.max("elapsed").alias("slowest"),
    )


def event_counter(events: DataFrame) -> DataFrame:
    """Events per (phase, endpoint, status); a missing status is ``none``."""
    status = F.coalesce(F.nullif(F.col("status_code").cast("string"), F.lit("0")), F.lit("none"))
    return events.groupBy("phase", "endpoint", status.alias("status")).agg(F.count("*").alias("events"))


def latency_histogram(events: DataFrame, buckets: Sequence[float] = tuple(K.LATENCY_BUCKETS)) -> DataFrame:
    """Cumulative latency buckets per endpoint, successes only.

    The buckets are aggregates of one pass, unpivoted afterwards: no row is multiplied.
    """
    done = events.filter((F.col("phase") == "success") & F.col("elapsed").isNotNull())
    names = [f"b{i}" for i in range(len(buckets))]
    summed = done.groupBy("endpoint").agg(
        *[F.count_if(F.col("elapsed") <= b).alias(n) for b, n in zip(buckets, names)],
        F.count("*").alias("observations"),
        F.sum("elapsed").alias("elapsed_sum"),
    )
    bounds = [
        F.struct(F.lit(float(b)).alias("le"), F.col(n).alias("within"))
        for b, n in zip(buckets, names)
    ] + [F.struct(F.lit(float("inf")).alias("le"), F.col("observations").alias("within"))]
    return summed.select(
        "endpoint", "observations", "elapsed_sum", F.inline(F.array(*bounds))
    )


def route_health(events: DataFrame, order: Sequence[str]) -> DataFrame:
    """Successes, failures, the last error and its time per route (proxy)."""
    failed = F.col("phase").isin("failure", "blocked")
    at = F.struct(*order)
    return events.groupBy("proxy").agg(
        F.count_if(F.col("phase") == "success").alias("successes"),
        F.count_if(failed).alias("failures"),
        F.max_by("error", F.when(failed, at)).alias("last_error"),
    )


def current_failure_runs(events: DataFrame, order: Sequence[str], key: str = "proxy") -> DataFrame:
    """Failures in a row each route ends with: failures after its last success (no window)."""
    at = F.struct(*order)
    ended = events.groupBy(key).agg(F.max(F.when(F.col("phase") == "success", at)).alias("__last"))
    tail = events.join(ended, key).filter(
        F.col("phase").isin("failure", "blocked") & (F.col("__last").isNull() | (at > F.col("__last")))
    )
    runs = tail.groupBy(key).agg(F.count("*").alias("n"))
    return ended.join(runs, key, "left").select(
        key, F.coalesce("n", F.lit(0)).alias("consecutive_failures")
    )


def failure_streaks(
    events: DataFrame, keys: Sequence[str], order: Sequence[str], failed: Column
) -> DataFrame:
    """Running count of failures in a row at every event; hot keys are split along the time axis."""
    return running_total(
        events, keys, order, add=failed.cast("long"), reset=~failed, name="failure_streak"
    )


def retry_accounting(events: DataFrame, order: Sequence[str]) -> DataFrame:
    """Attempts, retries, time spent and final outcome per logical request."""
    at = F.struct(*order)
    return events.groupBy("request_id").agg(
        F.max("attempt").alias("attempts"),
        F.count_if(F.col("phase") == "retry").alias("retries"),
        F.coalesce(F.sum("elapsed"), F.lit(0.0)).alias("elapsed_total"),
        F.max_by("phase", at).alias("outcome"),
    )


def windowed_metrics(events: DataFrame, time: str, size: str, slide: str | None = None) -> DataFrame:
    """Counters per event-time window and endpoint; works on a batch or a stream."""
    span = F.window(time, size, slide) if slide else F.window(time, size)
    return (
        events.groupBy(span.alias("w"), "endpoint")
        .agg(
            F.count("*").alias("events"),
            F.count_if(F.col("phase").isin("failure", "blocked")).alias("failures"),
            F.sum("elapsed").alias("elapsed_sum"),
        )
        .select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
            "endpoint", "events", "failures", "elapsed_sum",
        )
    )


def session_metrics(events: DataFrame, time: str, gap: str, key: str) -> DataFrame:
    """Bursts of activity per key, separated by ``gap`` without events.

    A batch is cut along the time axis, so no task needs all events of a key; a stream keeps its open
    sessions as state.
    """
    if not events.isStreaming:
        return _batch_sessions(events, time, gap, key)
    return (
        events.groupBy(F.session_window(time, gap).alias("w"), key)
        .agg(F.count("*").alias("events"))
        .select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), key, "events")
    )


def _batch_sessions(events: DataFrame, time: str, gap: str, key: str) -> DataFrame:
    pause = F.expr(f"INTERVAL {gap}")
    # One row per key and moment; the key as text, so that a missing one is a key too.
    moments = events.filter(F.col(time).isNotNull()).groupBy(
        F.to_json(F.struct(key)).alias("__key"), F.col(key), F.col(time)
    ).agg(F.count("*").alias("events"))
    moments = materialize(moments)
    cuts = cut_points(moments, time)
    earlier = previous_value(moments, ["__key"], [time], time, "__earlier", cuts)
    fresh = F.col("__earlier").isNull() | (F.col(time) > F.col("__earlier") + pause)
    numbered = running_total(
        earlier.withColumn("__fresh", fresh), ["__key"], [time], add=F.col("__fresh").cast("long"), reset=F.lit(False),
        name="__session", cuts=cuts,
    )
    return numbered.groupBy("__key", "__session").agg(
        F.min(time).alias("session_start"), (F.max(time) + pause).alias("session_end"), F.first(key).alias(key),
        F.sum("events").alias("events"),
    ).drop("__key", "__session").select("session_start", "session_end", key, "events")


def safe_events(events: DataFrame) -> DataFrame:
    """Events as they may be logged: credentials removed from ``url`` and ``proxy``."""
    return events.withColumns(
        {c: redact_url(F.col(c)) for c in ("url", "proxy") if c in events.columns}
    )
