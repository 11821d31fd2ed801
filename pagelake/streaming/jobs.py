"""The batch operators as streaming jobs: extraction, change detection, dedupe, metrics.

Progress is kept in the query's ``checkpointLocation``; what a crawl has seen is kept in the state
tables.  Sinks write one folder per micro-batch id, so a replayed batch overwrites itself.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from pagelake import constants as K
from pagelake.operators import catalog, detail, incremental, metrics, quality
from pagelake.sources.state import KeyedTable, records_for

log = logging.getLogger(__name__)


def _start(writer: DataStreamWriter, once: bool) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if once else writer).start()


def extract_items(pages: DataFrame, timezone: str = K.DEFAULT_TIMEZONE) -> DataFrame:
    """Items of arriving listing pages; the same expressions as the batch job."""
    return catalog.catalog_items(catalog.catalog_pages(pages), timezone)


def write_items(pages: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append the items of arriving pages to a Parquet folder."""
    writer = extract_items(pages).writeStream.format("parquet").outputMode("append")
    return _start(writer.option("path", path).option("checkpointLocation", checkpoint), once)


def dedupe_stream(items: DataFrame, key: str = "id", time: str = "fetched_at", delay: str = "1 day") -> DataFrame:
    """First arrival of each id within the watermark."""
    return items.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def live_metrics(events: DataFrame, size: str, slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Windowed request counters; events later than ``delay`` are left out."""
    return metrics.windowed_metrics(events.withWatermark("ts", delay), "ts", size, slide)


def live_sessions(events: DataFrame, gap: str, key: str, delay: str = "10 minutes") -> DataFrame:
    return metrics.session_metrics(events.withWatermark("ts", delay), "ts", gap, key)


def detect_changes(
    items: DataFrame,
    state: KeyedTable,
    emit: str,
    checkpoint: str,
    payload: Callable[[], Column],
    once: bool = False,
) -> StreamingQuery:
    """Write new and changed items of every micro-batch and bring the state up to date.

    ``items`` carry ``id, page, pos, content_hash``.  The emitted rows are computed against the state
    as it was before this batch, also when the batch is replayed after a failure.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            # A replay must not see what its own first try already stored; only buckets of this batch's ids are read.
            before = state.lookup(batch.select("id").distinct(), batch_id).filter(F.col("content_hash").isNotNull())
            newest = batch.groupBy("id").agg(
                F.max_by(F.struct(*[c for c in batch.columns if c != "id"]), F.struct("page", "pos")).alias("r")
            ).select("id", "r.*")
            incremental.new_or_changed(newest, before).drop("state_hash").write.mode("overwrite").parquet(
                f"{emit}/batch={batch_id}"
            )
            state.upsert(records_for(batch, before, F.current_timestamp(), payload()), batch_id)
        finally:
            batch.unpersist()

    writer = items.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return _start(writer, once)


CHANGES = (
    "id long, change string, content_hash string, previous_hash string, first_seen_at timestamp, last_seen_at timestamp"
)


class ChangeTracker(StatefulProcessor):
    """For the ids of a bucket: the hash last seen, since when an id is known, and a timer that forgets ids that stay away.

    Each call on the state is a trip to the JVM, and so is each key: ids share both by bucket. The one timer of a bucket is
    that of the id that stays away longest.
    """

    def __init__(self, keep_seconds: int) -> None:
        self.keep = keep_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState(
            "seen", "ids array<bigint>, hashes array<string>, first_seen array<bigint>, last_seen array<bigint>")

    def _known(self) -> dict:
        """Hash, first and last time (microseconds, UTC) by id."""
        stored = self.seen.get()
        return {} if stored is None else {i: (h, a, z) for i, h, a, z in zip(*stored, strict=True)}

    def _store(self, known: dict) -> None:
        hashes, first, last = (list(c) for c in zip(*known.values(), strict=True))
        self.seen.update((list(known), hashes, first, last))

    def _after(self, last: int) -> int:
        return last // 1000 + self.keep

    def _next(self, known: dict) -> int | None:
        return self._after(min(last for _, _, last in known.values())) if known else None

    def handleInputRows(self, key, rows, timerValues):
        import pandas as pd

        known = self._known()
        timer_before = self._next(known)
        frames = list(rows)
        arrived = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        if len(arrived) > 1:
            arrived = arrived.sort_values(["fetched_at", "page", "pos"], kind="stable")
        ids = [None] * len(arrived) if key[0] == NO_ID else arrived["id"].tolist()
        if arrived["fetched_at"].isna().any():
            raise ValueError("tracked items need a fetched_at")
        # Times have no zone and mean UTC, whatever the zone of the worker.
        times = arrived["fetched_at"].astype("datetime64[us]").astype("int64").tolist()
        now, out = {}, []
        for id_, at, content in zip(ids, times, arrived["content_hash"].tolist(), strict=True):
            before, first, last = now.get(id_) or known.get(id_) or (None, None, None)
            # An older copy that comes late neither counts as a change nor moves the state back.
            if last is not None and at < last:
                continue
            if first is None:
                first = at
            if before != content:
                out.append((id_, "new" if before is None else "changed", content, before, first, at))
            now[id_] = (content, first, at)
        known.update((i, state) for i, state in now.items() if state[0] is not None)
        if known:
            self._store(known)
            timer = self._next(known)
            if timer_before is None:
                self.handle.registerTimer(timer)
            elif timer != timer_before:
                self.handle.deleteTimer(timer_before)
                self.handle.registerTimer(timer)
        if out:
            yield _changes(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        known = self._known()
        edge = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        gone = {i: state for i, state in known.items() if self._after(state[2]) <= edge}
        kept = {i: state for i, state in known.items() if i not in gone}
        if kept:
            self._store(kept)
            self.handle.registerTimer(self._next(kept))
        else:
            self.seen.clear()
        if gone:
            yield _changes([(i, "gone", None, *state) for i, state in gone.items()])

    def close(self) -> None:
        pass


CHANGE_NAMES = [c.split()[0] for c in CHANGES.split(", ")]
#: Buckets of ids in the state of a tracker; those who have far more or fewer ids than millions name another number.
TRACKER_BUCKETS = 4096
#: The bucket of rows without an id. They travel with a number, because beside nulls ids would become fractions.
NO_ID = -1


def _changes(rows: list[tuple]):
    """Rows of ``CHANGES`` from tuples with times in microseconds."""
    import pandas as pd

    frame = pd.DataFrame(rows, columns=CHANGE_NAMES)
    # Long numbers beside nulls must not become fractions.
    frame["id"] = pd.array([r[0] for r in rows], dtype="Int64")
    for name in ("first_seen_at", "last_seen_at"):
        frame[name] = pd.to_datetime(frame[name], unit="us")
    return frame


def track_changes(
    items: DataFrame, keep_seconds: int = 30 * 86_400, delay: str = "1 day", buckets: int = TRACKER_BUCKETS
) -> DataFrame:
    """Changes of every id as a stream: ``new``, ``changed``, and ``gone`` once it stayed away for ``keep_seconds``.

    ``items`` carry ``id, page, pos, content_hash, fetched_at``. The state lives in Spark's own keyed state store, which
    must be the RocksDB provider (``keyed_state``), in ``buckets`` of ids, so a batch touches the buckets of the ids it
    holds and no others. A stream keeps the number of buckets it was first started with. Time is that of the pages: an id
    is forgotten when the watermark passes.
    """
    rows = items.select("id", "page", "pos", "content_hash", "fetched_at").withWatermark("fetched_at", delay)
    bucket = F.when(F.col("id").isNull(), NO_ID).otherwise(F.pmod(F.hash("id"), F.lit(buckets)))
    keyed = rows.withColumns({"__bucket": bucket, "id": F.coalesce("id", F.lit(0))})
    return keyed.groupBy("__bucket").transformWithStateInPandas(
        ChangeTracker(keep_seconds), outputStructType=CHANGES, outputMode="append", timeMode="EventTime")


def keyed_state(spark: SparkSession) -> SparkSession:
    """Choose the state store that keyed processors need; before the first query with one."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return spark


def extract_details(
    pages: DataFrame, ok_path: str, failed_path: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Detail records of arriving pages; unusable pages go to their own folder, the stream goes on."""

    def step(batch: DataFrame, batch_id: int) -> None:
        records = detail.detail_pages(batch).persist()
        try:
            records.filter(F.col("error").isNull()).drop("error").write.mode("overwrite").parquet(
                f"{ok_path}/batch={batch_id}"
            )
            records.filter(F.col("error").isNotNull()).select(
                "url", "error.kind", "error.message"
            ).write.mode("overwrite").parquet(f"{failed_path}/batch={batch_id}")
        finally:
            records.unpersist()

    return _start(pages.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint), once)


def guarded(step: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Wrap a micro-batch step so that a block page among the input ends the stream before it runs."""

    def run(batch: DataFrame, batch_id: int) -> None:
        judged = batch.withColumn(
            "response_class",
            quality.response_class(F.col("url"), F.col("html"), F.col("status_code")),
        )
        quality.stop_if_blocked(judged)
        step(batch, batch_id)

    return run


def observed(handler: Callable[[DataFrame, int], None], path: str) -> Callable[[DataFrame, int], None]:
    """Wrap a user handler of events: its errors are logged and counted, the stream goes on.

    Every micro-batch leaves one row of request counters under ``path``, with whether its handler failed. A batch
    that is run again replaces its row, and a restarted stream goes on with the same table: ``live_counters``.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        batch, failed = batch.persist(), 0
        try:
            try:
                handler(metrics.safe_events(batch), batch_id)
            except Exception:
                log.exception("event handler failed")
                failed = 1
            counted = metrics.request_counters(batch).withColumn(
                HANDLER_FAILURES, F.col(HANDLER_FAILURES) + F.lit(failed))
            counted.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")
        finally:
            batch.unpersist()

    return run


HANDLER_FAILURES = "event_handler_failures_total"


def live_counters(spark: SparkSession, path: str) -> DataFrame:
    """One row: the counters of all micro-batches that ``observed`` has seen, across restarts."""
    rows = spark.read.option("basePath", path).parquet(path).drop("batch")
    return rows.agg(*[F.sum(c).alias(c) for c in rows.columns])
