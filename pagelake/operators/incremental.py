"""Incremental scan: new and changed items against a stored state, with early stop and resume."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.functions.hashing import record_hash
from pagelake.functions.urls import page_number
from pagelake.operators.runs import cut_points, previous_value, running_total
from pagelake.session import materialize

# Everything a record holds except where it came from, in sorted order.
HASH_FIELDS = [
    "budget", "card_text", "category", "customer", "description", "field_sources", "id",
    "image_url", "kind", "location", "published_at", "published_raw", "responses_count", "status",
    "subcategory", "title", "url", "views_raw",
]


def with_hash(items: DataFrame, fields: Sequence[str] = HASH_FIELDS) -> DataFrame:
    return items.withColumn("content_hash", record_hash([F.col(f) for f in fields]))


def new_or_changed(items: DataFrame, state: DataFrame) -> DataFrame:
    """Items whose id is not in the state, or whose hash differs from the stored one."""
    known = state.select("id", F.col("content_hash").alias("state_hash"))
    joined = items.join(known, "id", "left")
    return joined.filter(~F.col("state_hash").eqNullSafe(F.col("content_hash")))


def only_new(items: DataFrame, state: DataFrame) -> DataFrame:
    return items.join(state.select("id"), "id", "left_anti")


@dataclass(frozen=True)
class IncrementalScan:
    """The three results of one scan; all derive from ``rows``."""

    rows: DataFrame
    emitted: DataFrame
    seen: DataFrame
    checkpoints: DataFrame


def incremental_scan(
    items: DataFrame,
    pages: DataFrame,
    state: DataFrame,
    stop_after_known: int = 20,
    checkpoints: DataFrame | None = None,
    now: Column | None = None,
    slices: int | None = None,
) -> IncrementalScan:
    """Walk each namespace in (page, pos) order until ``stop_after_known`` known items in a row.

    ``items``: ``namespace, page, pos, id, content_hash`` and any payload; ``pages``: ``namespace,
    page, next_url`` of every page of the crawl; ``state``: ``id, content_hash``; ``checkpoints``:
    ``namespace, next_url, next_page, consecutive_known`` of earlier runs.

    An item is known when its last stored version, or its earlier occurrence in the same crawl, has
    the same hash.  A run that left a next page resumes there with its streak.  Rows after the stop
    are neither emitted nor counted as seen.

    The walk itself runs here, on the keys, order and hashes alone, which are stored once; the results
    join them back to the items, read once more for their payload.  ``(namespace, page, pos)`` is unique.
    """
    if isinstance(stop_after_known, bool) or stop_after_known <= 0:
        raise ValueError("stop_after_known must be positive")
    if checkpoints is not None:
        resumed = checkpoints.select(
            "namespace",
            F.col("next_page").alias("__from"),
            F.when(
                F.col("next_page").isNotNull() | F.col("next_url").isNotNull(),
                F.col("consecutive_known"),
            ).otherwise(0).alias("__streak"),
        )
        from_page = F.coalesce(F.col("__from"), F.lit(1))
        items = items.join(resumed, "namespace", "left").filter(F.col("page") >= from_page).drop("__from")
        pages = pages.join(resumed, "namespace", "left").filter(F.col("page") >= from_page).drop("__from", "__streak")
    else:
        items = items.withColumn("__streak", F.lit(0))

    order = ["page", "pos"]
    known_state = state.select("id", F.col("content_hash").alias("__state_hash"))
    with_state = materialize(
        items.select("namespace", *order, "id", "content_hash", "__streak").join(known_state, "id", "left")
    )
    # One pass over the page numbers alone serves both ordered steps below.
    cuts = cut_points(with_state, "page", slices)
    with_previous = previous_value(
        with_state, ["namespace", "id"], order, "content_hash", "__earlier", cuts
    )
    judged = with_previous.select(
        *[c for c in with_previous.columns if c not in ("__state_hash", "__earlier")],
        F.coalesce("__earlier", "__state_hash").alias("previous_hash"),
    ).withColumn("known", F.col("previous_hash").eqNullSafe(F.col("content_hash")))
    judged = materialize(judged)
    streaks = running_total(
        judged, ["namespace"], order,
        add=F.col("known").cast("long"), reset=~F.col("known"), name="streak",
        initial=F.coalesce("__streak", F.lit(0)), cuts=cuts,
    ).drop("__streak")
    stops = streaks.filter(F.col("streak") >= stop_after_known).groupBy("namespace").agg(
        F.min(F.struct(*order)).alias("__stop")
    )
    walked = materialize(
        streaks.join(stops, "namespace", "left")
        .withColumn("seen", F.col("__stop").isNull() | (F.struct(*order) <= F.col("__stop")))
        .withColumn("emitted", F.col("seen") & ~F.col("known"))
    )
    facts = walked.select("namespace", *order, "previous_hash", "known", "streak", "seen", "emitted")
    payload = items.drop("__streak")
    rows = payload.join(facts, ["namespace", *order]).select(*payload.columns, *facts.columns[3:])
    emitted = payload.join(facts.filter("emitted"), ["namespace", *order]).select(
        *payload.columns, "previous_hash", "known", "streak"
    )
    seen = payload.join(facts.filter("seen"), ["namespace", *order]).select(
        *payload.columns, "previous_hash", "known", "streak"
    )

    # The checkpoint is the last visited page: the stop page, else the last page of the crawl.
    ends = walked.filter("seen").groupBy("namespace").agg(
        F.max_by("streak", F.struct(*order)).alias("consecutive_known"),
        F.max("__stop.page").alias("__stop_page"),
    )
    visited = pages.join(ends, "namespace", "left").filter(
        F.col("__stop_page").isNull() | (F.col("page") <= F.col("__stop_page"))
    )
    last = visited.groupBy("namespace").agg(
        F.max_by("next_url", "page").alias("next_url"),
        F.max("consecutive_known").alias("consecutive_known"),
    )
    checkpoint = last.select(
        "namespace", "next_url",
        page_number(F.col("next_url")).alias("next_page"),
        (now if now is not None else F.current_timestamp()).alias("updated_at"),
        F.coalesce("consecutive_known", F.lit(0)).cast("long").alias("consecutive_known"),
    )
    return IncrementalScan(rows, emitted, seen, checkpoint)
