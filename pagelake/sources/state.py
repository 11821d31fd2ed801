"""Crawl state: one row per item id, one checkpoint per namespace, as keyed tables of a store.

Tables of one folder share a commit log: what a batch changes in them becomes visible at once.
"""

from __future__ import annotations

import uuid
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake import constants as K
from pagelake import schemas
from pagelake.session import ensure_checkpoint_dir
from pagelake.sources.store import KeyedTable, Store, latest


class StateStore(Protocol):
    """What the incremental jobs need from a store."""

    def read(self, before: int | None = None) -> DataFrame: ...

    def lookup(self, keys: DataFrame, before: int | None = None) -> DataFrame: ...

    def upsert(self, rows: DataFrame, batch: int) -> None: ...


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared place, for tables that live as long as a run."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def state_table(spark: SparkSession, path: str) -> KeyedTable:
    return Store(spark, path).table("state", schemas.STATE, "id")


def checkpoint_table(spark: SparkSession, path: str) -> KeyedTable:
    """Checkpoints of crawls; under the path of a state table they are committed together with it."""
    return Store(spark, path).table("checkpoints", schemas.CHECKPOINT, "namespace")


def commit_together(batch: int, rows: dict[KeyedTable, DataFrame]) -> None:
    """One commit for the tables of each folder, in the order given."""
    stores = {table.store.path: table.store for table in rows}
    for path, store in stores.items():
        store.commit(batch, {table: df for table, df in rows.items() if table.store.path == path})


def records_for(items: DataFrame, state: DataFrame, now: Column, payload: Column) -> DataFrame:
    """State rows of seen items, with their first-seen time carried over; one row per id."""
    known = state.select("id", F.col("first_seen_at").alias("__first"))
    newest = (
        items.withColumn("__payload", encode_payload(payload))
        .groupBy("id")
        .agg(F.max_by(F.struct("content_hash", F.col("__payload").alias("payload")), F.struct("page", "pos")).alias("r"))
    )
    return newest.join(known, "id", "left").select(
        "id",
        F.coalesce("__first", now).alias("first_seen_at"),
        now.alias("last_seen_at"),
        "r.content_hash",
        F.lit(None).cast("timestamp").alias("source_updated_at"),
        "r.payload",
    )


def encode_payload(payload: Column) -> Column:
    """Versioned envelope as compact JSON."""
    return F.to_json(
        F.struct(F.lit(K.STATE_PAYLOAD_VERSION).alias("payload_version"), payload.alias("payload")),
        {"ignoreNullFields": "false"},
    )


def decode_status(value: Column) -> Column:
    """``ok``, ``legacy`` (no envelope), ``unsupported`` (other version) or ``corrupt``."""
    # Inside brackets, text after the first value makes the whole thing invalid or a second element.
    listed = F.try_parse_json(F.concat(F.lit("["), value, F.lit("]")))
    single = F.try_variant_get(listed, "$[1]", "variant").isNull()
    parsed = F.when(single, F.try_variant_get(listed, "$[0]", "variant"))
    kind = F.schema_of_variant(parsed)
    version = F.get_json_object(value, "$.payload_version")
    has_version = F.array_contains(F.json_object_keys(value), "payload_version")
    payload = F.schema_of_variant(F.try_variant_get(parsed, "$.payload", "variant"))
    return (
        F.when(value.isNull() | parsed.isNull(), "corrupt")
        .when(~kind.startswith("OBJECT"), "corrupt")
        .when(~F.coalesce(has_version, F.lit(False)), "legacy")
        .when(F.coalesce(version != str(K.STATE_PAYLOAD_VERSION), F.lit(True)), "unsupported")
        .when(~F.coalesce(payload.startswith("OBJECT"), F.lit(False)), "corrupt")
        .otherwise("ok")
    )


def decode_payload(value: Column) -> Column:
    """The record inside an envelope, or the bare record, as JSON text; NULL when unusable."""
    status = decode_status(value)
    return F.when(status == "ok", F.get_json_object(value, "$.payload")).when(status == "legacy", value)


__all__ = [
    "KeyedTable", "StateStore", "Store", "checkpoint_table", "commit_together", "decode_payload", "decode_status",
    "encode_payload", "fresh_folder", "latest", "records_for", "state_table",
]
