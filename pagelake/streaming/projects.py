"""The ``projects`` verb over pages that arrive in any order, in any number of micro-batches.

Every crawl has a row of traversal state: the next page it waits for, whether its end was reached, and the pages
that came before their turn. A page is released when all pages before it were; its items then pass the filters and
leave once per id, so what has been emitted is at any time what the batch verb gives for the pages so far. State and
emitted ids change in one commit per micro-batch, and a replayed batch replaces what its first try wrote.
"""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagelake import constants as K
from pagelake.operators import catalog, crawl
from pagelake.plans.verbs import FAILED_STATES, Extraction, chosen_pages, failed_pages, parsed_rows
from pagelake.session import materialize
from pagelake.sources.state import KeyedTable, Store

WAITING = "array<struct<page:int,batch:bigint,last:boolean>>"
CRAWLS = f"crawl string, next_page int, ended boolean, stuck_since bigint, waiting {WAITING}"
EMITTED = "key string"


def crawl_states(store: Store) -> KeyedTable:
    return store.table("crawls", CRAWLS, "crawl")


def emitted_ids(store: Store) -> KeyedTable:
    return store.table("emitted", EMITTED, "key")


def _item_key() -> Column:
    return F.concat_ws("\x1f", F.col("crawl"), F.col("id").cast("string"))


def advance(states: DataFrame, arrived: DataFrame, batch: int, start_page: int = 1, patience: int | None = None) -> DataFrame:
    """Traversal states after the pages of a batch, with ``released``: the pages whose turn has come.

    ``arrived``: ``crawl, page, last`` of each arrived page; ``states``: rows of earlier batches for these crawls, with
    nulls for new ones. Pages behind the next one, and all after the end, are left out. With ``patience`` a missing
    page is given up when its crawl comes up that many batches later.
    """
    new = arrived.groupBy("crawl").agg(
        F.collect_list(F.struct(F.col("page").cast("int").alias("page"), F.lit(batch).cast("long").alias("batch"), "last")).alias("new"))
    joined = new.join(states, "crawl", "left").select(
        "crawl", F.coalesce("next_page", F.lit(start_page)).alias("from_page"), F.coalesce("ended", F.lit(False)).alias("ended"),
        "stuck_since", F.concat(F.coalesce("waiting", F.array().cast(WAITING)), "new").alias("all"),
    )
    # Of a page that came twice the first stays; structs sort by page, then batch.
    ahead = F.array_sort(F.filter("all", lambda p: (p["page"] >= F.col("from_page")) & ~F.col("ended")))
    once = joined.withColumn("ahead", ahead).withColumn(
        "ahead", F.filter("ahead", lambda p, i: (i == 0) | (F.get("ahead", i - 1)["page"] != p["page"])))
    first = F.get("ahead", F.lit(0))["page"]
    given_up = F.lit(False) if patience is None else F.coalesce(F.lit(batch) - F.col("stuck_since") >= patience, F.lit(False))
    placed = once.withColumn("from_page", F.when(given_up & first.isNotNull(), first).otherwise(F.col("from_page")))
    # Pages are distinct and sorted: the i-th is at its place exactly if none before it is missing.
    run = placed.withColumn("run", F.filter("ahead", lambda p, i: p["page"] == F.col("from_page") + i))
    ends = F.filter(F.transform("run", lambda p, i: F.when(p["last"], i)), lambda i: i.isNotNull())
    done = run.withColumn("end", F.get(ends, F.lit(0))).withColumn(
        "released", F.when(F.col("end").isNotNull(), F.slice("run", F.lit(1), F.col("end") + 1)).otherwise(F.col("run")))
    left = F.when(F.col("end").isNull(), F.slice("ahead", F.size("run") + 1, F.size("ahead"))).otherwise(F.array().cast(WAITING))
    return done.withColumn("waiting", left).select(
        "crawl", (F.col("from_page") + F.size("released")).cast("int").alias("next_page"),
        (F.col("ended") | F.col("end").isNotNull()).alias("ended"),
        F.when((F.size("waiting") > 0) & (F.size("released") == 0), F.coalesce("stuck_since", F.lit(batch).cast("long")))
        .when(F.size("waiting") > 0, F.lit(batch).cast("long")).alias("stuck_since"),
        "waiting", "released",
    )


def stream_projects(
    pages: DataFrame,
    path: str,
    checkpoint: str,
    page_count: int | str = "all",
    start_page: int = 1,
    query: str | None = None,
    category: str | None = None,
    min_budget: Decimal | int | None = None,
    max_budget: Decimal | int | None = None,
    types: str | Iterable[str] | None = None,
    with_budget: bool | None = None,
    timezone: str = K.DEFAULT_TIMEZONE,
    crawl_key: str | None = None,
    selectors: catalog.Selectors = catalog.SELECTORS,
    patience: int | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Items of arriving listing pages under ``path``, with the arguments of the batch verb.

    ``path`` belongs to this stream and its ``checkpoint``. Pages nobody could read go to the failed channel when
    their turn comes; the stream goes on. Read the results with ``stream_results``.
    """
    chosen = crawl.item_filter(types, query=query, min_budget=min_budget, max_budget=max_budget, with_budget=with_budget)
    store = Store(pages.sparkSession, path)

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prepared = chosen_pages(batch, page_count, start_page, crawl_key, category)
        rows = parsed_rows(prepared, types, timezone, True, selectors)
        rows.write.mode("overwrite").parquet(f"{path}/staged/batch={batch_id}")
        staged = spark.read.schema(rows.schema).parquet(f"{path}/staged/batch={batch_id}")
        unreadable = F.col("page_status").isin(*FAILED_STATES)
        arrived = staged.groupBy("crawl", "page").agg(F.first(~F.col("has_next") & ~unreadable).alias("last"))
        states, emitted = crawl_states(store), emitted_ids(store)
        before = states.lookup(arrived.select("crawl").distinct(), batch_id)
        after = materialize(advance(before, arrived, batch_id, start_page, patience))

        turns = after.select("crawl", F.explode("released").alias("p")).select("crawl", "p.page", "p.batch")
        batches = [r[0] for r in turns.select("batch").distinct().collect()]
        folders = [f"{path}/staged/batch={b}" for b in batches]
        held = spark.read.schema(f"{_ddl(rows)}, batch bigint").option("basePath", f"{path}/staged").parquet(*folders) if folders else None
        released = rows.limit(0) if held is None else held.join(turns, ["crawl", "page", "batch"], "left_semi").drop("batch")
        released = materialize(released)
        unique = crawl.dedupe_items(released.filter(F.col("id").isNotNull() & chosen.condition()), crawl_key="crawl")
        keyed = materialize(unique.withColumn("key", _item_key()))
        known = emitted.contains(keyed.select("key"), batch_id)
        fresh = materialize(keyed.join(known, "key", "left_anti"))
        fresh.drop("key").write.mode("overwrite").parquet(f"{path}/ok/batch={batch_id}")
        failed_pages(released).write.mode("overwrite").parquet(f"{path}/failed/batch={batch_id}")
        store.commit(batch_id, {states: after.drop("released"), emitted: fresh.select("key")})

    writer = pages.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)


def stream_results(spark: SparkSession, path: str) -> Extraction:
    """What ``stream_projects`` has emitted so far, of committed batches only."""
    batches = [f.batch for f in crawl_states(Store(spark, path)).folders()]
    if not batches:
        raise ValueError(f"no batch was committed under {path}")

    def channel(name: str) -> DataFrame:
        found = spark.read.option("basePath", f"{path}/{name}").parquet(*[f"{path}/{name}/batch={b}" for b in batches])
        return found.drop("batch")

    return Extraction(channel("ok"), channel("failed"))
