"""Exact deduplication: a tree merge of sorted digest runs, with DataFrame functions only.

Each document becomes a digest row. Rows are dealt to runs by hash and to slices by the range of their digest; the
rows of a slice and run, equal digests already one row with the smallest identifier and their number, are kept as one
array in digest order: a sorted run. Runs then meet two by two in binomial rounds. A round lays two runs of a slice end
to end, merges them (a sort of two sorted runs is one merge), and reads the result once in order: neighbours that agree
in digest, length and a second hash become one, which keeps the smaller identifier. After the last round a slice is
one sorted run of all its digests.

Slices grow in number with the rows, so an array stays small however large the table; a hot text is one entry per run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.functions.text import let
from pagelake.llm.common import SPACES, stored

#: Runs, a power of two: the rounds are as many as its logarithm. Rows of a slice that its number aims at.
RUNS, SLICE_ROWS = 16, 4096
KEY = ["digest", "chars", "check"]


def digest_rows(docs: DataFrame, runs: int) -> DataFrame:
    """(doc_id, digest, chars, check, run) of each row; null text counts as empty."""
    text = F.regexp_replace(F.coalesce("text", F.lit("")), SPACES, " ")
    return docs.select("doc_id", text.alias("text")).select(
        "doc_id",
        F.sha2("text", 256).alias("digest"),
        F.length("text").cast("long").alias("chars"),
        F.xxhash64("text").alias("check"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(runs)).cast("int").alias("run"),
    )


def sorted_runs(first: DataFrame, slices: int) -> DataFrame:
    """(slice, run, entries): the digests of a slice and run in order; a slice is a range of the digest space."""
    place = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
    entry = F.struct(*KEY, "keep_id", "group_size").alias("entry")
    return first.select(F.floor(place * slices / 2**32).cast("int").alias("slice"), "run", entry).groupBy("slice", "run").agg(
        F.sort_array(F.collect_list("entry")).alias("entries"))


def _agree(a: Column, b: Column) -> Column:
    return F.coalesce(F.struct(*(a[k] for k in KEY)) == F.struct(*(b[k] for k in KEY)), F.lit(False))


def _one_each(merged: Column) -> Column:
    """Neighbours that agree as one entry; of two runs no more than two can."""
    def entry(e: Column, i: Column) -> Column:
        after = F.get(merged, i + 1)
        pair = _agree(after, e)
        return F.struct(
            *(e[k].alias(k) for k in KEY),
            F.when(pair, F.least(e["keep_id"], after["keep_id"])).otherwise(e["keep_id"]).alias("keep_id"),
            (e["group_size"] + F.when(pair, after["group_size"]).otherwise(F.lit(0))).alias("group_size"))

    begins = F.transform(merged, lambda e, i: F.struct(_agree(F.get(merged, i - 1), e).alias("again"), entry(e, i).alias("entry")))
    return F.transform(F.filter(begins, lambda x: ~x["again"]), lambda x: x["entry"])


def merge_round(runs: DataFrame) -> DataFrame:
    """Runs 2k and 2k + 1 of every slice merged to run k, in digest order."""
    pairs = runs.groupBy("slice", F.floor(F.col("run") / 2).cast("int").alias("run")).agg(F.collect_list("entries").alias("both"))
    return pairs.select("slice", "run", let(F.sort_array(F.flatten("both")), _one_each).alias("entries"))


def exact_groups(docs: DataFrame, runs: int = RUNS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null text equals empty text; very long texts are hashed whole. A null identifier never is the smallest unless all
    are null, then keep_id is null and the rows stay. Rows that repeat identifier and text share one decision. An
    empty table gives no rows; other columns are not looked at. ``runs`` is rounded up to a power of two.
    """
    left = 1 << max(0, runs - 1).bit_length()
    rows = stored(digest_rows(docs, left))
    slices = max(1, -(-rows.count() // slice_rows))
    first = rows.groupBy(*KEY, "run").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    level = sorted_runs(first, slices)
    while left > 1:
        level, left = merge_round(level), left // 2
    decided = level.select(F.explode("entries").alias("entry")).select("entry.*")
    # The decision goes back to the runs first: a hot digest is one row per run there.
    by_run = first.select(*KEY, "run").join(decided, KEY)
    return rows.join(by_run, [*KEY, "run"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were."""
    keep = exact_groups(docs).filter("kept").select(F.col("doc_id").alias("_keep")).distinct()
    return docs.join(keep, docs["doc_id"].eqNullSafe(keep["_keep"]), "left_semi")


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), g AS (
  SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)
"""
