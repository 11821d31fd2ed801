"""Cross-site boilerplate lines by distinct-site spread, with DataFrame functions only.

A line is the text between line feeds, compared after white space is collapsed. Every line hash gets
one HyperLogLog sketch of the sites (``source``) that use it; sketches of partitions merge in the
aggregation, so a line found everywhere costs one sketch per task. A line clearly above ``min_sites``
is boilerplate, one clearly below is not, and for those near the threshold distinct sites are
counted exactly. Boilerplate goes from every document but the first (smallest doc_id) that has it.
A document that consists of boilerplate only is a copy of another page rather than a page with
boilerplate on it: it stays whole and is left to deduplication. Lines of every length take part; the hashes of
all lines are computed and stored once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import NOT_SPACES, SPACES, free_name, stored

LOG_K = 10
#: Three standard errors of a sketch with 2 ** LOG_K registers.
NEAR = 3 * 1.04 / 2 ** (LOG_K / 2)


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _normal(line: Column) -> Column:
    return F.trim(F.regexp_replace(line, SPACES, " "))


def _hash(normal: Column) -> Column:
    return F.xxhash64(normal)


def _row_key() -> list[Column]:
    """What tells rows apart: the identifier, or where it is null the text, so that null ones do not meet in one group."""
    other = F.when(F.col("doc_id").isNull(), F.xxhash64("text", "source")).otherwise(F.lit(0).cast("long"))
    return [F.col("doc_id"), other.alias("other")]


def line_rows(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, other, site, line_hash) of every distinct line of at least ``min_words`` words in each row, stored once."""
    normal = F.filter(
        F.transform(lines_of(F.col("text")), _normal),
        lambda x: F.regexp_count(x, F.lit(NOT_SPACES)) >= min_words if min_words > 1 else x != "",
    )
    return stored(docs.select(*_row_key(), F.coalesce("source", F.lit("")).alias("site"),
                              F.explode(F.array_distinct(F.transform(normal, _hash))).alias("line_hash")))


def spread_lines(rows: DataFrame, min_sites: int) -> DataFrame:
    """(line_hash, first_id) of the lines used on at least ``min_sites`` sites."""
    # Most lines have one site only; such a line needs no sketch and its group never leaves two values.
    sketched = stored(
        rows.groupBy("line_hash")
        .agg(F.hll_sketch_agg("site", F.lit(LOG_K)).alias("sketch"), F.min("doc_id").alias("first_id"))
        .withColumn("sites", F.hll_sketch_estimate("sketch"))
        .filter(F.col("sites") >= min_sites * (1 - NEAR))
        .select("line_hash", "first_id", "sites")
    )
    clear = F.col("sites") >= min_sites * (1 + NEAR)
    near = sketched.filter(~clear)
    exact = (
        rows.join(near.select("line_hash"), "line_hash", "left_semi")
        .groupBy("line_hash", "site").agg(F.lit(1).alias("one"))
        .groupBy("line_hash").agg(F.count("one").alias("n"))
        .filter(F.col("n") >= min_sites)
    )
    near = near.join(exact.select("line_hash"), "line_hash", "left_semi")
    return sketched.filter(clear).select("line_hash", "first_id").unionByName(near.select("line_hash", "first_id"))


def _judged(docs: DataFrame, min_sites: int, min_words: int) -> tuple[DataFrame, str]:
    """``docs`` with a new column, under the name given back, that holds kept lines (null where none goes)."""
    rows = line_rows(docs, min_words)
    spread = stored(spread_lines(rows, min_sites))
    # Boilerplate hashes of each row of ``docs``: a text has no more of them than lines.
    flagged = (
        rows.join(spread, "line_hash").groupBy("doc_id", "other")
        .agg(F.collect_set("line_hash").alias("every"),
             F.collect_set(F.when(~F.col("doc_id").eqNullSafe(F.col("first_id")), F.col("line_hash"))).alias("gone"))
        .filter(F.size("gone") > 0)
    )
    name, key = free_name(docs, "flags"), _row_key()
    right = flagged.select(F.struct("doc_id", "other", "every", "gone").alias(name))
    met = docs.join(right, key[0].eqNullSafe(F.col(f"{name}.doc_id")) & (key[1] == F.col(f"{name}.other")), "left")
    hashed = F.transform(lines_of(F.col("text")), lambda x: F.struct(x.alias("line"), F.nullif(_normal(x), F.lit("")).alias("normal")))
    every, gone = F.col(f"{name}.every"), F.col(f"{name}.gone")
    own = F.exists(hashed, lambda x: x["normal"].isNotNull() & ~F.array_contains(every, _hash(x["normal"])))
    left = F.filter(hashed, lambda x: x["normal"].isNull() | ~F.array_contains(gone, _hash(x["normal"])))
    kept = F.when(gone.isNotNull() & own, F.transform(left, lambda x: x["line"]))
    return met.withColumn(name, kept), name


def _text_left(name: str) -> Column:
    return F.when(F.col(name).isNotNull(), F.array_join(name, "\n")).otherwise(F.col("text"))


def cut_boilerplate(docs: DataFrame, min_sites: int = 10, min_words: int = 1) -> DataFrame:
    """``docs`` with boilerplate lines cut from ``text``, all other columns as they were, whatever their names.

    Null texts stay null and have no boilerplate; null sources are one site. Line feeds between lines that stay are
    kept, so an untouched text is returned byte for byte, however long. Rows with one doc_id share their flags, which
    never depend on the row; a null doc_id is never the first. An empty table gives no rows.
    """
    met, name = _judged(docs, min_sites, min_words)
    return met.withColumn("text", _text_left(name)).select(*docs.columns)


def remove_boilerplate(docs: DataFrame, min_sites: int = 10, min_words: int = 1) -> DataFrame:
    """``cut_boilerplate`` with n_lines, n_removed and text_before added, in place of columns of these names."""
    met, name = _judged(docs, min_sites, min_words)
    lines = F.size(lines_of(F.col("text"))).cast("long")
    base = [c for c in docs.columns if c not in ("text", "n_lines", "n_removed", "text_before")]
    return met.select(
        *base, _text_left(name).alias("text"), F.col("text").alias("text_before"), lines.alias("n_lines"),
        F.when(F.col(name).isNotNull(), lines - F.size(name)).otherwise(F.lit(0)).cast("long").alias("n_removed"),
    )


def digests(docs: DataFrame, min_sites: int = 10, min_words: int = 1) -> DataFrame:
    return remove_boilerplate(docs.select("doc_id", "text", "source"), min_sites, min_words).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS site, text,
         list_transform(string_split(coalesce(text, ''), chr(10)),
           lambda x: {'raw': x, 'normal': trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'))}) AS lines
  FROM documents
), l AS (
  SELECT DISTINCT doc_id, site, u.normal AS line FROM (SELECT doc_id, site, unnest(lines) AS u FROM d)
  WHERE u.normal <> ''
), s AS (
  SELECT line, min(doc_id) AS first_id FROM l GROUP BY line HAVING count(DISTINCT site) >= 10
), f AS (
  SELECT doc_id, list(line) AS every, list(line) FILTER (WHERE doc_id <> first_id) AS gone
  FROM l JOIN s USING (line) GROUP BY doc_id
), r AS (
  SELECT d.doc_id, d.text, lines,
    coalesce(len(gone), 0) > 0
      AND len(list_filter(lines, lambda x: x.normal <> '' AND NOT list_contains(every, x.normal))) > 0 AS cut,
    list_filter(lines, lambda x: NOT list_contains(coalesce(gone, []), x.normal)) AS kept
  FROM d LEFT JOIN f USING (doc_id)
)
SELECT doc_id, len(lines)::BIGINT AS n_lines,
       CASE WHEN cut THEN len(lines) - len(kept) ELSE 0 END::BIGINT AS n_removed,
       sha256(CASE WHEN cut THEN array_to_string(list_transform(kept, lambda x: x.raw), chr(10))
              ELSE coalesce(text, '') END) AS text_sha256
FROM r
"""
