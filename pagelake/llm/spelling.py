"""Spelling variants of the frequent words of a corpus, by a dictionary of pairs of trie nodes.

Two words are near if one inserted, deleted or replaced code point makes them equal. Leave out position i of a
word: what stands before is a node of the trie of all words, what follows is a node of the trie of all reversed
words, and the pair of their numbers names the rest exactly. Two words that share such a pair differ by a
replacement; a word whose pair equals a cut of another word (a prefix node and a suffix node that make it up) has one
code point more. So equi-joins of integer pairs find all neighbours and nothing else: no candidate is verified.
Nor is there a hot pair: the words of one pair differ in one code point only, so they are as many as the alphabet.

Trie nodes are numbered over sorted words: a word adds the nodes below the prefix that it shares with the word
before. Every range of the sorted words numbers its own new nodes; one row per range (its first and last word, the
path to the last) then tells where its numbers start and which nodes come from earlier ranges. The same walk gives
each word its rank in code-point order.
"""

from __future__ import annotations

import os.path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import stored

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of one range of a sorted trie; a task walks one range.
RANGE = 20_000
MIN_LENGTH, MIN_COUNT, RATIO, DAMAGE = 6, 5, 5, 199


def damaged(doc_id: Column, word: Column, every: int) -> Column:
    """``word`` without one code point, if the checksum of identifier and word is a multiple of ``every``."""
    mark = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = F.pmod(mark, F.length(word)).cast("int")
    return F.when(mark % every == 0, F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))).otherwise(word)


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, every: int = DAMAGE) -> DataFrame:
    """(word, n) of the frequent words of whole texts; runs of letters, A-Z lower-cased, some damaged as asked."""
    runs = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))
    found = docs.select("doc_id", F.explode(runs).alias("word")).select("doc_id", F.translate("word", UPPER, LOWER).alias("word"))
    return (
        found.select(damaged(F.col("doc_id"), F.col("word"), every).alias("word"))
        .filter(F.length("word") >= min_length)
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)
    )


def _walk(batches):
    """Rows of one sorted range with their place and the range's own numbers of the nodes on their path."""
    part = TaskContext.get().partitionId()
    before, path, nodes, place = "", np.zeros(0, np.int32), 0, 0
    for batch in batches:
        paths = []
        for key in batch.column("key").to_pylist():
            shared = len(os.path.commonprefix((before, key)))
            new = len(key) - shared
            path = np.concatenate([path[:shared], np.arange(nodes, nodes + new, dtype=np.int32)])
            before, nodes = key, nodes + new
            paths.append(path)
        ends = np.cumsum([0, *map(len, paths)], dtype=np.int32)
        flat = pa.array(np.concatenate(paths) if paths else np.zeros(0, np.int32))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(paths), part, np.int32)), pa.array(place + np.arange(len(paths))),
             pa.ListArray.from_arrays(pa.array(ends), flat)],
            names=[*batch.schema.names, "part", "place", "path"])
        place += len(paths)


def trie_nodes(words: DataFrame, key: Column, total: int, in_range: int = RANGE) -> DataFrame:
    """``words`` with ``nodes`` (the trie node of every prefix of ``key``, the empty one first) and ``rank`` of the key.

    Equal prefixes have equal numbers, different ones different numbers. ``words`` holds distinct keys that are not
    empty and have at most 2**31 code points in a range. The driver gets one row per range.
    """
    sorted_words = words.withColumn("key", key).repartitionByRange(max(1, -(-total // in_range)), "key").sortWithinPartitions("key")
    kinds = ", ".join(f"`{c}` {t}" for c, t in sorted_words.dtypes)
    walked = stored(sorted_words.mapInArrow(_walk, f"{kinds}, part int, place bigint, path array<int>"))
    ranges = walked.groupBy("part").agg(
        F.min("key").alias("first"), F.max("key").alias("last"), F.max_by("path", "key").alias("path"),
        (F.max(F.array_max("path")) + 1).alias("nodes"), F.count(F.lit(1)).alias("rows"),
    ).orderBy("part").collect()
    carried, last, base, rank = [], "", 1, 0
    on_last: list[int] = []
    for r in ranges:
        shared = len(os.path.commonprefix((last, r["first"])))
        own, start = on_last[:shared], base - shared
        carried.append((r["part"], shared, own, start, rank))
        on_last = [own[x] if x < shared else start + x for x in r["path"]]
        last, base, rank = r["last"], start + r["nodes"], rank + r["rows"]
    starts = words.sparkSession.createDataFrame(carried, "part int, shared int, own array<bigint>, start bigint, above bigint")
    number = F.transform("path", lambda x: F.when(x < F.col("shared"), F.get("own", x)).otherwise(F.col("start") + x))
    return walked.join(F.broadcast(starts), "part").select(
        *words.columns, F.concat(F.array(F.lit(0).cast("long")), number).alias("nodes"), (F.col("above") + F.col("place")).alias("rank"))


def near_pairs(words: DataFrame, in_range: int = RANGE) -> tuple[DataFrame, DataFrame]:
    """(words with their rank, (rank, other, other_n) of all near pairs in both directions, each once)."""
    total = words.count()
    forward = trie_nodes(words, F.col("word"), total, in_range)
    backward = trie_nodes(words.select("word"), F.reverse("word"), total, in_range)
    both = stored(
        forward.withColumnRenamed("nodes", "f").join(backward.select("word", F.col("nodes").alias("b")), "word")
    )
    length = F.length("word")
    cuts = both.select("word", "rank", "n", "b", F.posexplode("f").alias("i", "p"))
    # Of a run of one code point any position leaves the same rest; only the first of them meets the cuts.
    own = (F.col("i") == 0) | (F.substring("word", F.col("i") + 1, F.lit(1)) != F.substring("word", F.col("i"), F.lit(1)))
    skips = cuts.filter(F.col("i") < length).select("p", F.get("b", length - 1 - F.col("i")).alias("s"), "rank", "n", own.alias("own"))
    cuts = cuts.select("p", F.get("b", length - F.col("i")).alias("s"), "rank", "n")

    def other(df):
        return df.select("p", "s", F.col("rank").alias("other"), F.col("n").alias("other_n"))

    replaced = skips.join(other(skips), ["p", "s"]).filter("rank < other").select("rank", "n", "other", "other_n")
    inserted = skips.filter("own").join(other(cuts), ["p", "s"]).select("rank", "n", "other", "other_n")
    each = replaced.unionByName(inserted).select(F.explode(F.array(
        F.struct("rank", "other", "other_n"),
        F.struct(F.col("other").alias("rank"), F.col("rank").alias("other"), F.col("n").alias("other_n")),
    )).alias("x")).select("x.*")
    return both.select("word", "n", "rank"), each


def roots(steps: DataFrame) -> DataFrame:
    """(rank, root) of every row of (rank, form): forms followed to the last, in rounds that double the stride.

    A form has several times the count of its word, so there is no circle and a chain is short.
    """
    spread = stored(steps.select("rank", F.col("form").alias("root")))
    while True:
        onward = spread.select(F.col("rank").alias("root"), F.col("root").alias("next"))
        spread = stored(spread.join(onward, "root", "left").select(
            "rank", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if not spread.filter("moved").limit(1).count():
            return spread.select("rank", "root")
        spread = spread.select("rank", "root")


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO,
             every: int = DAMAGE, in_range: int = RANGE) -> DataFrame:
    """One row per frequent word: word, form, root, n, n_near, form_n.

    Null and empty texts have no words; a null doc_id counts as empty text in the checksum. Repeated rows count as
    often as they stand there. Ties between near words go to the smaller in code-point order. An empty table, or one
    without frequent words, gives no rows; other columns are not looked at.
    """
    words = stored(word_counts(docs, min_length, min_count, every))
    ranked, pairs = near_pairs(words, in_range)
    ranked = stored(ranked)
    best = pairs.groupBy("rank").agg(
        F.count(F.lit(1)).alias("n_near"), F.max(F.struct("other_n", (-F.col("other")).alias("o"))).alias("best"))
    judged = stored(ranked.join(best, "rank", "left").select(
        "rank", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("best.other_n") >= F.col("n") * ratio, -F.col("best.o")).alias("form")))
    ends = roots(judged.filter("form IS NOT NULL").select("rank", "form"))
    names = ranked.select(F.col("rank").alias("form"), F.col("word").alias("form_word"), F.col("n").alias("form_n"))
    of_root = ends.join(ranked.select(F.col("rank").alias("root"), F.col("word").alias("root_word")), "root").select("rank", "root_word")
    found = judged.filter("form IS NOT NULL").join(names, "form").join(of_root, "rank").select("rank", "form_word", "form_n", "root_word")
    return judged.join(found, "rank", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")


SQL = """
WITH RECURSIVE sums AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]),
                          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256))::BIGINT AS i))
), runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{C0}-\\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL
), marked AS (
  SELECT w, k, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(h), 2),
      lambda j: ('0x' || substr(h, j, 2))::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM (SELECT w, k, hex(encode(doc_id || ':' || w)) AS h FROM runs), sums
), words AS MATERIALIZED (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN left(w, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word, k FROM marked)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5
), skips AS (
  SELECT word, n, i, left(word, i) || '_' || substr(word, i + 2) AS same, left(word, i) || substr(word, i + 2) AS less
  FROM words, LATERAL (SELECT unnest(range(length(word)))::INT AS i)
), near AS MATERIALIZED (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM skips AS a JOIN skips AS b ON a.same = b.same AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM skips AS a JOIN words AS b ON a.less = b.word
  UNION SELECT b.word, a.word, a.n FROM skips AS a JOIN words AS b ON a.less = b.word
), judged AS MATERIALIZED (
  SELECT word, n, n_near, CASE WHEN best_n >= 5 * n THEN best END AS form, CASE WHEN best_n >= 5 * n THEN best_n END AS form_n
  FROM words LEFT JOIN (
    SELECT word, count(*) AS n_near, max(other_n) AS best_n, (list(other ORDER BY other_n DESC, other))[1] AS best FROM near GROUP BY word
  ) USING (word)
), steps(word, last) AS (
  SELECT word, word FROM words UNION ALL SELECT s.word, j.form FROM steps AS s JOIN judged AS j ON s.last = j.word WHERE j.form IS NOT NULL
)
SELECT j.word, j.form, s.last AS root, j.n, coalesce(j.n_near, 0) AS n_near, j.form_n
FROM judged AS j JOIN steps AS s USING (word) JOIN judged AS e ON e.word = s.last AND e.form IS NULL
"""
