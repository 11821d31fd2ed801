"""Connected components of a table of links, by rounds of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import stored


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).collect()[0]
    return row["n"], row["x"]


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b) but the components' smallest ids themselves.

    Each round hangs all neighbours of an id on the smallest one; joins on an id are equi-joins whose
    other side has one row per id, and minima are taken before the shuffle. It ends when a round
    changes nothing, after about log2 of the longest path rounds. Links of an id with itself and
    repeated links do not matter.
    """
    edges = stored(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # every u of ``large`` is above its v
        large = stored(large.unionByName(least.filter("m < u").select("u", F.col("m").alias("v"))).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(low.withColumnRenamed("m", "v")).distinct())
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
