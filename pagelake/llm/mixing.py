"""Mixing sources to target weights by pivotal dependent rounding, with DataFrame functions only.

Every document of a source starts with the same expected number of copies, target / source size.
Its whole part is taken; the rest is a fractional copy. Two fractional documents exchange words until
one of them is all in or all out; the direction is drawn with the probabilities that leave both
expectations as they were. Words are the mass that moves, so a source keeps its total whatever the
lengths are. A block of documents is folded by itself and leaves one fractional document, these meet
in the next level of the tree, and so on; the last one of a source gives that part of its words.
Draws are hashes of identifiers: reruns agree, and so do other partitionings.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import NOT_SPACES, stored, words_count

BLOCK = 128
#: What is rounded: a document with its draw, size, and the words of it that are not settled.
UNIT = "struct<draw:bigint,doc_id:{id},size:bigint,words:double>"


def targets(sizes: DataFrame, budget: float, weights: list[float], most: float) -> DataFrame:
    """(source, source_size, target) from one row per source (source, source_size).

    Sources in code-point order, null last, get the weights in turn; a target stops at ``most`` times
    its source, and what is over is shared again by weight. Water filling needs no rounds: sources
    fill up in the order of size / weight, so the fill level is found with running sums over the
    sources, of which there is one row each.
    """
    by_name = F.row_number().over(_ordered("_last", "_name"))
    by_cap = _ordered("_ratio", "_rank")
    ranked = (
        sizes.withColumn("_last", F.col("source").isNull())
        .withColumn("_name", F.col("source").cast("binary"))
        .withColumn("_rank", by_name)
        .withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") - 1) % len(weights) + 1))
        .withColumn("_cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("_ratio", F.col("_cap") / F.col("_w"))
    )
    everything = _ordered("_ratio", "_rank").rowsBetween(-(2**63), 2**63 - 1)
    # Were every source up to here full, the others would share what is left by weight.
    filled = (
        ranked.withColumn("_all", F.sum("source_size").over(everything) * F.lit(budget))
        .withColumn("_w_left", F.sum("_w").over(by_cap.rowsBetween(0, 2**63 - 1)))
        .withColumn("_before", F.coalesce(F.sum("_cap").over(by_cap.rowsBetween(-(2**63), -1)), F.lit(0.0)))
        .withColumn("_level", (F.col("_all") - F.col("_before")) / F.col("_w_left"))
        .withColumn("_open", F.when(F.col("_level") < F.col("_ratio"), F.col("_level")))
        .withColumn("_fill", F.first("_open", ignorenulls=True).over(everything))
    )
    share = F.least(F.col("_cap"), F.coalesce(F.col("_fill") * F.col("_w"), F.col("_cap")))
    return filled.select("source", "source_size", share.alias("target"))


def _ordered(*names: str):
    from pyspark.sql import Window

    return Window.orderBy(*[F.col(n) for n in names])


def _step(state: Column, unit: Column) -> Column:
    """Exchange words between the open document of ``state`` and ``unit``; what is settled joins ``done``."""
    a, b = state["open"], unit
    give = F.least(a["words"], b["size"] - b["words"])
    take = F.least(a["size"] - a["words"], b["words"])
    luck = F.pmod(F.xxhash64(a["draw"], b["draw"], a["doc_id"], b["doc_id"]), F.lit(1 << 52)) / F.lit(float(1 << 52))
    move = F.when(luck * (give + take) < take, -give).otherwise(take)
    a_words, b_words = a["words"] + move, b["words"] - move

    def unit_of(u: Column, words: Column) -> Column:
        return F.struct(u["draw"].alias("draw"), u["doc_id"].alias("doc_id"), u["size"].alias("size"),
                        words.alias("words"))

    a_open = (a_words > 1e-9) & (a_words < a["size"] - 1e-9)
    settled = F.when(a_open, unit_of(b, b_words)).otherwise(unit_of(a, a_words))
    stays = F.when(a_open, unit_of(a, a_words)).otherwise(unit_of(b, b_words))
    return F.struct(stays.alias("open"), F.concat(state["done"], F.array(settled)).alias("done"))


def _fold(units: Column, unit: str) -> Column:
    """(open, done) of one block of structs of type ``unit``: its first unit meets all others in turn."""
    start = F.struct(F.element_at(units, 1).alias("open"), F.array().cast(f"array<{unit}>").alias("done"))
    return F.aggregate(F.slice(units, 2, F.size(units)), start, _step)


def mix(
    docs: DataFrame, budget: float = 1.5, weights: list[float] = (3.0, 1.0, 2.0), most: float = 2.0
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies, taken.

    ``copies`` is the exact part in copies, ``taken`` the words: size times copies, rounded once for
    the single open document of a source. Null text has size 0 and gives nothing; null sources form
    one source, the last; a null doc_id is an identifier like others. Repeated rows are separate
    documents. Ties in the draw fall to identifier and size. No table gives no rows.
    """
    base = docs.select("doc_id", "source", words_count(F.col("text")).alias("size"))
    rows = stored(base)
    aims = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), budget, list(weights), most)
    aims = stored(aims)
    left, right = rows.alias("r"), aims.alias("t")
    each = left.join(right, F.col("r.source").eqNullSafe(F.col("t.source"))).select(
        "r.doc_id", "r.source", "r.size", "t.source_size", "t.target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("_rate"),
    ).withColumn("_whole", F.floor(F.col("_rate") + 1e-12)).withColumn(
        "_words", F.greatest(F.lit(0.0), (F.col("_rate") - F.col("_whole")) * F.col("size"))
    )
    each = each.withColumn("_draw", F.xxhash64("doc_id", "source", F.lit(7)))
    is_open = (F.col("_words") > 1e-9) & (F.col("size") > 0)
    closed = each.filter(~is_open).select("doc_id", "source", "size", F.col("size") * F.lit(0.0).alias("words"))
    unit = F.struct(
        F.col("_draw").alias("draw"), "doc_id", F.col("size"),
        F.col("_words").alias("words"),
    )
    level = each.filter(is_open).select("source", unit.alias("unit"))
    done = [closed.select("doc_id", "source", "size", F.lit(0.0).alias("words"))]
    per_source = [r["n"] for r in level.groupBy("source").count().agg(F.max("count").alias("n")).collect()]
    most_units = per_source[0] or 0
    depth = 0
    while True:
        blocks = max(1, -(-most_units // BLOCK))
        block = F.pmod(F.xxhash64(F.col("unit.draw"), F.lit(depth)), F.lit(blocks))
        folded = stored(
            level.groupBy("source", block.alias("block"))
            .agg(F.array_sort(F.collect_list("unit")).alias("units"))
            .select("source", _fold(F.col("units"), UNIT.format(id=dict(docs.dtypes)["doc_id"])).alias("f"))
        )
        done.append(
            folded.select("source", F.explode("f.done").alias("u")).select("u.doc_id", "source", "u.size", "u.words")
        )
        level = folded.select("source", F.col("f.open").alias("unit"))
        if blocks == 1:
            break
        most_units, depth = blocks, depth + 1
    done.append(level.select("unit.doc_id", "source", "unit.size", "unit.words"))
    settled = reduce(DataFrame.unionByName, done).alias("s")
    return settled.join(aims.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source"))).select(
        "s.doc_id", "s.source", "s.size", "t.source_size", "t.target", _copies().alias("copies"),
        F.round(_copies() * F.col("s.size")).cast("long").alias("taken"),
    )


def _copies() -> Column:
    """Whole copies by the source's rate, and the settled part of one more."""
    rate = F.when(F.col("t.source_size") > 0, F.col("t.target") / F.col("t.source_size")).otherwise(0.0)
    part = F.when(F.col("s.size") > 0, F.col("s.words") / F.col("s.size")).otherwise(0.0)
    return F.floor(rate + 1e-12) + part


def take(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """The mixed texts: whole copies of a document, then its first words where a part is taken.

    ``plan`` comes from ``mix``; identifiers must be unique here. A part is
    its first words, one blank between them.
    """
    whole = F.floor(F.col("taken") / F.greatest(F.col("size"), F.lit(1))).cast("int")
    joined = docs.join(plan.select("doc_id", "taken", "size"), "doc_id")
    rest = (F.col("taken") - whole * F.col("size")).cast("int")
    words = F.slice(F.regexp_extract_all("text", F.lit(f"({NOT_SPACES})"), F.lit(1)), F.lit(1), rest)
    texts = F.concat(F.array_repeat("text", whole), F.when(rest > 0, F.array(F.array_join(words, " "))).otherwise(F.array()))
    return joined.withColumn("text", F.explode(texts)).select(*docs.columns)
