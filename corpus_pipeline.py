"""The corpus pipeline: documents through five operators, each stage on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.llm import decontaminate, line_dedup, mixing, ngram_join, toxicity
from pagelake.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the toxicity threshold; the models learn from ``labels`` and the texts of ``documents``.

    Null, empty and wordless texts have no evidence and stay; very long ones are scored whole; repeated rows alike.
    With too few labels of a class to fit a model all documents stay. An empty table gives no rows; columns of any
    name pass through.
    """
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def cut_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines of any length that many sites share; n_chars follows the text.

    Null texts stay null, empty ones empty. The first document of a line keeps it, of equal identifiers all rows do.
    An empty table gives no rows; columns of any name pass through.
    """
    return _recounted(line_dedup.cut_boilerplate(docs), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of every group of similar ones.

    Null and empty texts are similar to nothing and stay. Rows that repeat a doc_id stay or go together. An empty
    table gives no rows; columns of any name pass through.
    """
    return ngram_join.one_of_each(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; those that are mostly benchmark go. n_chars follows the text.

    Null and empty texts are hit by nothing and stay, and so does every document where ``benchmark`` is empty. An
    empty table gives no rows; columns of any name pass through.
    """
    return _recounted(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes: doc_id, source, size, source_size, target, copies, taken.

    Null and empty texts have size 0 and are never taken; a null source is a source of its own. An empty table gives
    no rows; other columns are not looked at.
    """
    return mixing.mix(docs)


def _recounted(changed: DataFrame, like: DataFrame) -> DataFrame:
    if "n_chars" in like.columns:
        kind = dict(like.dtypes)["n_chars"]
        changed = changed.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return changed.select(*like.columns)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_boilerplate),
    ("ngram_join", drop_near_copies),
    ("decontamination", cut_benchmark),
    ("mixing", mix_sources),
]

#: Scores of a fitted model have no SQL; the tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``; every stage is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
