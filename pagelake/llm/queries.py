"""The registered queries of the operators and the SQL they are checked with."""

from __future__ import annotations

from pagelake.llm import (
    centroids, chat, decontaminate, exact_dedup, extract, line_dedup, mixing, ngram_join, quality, spelling, toxicity,
    vector_join, warc,
)
from pagelake.llm.common import table


def op1_ngram_join(spark, sf_dir):
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op2_toxicity(spark, sf_dir):
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_decontamination(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op5_warc(spark, sf_dir):
    return warc.indexed_captures(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"
    )


def op6_quality(spark, sf_dir):
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_source_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies"
    )


def op8_main_text(spark, sf_dir):
    return extract.extract(table(spark, sf_dir, "pages"))


def op9_line_dedup(spark, sf_dir):
    return line_dedup.digests(table(spark, sf_dir, "documents"))


def op10_chat_format(spark, sf_dir):
    return chat.read_back(chat.format_conversations(chat.with_probe(table(spark, sf_dir, "conversations"))))


def op11_centroid_clustering(spark, sf_dir):
    return centroids.clusters(table(spark, sf_dir, "embeddings"))


def op12_spelling_variants(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_vector_neighbours(spark, sf_dir):
    return vector_join.near_vectors(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_toxicity": op2_toxicity,
    "op3_decontamination": op3_decontamination,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_warc": op5_warc,
    "op6_quality": op6_quality,
    "op7_source_mixing": op7_source_mixing,
    "op8_main_text": op8_main_text,
    "op9_line_dedup": op9_line_dedup,
    "op10_chat_format": op10_chat_format,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_vector_neighbours": op13_vector_neighbours,
}

SQL = {
    "op1_ngram_join": ngram_join.SQL,
    "op3_decontamination": decontaminate.SQL,
    "op5_warc": warc.SQL,
    "op10_chat_format": chat.SQL,
    "op11_centroid_clustering": centroids.SQL,
    "op12_spelling_variants": spelling.SQL,
    "op13_vector_neighbours": vector_join.SQL,
    "op4_exact_dedup": exact_dedup.SQL,
    "op9_line_dedup": line_dedup.SQL,
}
