"""Fingerprints of pages and records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelake import constants as K


def short_sha(value: Column) -> Column:
    return F.substring(F.sha2(value, 256), 1, 16)


def content_fingerprint(html: Column) -> Column:
    """Hash of the page with its whitespace evened out, reader-visible text included."""
    return short_sha(F.trim(F.regexp_replace(html, K.WHITESPACE, " ")))


def structural_tokens(nodes: Column) -> Column:
    """Markup signals of a page that ignore its text and volatile identifiers."""
    tags = F.transform(nodes, lambda n: F.concat(F.lit("tag:"), n["tag"]))
    words = F.flatten(
        F.transform(
            F.filter(nodes, lambda n: n["cls"].isNotNull()),
            lambda n: F.split(F.trim(F.lower(n["cls"])), " "),
        )
    )
    stable = F.filter(
        words,
        lambda w: (w != "") & (F.length(w) <= K.CLASS_TOKEN_LENGTH) & ~w.rlike(K.VOLATILE_CLASS),
    )
    classes = F.transform(stable, lambda w: F.concat(F.lit("class:"), w))
    links = F.size(F.filter(nodes, lambda n: (n["tag"] == "a") & n["attrs"]["href"].isNotNull()))
    bucket = F.least(F.floor(links / 10), F.lit(10)).cast("string")
    return F.array_sort(
        F.array_distinct(F.concat(tags, classes, F.array(F.concat(F.lit("link_bucket:"), bucket))))
    )


def structural_fingerprint(tokens: Column) -> Column:
    return short_sha(F.array_join(F.array_sort(tokens), "\n"))


def jaccard(left: Column, right: Column) -> Column:
    """Shared tokens over all tokens; 1.0 when both sets are empty."""
    union = F.size(F.array_union(left, right))
    return F.when(union == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(left, right)) / union
    )


def record_hash(columns: Sequence[str | Column]) -> Column:
    """Hash of the named fields as compact JSON, NULL fields included."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
