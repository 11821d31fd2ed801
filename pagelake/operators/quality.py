"""Page quality: response classes, extraction status, drift, health report."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake import constants as K
from pagelake.functions.hashing import jaccard, structural_fingerprint, structural_tokens
from pagelake.functions.text import contains_any, let
from pagelake.operators import dom


def marker_count(folded: Column) -> Column:
    total = F.lit(0)
    for marker in K.STRONG_BLOCK_MARKERS:
        total = total + folded.contains(marker).cast("int")
    return total


def response_class(url: Column, html: Column, status_code: Column, scan_chars: int | None = None) -> Column:
    """``blocked``, ``auth_required``, ``rate_limited``, ``retryable``, ``http_error`` or ``ok``.

    The whole page is scanned for markers; ``scan_chars`` limits the scan where a cut-off is wanted.
    """
    sample = F.lower(html if scan_chars is None else F.substring(html, 1, scan_chars))

    def judge(s: Column) -> Column:
        return let(
            F.struct(marker_count(s["text"]).alias("n"), contains_any(s["text"], K.AUTH_MARKERS).alias("auth")),
            lambda m: F.when(
                contains_any(F.lower(url), K.BLOCK_URL_WORDS) | (m["n"] >= 2), "blocked"
            )
            .when(status_code.isin(*K.SUSPICIOUS_STATUSES) & (m["n"] >= 1), "blocked")
            .when(m["auth"], "auth_required")
            .when(status_code == 429, "rate_limited")
            .when(status_code.isin(*K.RETRY_STATUSES), "retryable")
            .when(status_code.isin(401, 403), "auth_required")
            .when(status_code >= 400, "http_error")
            .otherwise("ok"),
        )

    return let(F.struct(F.coalesce(sample, F.lit("")).alias("text")), judge)


def page_status(compat: bool = False) -> Column:
    """Extraction status of a listing page from its diagnostics columns.

    ``compat`` reports a page emptied by the type filter as drift, as a strict run does.
    """
    drift = F.when(F.coalesce(F.col("all_unknown"), F.lit(False)), "selector_drift").when(
        F.size("cards") > 0, "ok"
    )
    filtered = F.arrays_overlap("warnings", F.array(F.lit("filtered_empty")))
    ended = F.arrays_overlap("warnings", F.array(F.lit("catalog_end")))
    has_links = F.col("candidate_links_found") > 0
    if compat:
        return (
            drift.when(has_links, "selector_drift").when(filtered, "filtered_empty")
            .when(ended, "catalog_end").otherwise("empty_page")
        )
    return (
        drift.when(filtered, "filtered_empty").when(has_links, "selector_drift")
        .when(ended, "catalog_end").otherwise("empty_page")
    )


def missing_fields(**columns: Column) -> Column:
    """Names of required fields that are NULL or empty."""
    named = [
        F.when(value.isNull() | (value.cast("string") == ""), F.lit(name))
        for name, value in columns.items()
    ]
    return F.filter(F.array(*named), lambda n: n.isNotNull())


def failure_category(status: Column) -> Column:
    """Category of a failed check; NULL for a passed one."""
    entries = [F.lit(x) for pair in K.FAILURE_CATEGORIES.items() for x in pair]
    known = F.element_at(F.create_map(*entries), status)
    return F.when(status != "ok", F.coalesce(known, F.lit("unexpected_exception")))


def health_checks(pages: DataFrame, threshold: float = K.CONFIDENCE_THRESHOLD) -> DataFrame:
    """One check per page: ``surface, url, status, missing, confidence`` to passed/failed rows."""
    category = F.when(F.col("status") != "ok", failure_category(F.col("status"))).when(
        (F.size("missing") > 0) | (F.col("confidence") < threshold), "selector_drift"
    )
    return pages.select(
        "*", category.alias("failure_category"),
        F.when(category.isNull(), "passed").otherwise("failed").alias("check_status"),
    )


def surface_report(checks: DataFrame) -> DataFrame:
    """Checks summed up per surface; with fingerprints, how many structures its pages have."""
    known = "structural_fingerprint" in checks.columns
    return checks.groupBy("surface").agg(
        *([F.count_distinct("structural_fingerprint").alias("structures")] if known else []),
        F.count("*").alias("pages"),
        F.count_if(F.col("check_status") == "passed").alias("passed"),
        F.count_if(F.col("failure_category") == "selector_drift").alias("drifted"),
        F.min("confidence").alias("min_confidence"),
        F.bool_and(F.col("check_status") == "passed").alias("ok"),
    )


def overall_health(checks: DataFrame) -> DataFrame:
    """One row: healthy when every check passed."""
    return checks.agg(
        F.coalesce(F.bool_and(F.col("check_status") == "passed"), F.lit(True)).alias("ok"),
        F.count("*").alias("checks"),
    )


def structure(pages: DataFrame) -> DataFrame:
    """Structural tokens and fingerprint of every page; the HTML is dropped."""
    parsed = dom.parse_html(pages)
    keys = [c for c in pages.columns if c != "html"]
    return parsed.select(*keys, structural_tokens(F.col("nodes")).alias("tokens")).select(
        *keys, "tokens", structural_fingerprint(F.col("tokens")).alias("structural_fingerprint")
    )


def drift_against_baseline(current: DataFrame, baseline: DataFrame, on: str, tokens: str = "tokens") -> DataFrame:
    """Similarity of each page to the one baseline page of its surface.

    ``baseline`` has one row per surface.  Pages without a baseline keep a NULL similarity.
    """
    base = baseline.select(on, F.col(tokens).alias("__base"))
    return (
        current.join(base, on, "left")
        .withColumn("similarity", F.when(F.col("__base").isNotNull(), jaccard(F.col(tokens), F.col("__base"))))
        .drop("__base")
    )


def stop_if_blocked(pages: DataFrame, column: str = "response_class") -> None:
    """Abort a run before anything is written when a block page is among the input."""
    found = pages.filter(F.col(column) == "blocked").select("url").limit(1).collect()
    if found:
        raise RuntimeError(f"anti-bot page in the input: {found[0]['url']}")


def provenance(fields: Mapping[str, Column]) -> Column:
    """Map of field name to where its value came from."""
    return F.create_map(*[x for name, source in fields.items() for x in (F.lit(name), source)])
