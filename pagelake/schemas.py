"""Explicit schemas of the tables that are read from outside."""

from __future__ import annotations

PAGES = "page_id long, url string, html string, fetched_at timestamp, status_code int, headers map<string,string>"
STATE = (
    "id long, first_seen_at timestamp, last_seen_at timestamp, content_hash string, "
    "source_updated_at timestamp, payload string"
)
CHECKPOINT = (
    "namespace string, next_url string, next_page long, updated_at timestamp, consecutive_known long"
)
EVENT = (
    "ts timestamp, request_id string, phase string, method string, url string, attempt int, "
    "endpoint string, proxy string, status_code int, elapsed double, bytes long, error string, "
    "error_kind string"
)
BASELINE = "surface string, tokens array<string>, structural_fingerprint string"
