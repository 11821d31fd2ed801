"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from checks import registry
from pagelake.session import session

HEADLINE = [
    "c1_clean_text", "c4_money", "c5_ru_datetime", "c18_content_fingerprint", "c20_structural_tokens",
    "p11_response_class", "response_summary", "p10_robots_allowed", "e1_jaccard", "e2_drift_search",
    "x11_generic_page", "x5_links", "x15_catalog_items", "a6_page_diagnostics", "w1_dedupe_items",
    "x16_detail_pages", "x17_profile_pages", "x20_people_items", "j2_new_or_changed", "k2_state_upsert",
    "w5_failure_streaks", "w6_incremental_scan", "a2_endpoint_counters", "a5_latency_histogram",
    "t5_tumbling_metrics", "new_items_flagship",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = registry.queries(), {}
    queries["c18_content_fingerprint"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                "queries": seconds, "sf": float(sf_dir.rstrip("/").rsplit("sf", 1)[-1]),
            }
        )
    )


if __name__ == "__main__":
    main()
