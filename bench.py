"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES (comma-separated names, or ``all``) select the run.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "prj06_json_priority",
    "prj08_merge_all",
    "ag01_overlap_statistics",
    "val02_validate_studies",
    "jn03_sites_within_radius",
    "jn04_site_catchment",
    "jn05_region_coverage",
    "tx14_hybrid_retrieval",
    "tx11_batch_knn",
    "tx12_approximate_knn",
    "tx13_full_text_match",
    "tx01_token_features",
    "tx05_tfidf",
    "tx06_trigrams",
    "tx07_wn07_chunks",
    "tx08_eligibility_clauses",
    "wn06_top_words",
    "ag11_value_statistics",
    "ag16_record_sizes",
    "sl04_second_page",
    "ln07_snapshot_delta",
    "ln08_wn02_wn03_scd2",
    "jn08_as_of_lookup",
    "jn10_ln04_descendants",
    "gr02_edges",
    "gr03_landscape",
    "gr04_ag19_sponsor_portfolio",
    "gr04_ag20_endpoint_strategy",
    "gr05_k_hop",
    "src05_src06_ag08_mart_export",
    "st01_st06_upsert",
]


def main() -> None:
    from trialspark.plans import registry
    from trialspark.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = registry.load()
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(queries) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    queries["jn05_region_coverage"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
