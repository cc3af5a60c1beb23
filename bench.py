"""Headline queries on one machine; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local threads.
Each query is run to completion; its time is the best of ``BENCH_RUNS`` (1).
"""

from __future__ import annotations

import json
import os
import time

from kindred.plans.catalog import QUERIES
from kindred.session import local_session

HEADLINE = [
    "similar_topk", "similar_topk_position", "budget_replacement", "hidden_gems_reference", "hidden_gems_centroid",
    "hybrid_blocks_alpha", "blend_rerank", "description_search", "eval_position_summary", "eval_comparison_grouping_sets",
    "fuzzy_join_cascade", "name_resolution", "entity_link_jaccard", "benchmark_alignment", "squad_append_impute",
    "standardise_features", "pca_features", "radar_profiles", "quality_iqr", "quality_bounds", "eda_correlation",
    "eda_value_hist", "transfer_dedup", "per90_rates", "name_normalise", "request_parsing", "html_links",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "kindred-bench")
    spark.sparkContext.setLogLevel("ERROR")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    QUERIES[HEADLINE[0]](spark, sf_dir).count()  # start Python workers before the clock
    times: dict[str, float] = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(min(taken), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
