"""Time the headline queries from the input tables to the last row.

Prints one JSON line. Each query starts without shared results; reading the
tables, intermediate writes and the final write to a no-op sink are all in its
time. Set BENCH_SF_DIR and BENCH_CPUS to change the data and the cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from patronage.plans import registry
from patronage.session import local_session

HEADLINE = (
    "q5_quality_report",
    "e12_match_run_at_floor",
    "e12_pair_counts",
    "e13_match_clusters",
    "e18_merge_all",
    "r1_rfm_metrics",
    "r6_segments",
    "r8_segment_summary",
    "g3_segmentation_features",
    "g8_fit_clusters",
    "c12_boosted_predictions",
    "c1_purchase_summary",
    "c6_predicted_clv",
    "c11_value_features",
    "c16_value_tiers",
    "h4_retention",
    "h7_cohort_metrics",
    "d3_recent_transactions",
    "d12_segment_members",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    queries = registry.queries()
    names = sys.argv[1:] or HEADLINE

    def run(name: str) -> float:
        registry.forget()
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    # Start the JVM's code paths and the Python workers before the clock does.
    run("r8_segment_summary")
    run("e12_pair_counts")
    seconds = {name: round(run(name), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
