"""Wall seconds of the headline queries; prints one JSON line.

BENCH_SF_DIR  table folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores  (default 8)
BENCH_RUNS    timed runs per query (default 3): `queries` holds the medians, `cold`
              the first runs, `large_plans` the medians of the plans for large tables
"""

from __future__ import annotations

import json
import os
import statistics
import time

from millrace.plans import QUERIES
from millrace.session import build_session

HEADLINE = [
    "prepared_training_table",
    "null_profile",
    "described_features",
    "positional_percentiles",
    "request_vectors",
    "point_in_time_training",
    "all_earlier_versions",
    "latest_version",
    "version_changes",
    "hash_split",
    "five_minute_windows",
    "head_to_head",
    "latency_summary",
    "mean_shift",
    "stability_index",
    "ks_shift",
    "violation_report",
    "classification_report",
    "area_under_curve",
    "document_sentiment",
    "document_entities",
    "key_phrases",
    "streamed_windows",
]

# The same with limits so low that the plans for large tables are taken.
LARGE = [
    "version_changes_chunked",
    "positional_percentiles_selected",
    "ks_shift_chunked",
    "key_phrases_shuffled",
    "document_sentiment_shuffled",
    "lookup_shuffled",
]


def run(spark, name: str, folder: str) -> float:
    began = time.monotonic()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.monotonic() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "counts_with_share", folder)  # start executors and code generation
    timed = {q: [run(spark, q, folder) for _ in range(runs)] for q in HEADLINE}
    seconds = {q: round(statistics.median(s), 3) for q, s in timed.items()}
    cold = {q: round(s[0], 3) for q, s in timed.items()}
    large = {q: round(statistics.median([run(spark, q, folder) for _ in range(runs)]), 3) for q in LARGE}
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_wall", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus), "runs": runs,
        "cold": cold, "large_plans": large,
    }))


if __name__ == "__main__":
    main()
