"""Benchmark the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set). Each query runs to
completion through the no-op sink, so all of its work is timed, including
any checkpoint it writes. A warm-up pass over sf0.001 precedes the timing.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lexiflow.plans.catalog import QUERIES  # noqa: E402
from lexiflow.session import drop_stage_tables, local_session  # noqa: E402

HEADLINE = [
    "word_count_raw", "first_letter_count", "stop_words_case", "inverted_index",
    "inverted_index_tf", "single_document_words", "preprocess_documents",
    "similar_pairs_naive", "similar_pairs_prefix", "similar_pairs_overlap_ratio",
    "comparison_stats",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cpus, shuffle_partitions=max(8, cpus * 2), app="lexiflow-bench")
    # Warm the JVM (class loading, JIT, codegen) with one pass of the same
    # queries over the smallest scale, when it is present; only the runs at
    # BENCH_SF_DIR are timed.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        for name in names:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        # collect the previous query's garbage (shuffle blocks, broadcasts) so it
        # is not charged to the next one
        spark.sparkContext._jvm.System.gc()
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        drop_stage_tables(spark)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_wall",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
