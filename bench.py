"""Time the headline queries and print one JSON line.

BENCH_SF_DIR: folder of the tables; BENCH_CPUS: local cores; BENCH_RUNS: timed
runs per query after one warm-up, of which the median counts; BENCH_QUERIES:
comma-separated names, default below.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reviewcraft.plans.queries import QUERIES  # noqa: E402

HEADLINE = (
    "build_context build_context_forty stratified_topk place_metadata rating_alloc "
    "clean_text_basic detect_documents cleaned_pages resumable_clean translate_with_glossary "
    "translate_with_backend normalize_full quality_filter curated_reviews enrich_extractive "
    "enrich_resumed train_test_split chat_template_render jsonl_roundtrip"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("reviewcraft-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        timings = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(timings[1:]), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
