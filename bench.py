"""Benchmark: runs the headline queries and prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]

Each query is fully computed with the ``noop`` sink (no collect to the
driver); the metric is the sum of per-query wall times. An untimed warm-up
runs first: a scan and aggregate of ``documents`` with a regex, and the
headline queries once on the smallest tables (``BENCH_WARM_DIR``, default
the sibling ``sf0.001`` folder; nothing is cached, only the JVM's JIT,
generated-code compilation and the Python workers are warm). Its time is
printed to stderr; ``BENCH_COLD=1`` leaves it out and so measures cold.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "top_words", "top_phrases", "describe_text", "describe_numeric", "context_length_hist",
    "clean_pages", "clean_pairs", "na_and_dedup", "vocab",
    "encode_features", "ensemble_select", "leaderboard", "bootstrap_rouge",
    "textrank_keywords", "keywords_text", "answer_requests",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from quillpair.plans.queries import QUERIES
    from quillpair.session import local_session
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="quillpair-bench",
                          scan_partitions=int(cpus) * 2)
    t0 = time.time()
    warm_dir = os.environ.get("BENCH_WARM_DIR",
                              os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001"))
    if not os.environ.get("BENCH_COLD"):
        (spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
         .selectExpr("sum(size(split(lower(text), '\\\\s+'))) AS n").collect())
        if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
            for name in names:
                QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
        print(f"# warm-up (untimed): {round(time.time() - t0, 3)}s", file=sys.stderr)
    times = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
