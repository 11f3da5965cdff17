"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf", ...}.
Each query is run to completion with the ``noop`` sink (every row produced,
nothing collected to the driver), $BENCH_RUNS times (default 2) after a JVM
warm-up on the smallest data set; a query's time is its fastest run, and
``value`` is the sum over the headline queries.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from docsift import catalog  # noqa: E402
from docsift.session import local_session  # noqa: E402

HEADLINE = [
    "extract_long",        # full three levels over cards + screens (rules, fallback, merge)
    "rules_documents",     # both rule banks over every prose document, whole texts
    "cache_split",         # two runs over the documents, second one against the cache
    "stats_overall",       # report totals from a full extraction
    "missing_requests",    # fallback request queue with rendered prompts
    "content_hash",        # SHA-256 of every document
    "first_page",          # first page per document from a page table
    "rules_sistema_produto",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = local_session(cpus, int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), app="docsift-bench")
    qs = catalog.queries()

    # warm-up (JIT, codegen caches): the headline queries once on the smallest data set
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in HEADLINE:
        qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    runs = int(os.environ.get("BENCH_RUNS", "2"))
    times: dict[str, float] = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(runs):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - t0)
        times[name] = round(best, 3)

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    jobs = (spark.read.parquet(f"{sf_dir}/customer.parquet").count()
            + spark.read.parquet(f"{sf_dir}/orders.parquet").count())
    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": int(cpus),
        "runs": runs,
        "extract_jobs_per_sec": round(jobs / times["extract_long"], 1),
        "documents_per_sec_rules": round(docs / times["rules_documents"], 1),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
