"""Print the physical plans of the headline queries (what PLANS.md was made from).

Usage: python scripts/show_plans.py [sf_dir] > PLANS.md
For each query: exchanges, aggregates, joins, generators and scans with their
read schema and pushed filters, in plan order (AQE initial plan).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from docsift import catalog  # noqa: E402
from docsift.operators.extract import prepare_jobs, scan  # noqa: E402
from docsift.session import local_session  # noqa: E402
from docsift.sources import tables as T  # noqa: E402

KEEP = ("Exchange", "Aggregate", "Join", "Generate", "FileScan", "Scan ", "WholeStageCodegen",
        "ArrowEvalPython", "MapInPandas", "Window", "Sort ", "Union")
NAMES = ["rules_documents", "extract_long", "stats_overall", "cache_split", "first_page", "zero_pages",
         "content_hash"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    qs = catalog.queries()
    print(f"# Physical plans at {sf_dir}\n")
    print("Generated by `scripts/show_plans.py`. Extraction queries materialize their scan and")
    print("per-key tables first (parquet under the checkpoint folder), so their plans below start")
    print("from those tables; the rules' plan is shown by `rules_documents`.\n")
    jobs = prepare_jobs(T.documents_jobs(spark, sf_dir), request="request")
    scanned = scan(jobs)
    keys = (scanned.filter(F.col("error_class").isNull()).groupBy("cache_key")
            .agg(F.min("job_id").alias("first_job_id"), F.count(F.lit(1)).alias("n_jobs")))
    frames = [("scan (extract step 1, documents: keys only; Project lines cut to their first 90 characters)", scanned),
              ("per-key first writer (extract step 2)", keys)]
    frames += [(name, qs[name](spark, sf_dir)) for name in NAMES]
    for name, df in frames:
        # AQE's initial plan does not show codegen stages (they are fused per query stage at
        # run time); the two extract steps are printed without AQE so the `*(n)` stages show.
        if name.startswith(("scan", "per-key")):
            spark.conf.set("spark.sql.adaptive.enabled", "false")
            plan = df._jdf.queryExecution().executedPlan().toString()
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        else:
            plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"## {name}\n\n```")
        for line in plan.split("\n"):
            if any(k in line for k in KEEP) or "Project [" in line:
                line = re.sub(r"Location: InMemoryFileIndex\(\d+ paths\)\[[^\]]*\], ", "", line)
                line = re.sub(r"#\d+L?", "", line)
                print(line[:90] + " ..." if "Project [" in line else line[:220])
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
