"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line.

Every query is run once to warm up and then BENCH_RUNS times (1); the median counts. Results
are consumed by Spark's noop sink, so all columns are computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from caselore.plans.queries import QUERIES
from caselore.session import build_session

HEADLINE = [
    "closed_cases", "newest_n_per_product", "email_threads", "note_threads", "case_documents", "classify_changes",
    "work_set_new_or_updated", "selfhelp_sections", "selfhelp_corpus", "processing_decision", "parse_gaps", "high_risk",
    "recommendations", "gap_ranking", "failure_chains", "chunks", "record_relations", "vocabulary_violations", "mentions",
    "cooccurrence", "components", "knn_cosine", "question_ranking", "report_gaps", "document_record",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in names:
        run(spark, name, sf_dir)
        timings[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3)
        print(f"{name:28s} {timings[name]:8.3f}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "sum of median query times", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
