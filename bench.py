"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

One warm-up, then the median of $BENCH_RUNS (default 5) timed runs per query
(the headline set; BENCH_ALL=1 times every registered query);
each run fully evaluates the plan with the ``noop`` sink (nothing is
collected to the driver).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# Building a derived document collection from the flat tables and writing
# it (timed into a fresh folder every run, so nothing is reused).
STAGING = ["stage_mx_documents", "stage_tj_documents"]
# Documents built from the flat tables inside the same plan, then the
# provider M call pipeline (no stored collection).
END_TO_END = ["provider_m_calls_end_to_end"]

HEADLINE = [
    "period_fanout_orders",
    "period_fanout_orders_tokens",
    "period_fanout_events",
    "unnest_calls",
    "unnest_three_level",
    "calls_gated_by_bills",
    "calls_gated_by_explode",
    "provider_m_calls",
    "provider_t_calls",
    "provider_t_bills",
    "daily_increment",
    "daily_increment_wrapped",
    "distinct_records",
    "nested_count",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from nestflow.plans.queries import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    if sys.argv[1:]:
        names = sys.argv[1:]
    elif os.environ.get("BENCH_ALL") == "1":
        names = STAGING + END_TO_END + sorted(QUERIES)
    else:
        names = STAGING + END_TO_END + HEADLINE
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("nestflow-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g")
             .config("spark.sql.shuffle.partitions", str(cpus))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    from nestflow.plans.documents import stage_collection
    from nestflow.sources.sinks import scratch_path

    def run(name: str) -> float:
        t0 = time.perf_counter()
        if name in STAGING:
            kind = name.split("_")[1]
            stage_collection(spark, sf_dir, kind, path=scratch_path(spark, f"bench-{kind}"))
        elif name == "provider_m_calls_end_to_end":
            from nestflow.plans import datasets, documents
            from nestflow.plans.queries import M_CLOCK

            docs = documents.mx_documents(spark, sf_dir)
            datasets.provider_m_calls(docs, M_CLOCK).write.format("noop").mode("overwrite").save()
        else:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    timings = {}
    for name in names:
        run(name)  # warm-up
        timings[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
