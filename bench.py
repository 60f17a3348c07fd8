"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run to a no-op sink (every row computed, nothing collected).  The value
is the sum over the queries of the best warm run.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from marketloom.plans import load_queries

HEADLINES = [
    "capital_flow",
    "capital_flow_by_day",
    "flow_summary",
    "flow_history",
    "sector_flow",
    "turnover",
    "adjust_qfq",
    "adjust_hfq",
    "preclose",
    "calendar_week",
    "fixed_bars",
    "session_bars",
    "minute_bars",
    "minute_241",
    "merge_bars",
    "merge_ranges",
    "missing_ranges",
    "security_summary",
    "finance_quality",
    "doc_normalize",
    "synchronized_bars",
    "stream_upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINES
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = load_queries()
    seconds: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(1 + runs):
            start = time.perf_counter()
            queries[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            # The first run warms code generation and the file cache.
            best = took if best is None or took < best else best
        seconds[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
