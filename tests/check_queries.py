"""Compare registered queries with their SQL: python tests/check_queries.py [sf] [name ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402


def main(sf: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con = oracle.connect(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            frame = queries[name](spark, sf_dir)
            if name in sqls:
                verdict = oracle.difference(frame, con, sqls[name])
            else:
                verdict = "" if frame.count() > 0 else "no rows"
        except Exception as error:  # noqa: BLE001
            verdict = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(verdict)
        print(f"{'FAIL' if verdict else 'ok  '} {name} {time.time() - start:.1f}s {verdict}", flush=True)
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].replace(".", "").isdigit() else "0.01"
    sys.exit(1 if main(sf, args) else 0)
