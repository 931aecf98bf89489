"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
Each query runs once cold and then BENCH_RUNS times; a query's figure is the median of the latter and
covers everything from reading the list to the last result row.
"""

from __future__ import annotations

import contextlib
import io
import json
import os
import statistics
import sys
import time
from collections import Counter
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from brandtrack.sample_queries import queries  # noqa: E402

HEADLINE = (
    "upc_cat_dated",
    "sr_upc_week",
    "sr_cat_week",
    "prfg_upc_week",
    "prfg_cat_week",
    "weekly_trend",
    "banner_metrics",
    "summary",
)
JOINS = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin")


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("brandtrack-bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def joins_in(df) -> dict[str, int]:
    """Join types of the plan that ran."""
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    final = out.getvalue().split("+- == Initial Plan ==")[0]
    counts = Counter({join: final.count(join) for join in JOINS})
    return {join: n for join, n in counts.items() if n}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(cpus)
    known = queries()
    warm, cold, joins = {}, {}, {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            df = known[name](spark, sf_dir)
            df.collect()
            times.append(time.perf_counter() - start)
        cold[name] = round(times[0], 3)
        warm[name] = round(statistics.median(times[1:]), 3)
        joins[name] = joins_in(df)
    result = {
        "metric": "total_warm_median_seconds",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "sf": sf_dir.rstrip("/").split("sf")[-1],
        "cold": cold,
        "joins": joins,
        "cores": int(cpus),
        "spark": spark.version,
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
        "driver_memory": spark.conf.get("spark.driver.memory"),
    }
    spark.stop()
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
