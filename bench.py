"""Benchmark the registered queries.

Runs every query in ``stratum.queries.QUERIES`` on ``$BENCH_SF_DIR``
(default /root/testdata/sf0.1) with ``local[$BENCH_CPUS]``: one warm-up
pass, then ``$BENCH_RUNS`` timed runs (default 3); each query's time is the
median. A run executes the whole plan through the ``noop`` sink (no driver
collect); for queries that write landing files and tables, those writes are
part of the timed work. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def _sf(sf_dir: str) -> float | str:
    m = re.search(r"sf([0-9.]+)", sf_dir)
    return float(m.group(1)) if m else sf_dir


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stratum-bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(max(8, 2 * cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Local SSD: opening a file is cheap, so let a few-MB landing CSV split
        # over all cores (the 4 MB default packs it into one or two tasks).
        # Irrelevant for large files, where maxPartitionBytes decides.
        .config("spark.sql.files.openCostInBytes", str(256 * 1024))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    import logging

    logging.getLogger("stratum").setLevel(logging.ERROR)

    from stratum.queries import QUERIES

    def run(fn) -> float:
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    errors: dict[str, str] = {}

    def timed(name, fn) -> float | None:
        if name in errors:
            return None
        try:
            return run(fn)
        except Exception as exc:  # report, keep timing the other queries
            errors[name] = f"{type(exc).__name__}: {(str(exc).splitlines() or [''])[0][:300]}"
            return None

    for name, fn in QUERIES.items():  # warm-up: JIT, file listing caches
        timed(name, fn)
    timings: dict[str, list[float]] = {name: [] for name in QUERIES}
    for _ in range(runs):
        for name, fn in QUERIES.items():
            t = timed(name, fn)
            if t is not None:
                timings[name].append(t)
    medians = {name: (round(statistics.median(ts), 3) if ts else None) for name, ts in timings.items()}
    result = {
        "metric": "total_median_query_time",
        "value": round(sum(v for v in medians.values() if v is not None), 3),
        "unit": "sec",
        "queries": medians,
        "sf": _sf(sf_dir),
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
    }
    if errors:
        result["errors"] = errors
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
