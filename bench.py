"""Benchmark the registered queries.

Runs every query of ``pointtally.plans.QUERIES`` over ``$BENCH_SF_DIR``
(default ``/root/testdata/sf0.1``) on ``local[$BENCH_CPUS]`` and prints one
JSON line: ``{"metric", "value", "unit", "queries": {name: sec}, "sf"}``.
Each query runs to completion through the ``noop`` sink (no driver collect).
Before timing, every query runs once untimed on the small ``$BENCH_WARMUP_DIR``
(default ``/root/testdata/sf0.001``; set it empty to skip) so JIT compilation
and class loading are not charged to whichever query happens to run first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    from pyspark.sql import SparkSession

    from pointtally.plans import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pointtally-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(os.environ.get("BENCH_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="bench-ckpt-"))

    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    for name, query in QUERIES.items():
        if warm_dir and (not only or name in only):
            try:
                query(spark, warm_dir).write.format("noop").mode("overwrite").save()
            except Exception:  # the timed run reports it
                pass
    spark.catalog.clearCache()

    timings: dict[str, float | None] = {}
    for name, query in QUERIES.items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        try:
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # keep benchmarking; report the failure
            timings[name] = None
            print(f"bench: {name} failed: {type(exc).__name__}: {exc}", file=sys.stderr)
        spark.catalog.clearCache()

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(t for t in timings.values() if t is not None), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(m.group(1)) if m else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
