"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (no collect to the
driver) and timed. Prints ONE JSON line:
{"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
Set BENCH_QUERIES to a comma-separated list of name prefixes to run a subset.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [p for p in os.environ.get("BENCH_QUERIES", "").split(",") if p]

    from quarry.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="quarry-bench")
    from quarry.plans.catalog import QUERIES

    names = sorted(n for n in QUERIES if not only or n.startswith(tuple(only)))
    # Untimed warm-up on the smallest fixture (JIT, Python workers, codegen caches)
    # so the first timed query is not charged several seconds of JVM start-up.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for w in ("w1_freshest_sample", "c1_uniform_shard_sample", "t3_alert_suppression", "p1_tokenizer_hook"):
            QUERIES[w](spark, warm_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        t0 = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # a failing query is reported, not hidden
            failed[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_sec", "value": round(sum(timings.values()), 3), "unit": "sec",
           "queries": timings, "sf": float(m.group(1)) if m else sf_dir, "n_queries": len(timings)}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
