"""Benchmark: the three jobs over landed daily files, plus headline registered queries.

Prints one JSON line: {"metric", "value" (sum of per-query medians, sec), "unit", "queries", "sf", ...}.
Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_REPEAT (default 3),
BENCH_SHUFFLE_PARTITIONS (default: 2 x BENCH_CPUS; AQE coalesces further).
Setup (landing the raw day files from the driver tables) and one warm-up run per query are not timed;
query times include building the plan on the driver.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickmodel import registry  # noqa: E402
from clickmodel.plans.jobs import run_base, run_sessions, run_staging  # noqa: E402
from clickmodel.session import local_session  # noqa: E402
from clickmodel.sources import testdata as TD  # noqa: E402
from clickmodel.sources.files import raw_days  # noqa: E402

HEADLINE = ["sessions_dim", "serving_projection", "dedup_events", "normalize_items", "unnest_key",
            "extract_params", "first_event_per_session", "unique_violations", "user_snapshot", "plan_dates"]


def land_raw(spark, sf_dir: str, root: str) -> int:
    """Write one export per event day (events_YYYYMMDD.parquet), as the landing zone holds."""
    TD.land_exports(spark, TD.raw_events(spark, sf_dir), root)
    return len(raw_days(spark, root))


def timed(fn, repeat: int) -> float:
    """Median of ``repeat`` runs after one untimed warm-up run (JIT, file-system caches)."""
    fn()
    runs = []
    for _ in range(repeat):
        t = time.perf_counter()
        fn()
        runs.append(time.perf_counter() - t)
    return round(statistics.median(runs), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(2 * cpus, 8))))
    spark = local_session(cpus, shuffle_partitions=parts, app="clickmodel-bench")
    scratch = tempfile.mkdtemp(prefix="clickmodel-bench-")
    n_days = land_raw(spark, sf_dir, f"{scratch}/raw")
    TD.traffic_sources(spark, sf_dir).write.mode("overwrite").parquet(f"{scratch}/traffic")
    TD.derived_session_properties(spark, sf_dir).write.mode("overwrite").parquet(f"{scratch}/derived")

    results: dict[str, float] = {}
    run = [0]

    def base_job():
        run[0] += 1   # a fresh output folder each time, so every run processes all days
        run_base(spark, f"{scratch}/raw", f"{scratch}/base{run[0]}").collect()

    results["job_base"] = timed(base_job, repeat)
    base_dir = f"{scratch}/base{run[0]}"
    results["job_staging"] = timed(lambda: run_staging(spark, base_dir, f"{scratch}/stg").collect(), repeat)
    results["job_sessions"] = timed(lambda: run_sessions(
        spark, f"{scratch}/stg", f"{scratch}/traffic", f"{scratch}/ses", derived_prefix=f"{scratch}/derived",
        join_derived=True).collect(), repeat)

    qs = registry.queries()
    for name in HEADLINE:
        results[name] = timed(lambda: qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save(), repeat)

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds", "value": round(sum(results.values()), 3), "unit": "sec",
        "queries": results, "sf": float(sf.group(1)) if sf else sf_dir, "cpus": cpus, "repeat": repeat,
        "raw_days": n_days,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
