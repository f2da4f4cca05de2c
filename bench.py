"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``: one warm-up run, then the median of ``$BENCH_RUNS``
timed runs. A run executes the whole plan into the ``noop`` sink (no collect
to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "null_profile_lineitem", "validate_raw_refined", "delta_extract_range", "latest_linecount",
    "jobstat_upsert", "increment_plan", "csv_multiline", "xml_roundtrip",
    "dq_reconcile", "calendar_decision", "table_sizes", "feed_jobstat_check", "ingest_refined",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE

    from feedwright.queries import queries
    from feedwright.session import get_session

    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    if os.environ.get("BENCH_EVENT_LOG"):        # stage/task times for tools/stage_times.py
        import tempfile
        log_dir = tempfile.mkdtemp(prefix="feedwright-eventlog-")
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
        print(f"event log: {log_dir}", file=sys.stderr)
    spark = get_session(f"local[{cpus}]", cpus, app_name="feedwright-bench", extra=extra)
    qs = queries()

    def once(name):
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    errors = {}
    for name in names:                           # warm-up pass: JIT, codegen caches, file listing
        try:
            once(name)
        except Exception as exc:                 # keep measuring the others; report the failure
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    times = {name: (None if name in errors else round(statistics.median(once(name) for _ in range(runs)), 3))
             for name in names}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "headline_queries_total_median",
           "value": round(sum(v for v in times.values() if v is not None), 3),
           "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "runs": runs, "spark": spark.version}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
