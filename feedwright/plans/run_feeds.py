"""M2 -> M3 for many feeds: bounded concurrent loads, one feed's failure its own.

A load is mostly waiting for small jobs, so feeds run side by side: ``concurrency`` threads, each in a scheduler pool of its
own (with the FAIR scheduler a large feed then can't starve the others). Only control rows pass through the driver: one
report row per feed. A feed that fails is reported with its message; its load can be repeated (see ``plans.ingest``).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

REPORT = ("schema_name string, feed string, from_date date, end_date date, decision string, status string, message string, "
          "rowcount long, refined_count long")

LOADED, EXITED, FAILED, INVALID = "LOADED", "EXITED", "FAILED", "INVALID"


def run_feeds(spark: SparkSession, runs: list[tuple], concurrency: int = 4, **options) -> tuple[DataFrame, dict]:
    """``runs`` are ``(spec, from_date, end_date)``; returns the report (a row per run) and the results of ``ingest`` by (schema, feed).

    ``options`` go to ``ingest``."""
    from pyspark import inheritable_thread_target

    from feedwright.plans.ingest import ingest
    from feedwright.sources.scans import _as_date
    results: dict[tuple[str, str], dict] = {}

    def one(i_run):
        i, (spec, start, end) = i_run
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"feeds-{i % concurrency}")
        first = _as_date(start)
        last = _as_date(end) if end else first
        try:
            res = ingest(spark, spec, first, last, **options)
        except Exception as e:  # the other feeds go on
            return (spec.schema, spec.feed, first, last, "RUN", FAILED, f"{type(e).__name__}: {str(e)[:300]}", None, None)
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
        results[spec.schema, spec.feed] = res
        if res["decision"] != "RUN":
            return (spec.schema, spec.feed, first, last, res["decision"], EXITED, "", None, None)
        return (spec.schema, spec.feed, first, last, "RUN", LOADED, "", res["rowcount"], res["refined_count"])

    with ThreadPoolExecutor(max(1, concurrency)) as pool:
        rows = list(pool.map(inheritable_thread_target(spark)(one), enumerate(runs)))
    return spark.createDataFrame(rows, REPORT), results

