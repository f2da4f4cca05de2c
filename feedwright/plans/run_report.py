"""M7: run-status report — named report queries, each formatted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedwright.operators.report import format_status_report, run_reports


def status_reports(spark: SparkSession, spec: str, params: dict | None = None,
                   views: dict[str, DataFrame] | None = None, hide_first: bool = True) -> list[tuple[str, DataFrame]]:
    """Every report of the spec, formatted; empty reports stay empty DataFrames."""
    return [(name, format_status_report(df, hide_first)) for name, df in run_reports(spark, spec, params, views)]
