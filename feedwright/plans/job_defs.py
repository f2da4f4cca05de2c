"""M9: job-definition check — naming rules per job and missing job numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedwright.operators.rules import job_numbers, missing_numbers, naming_check, unnumbered_jobs
from feedwright.session import scratch_path
from feedwright.sources.xml import read_job_definitions


def parse_job_definitions(spark: SparkSession, path: str) -> DataFrame:
    """The jobs of a definition feed, parsed once and kept as a table in the shared folder."""
    kept = scratch_path(spark, "job-definitions")
    read_job_definitions(spark, path).write.parquet(kept)
    return spark.read.parquet(kept)


def check_job_definitions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Returns (per-job flags, missing job numbers), both from one parse of the feed."""
    jobs = parse_job_definitions(spark, path)
    return naming_check(jobs), missing_numbers(spark, job_numbers(jobs), "job_num")


def check_numbering(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Returns (missing job numbers, job names without a number)."""
    jobs = parse_job_definitions(spark, path)
    return missing_numbers(spark, job_numbers(jobs), "job_num"), unnumbered_jobs(jobs)
