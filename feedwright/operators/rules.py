"""Naming rules and sequence gaps."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedwright.functions.exprs import job_number, naming_flags
from feedwright.session import scratch_path, ship_package


def naming_check(jobs: DataFrame) -> DataFrame:
    """C5 on ``(jobname, incond, outcond)``: one flag per rule."""
    in_bad, out_bad = naming_flags(F.col("jobname"), F.col("incond"), F.col("outcond"))
    return jobs.select("jobname", "incond", "outcond", in_bad.alias("in_bad"), out_bad.alias("out_bad"))


def job_numbers(jobs: DataFrame) -> DataFrame:
    """Distinct job numbers (last three characters before the first '-')."""
    return jobs.select(job_number(F.col("jobname")).alias("job_num")).where(F.col("job_num").isNotNull()).distinct()


def unnumbered_jobs(jobs: DataFrame) -> DataFrame:
    """Job names that hold no number: they can't take part in the sequence check and are reported."""
    return jobs.select("jobname").where(job_number(F.col("jobname")).isNull()).distinct()


def missing_numbers(spark: SparkSession, numbers: DataFrame, col: str) -> DataFrame:
    """Numbers in [min, max] that do not occur.

    Only the two bounds reach the driver; the full range is a distributed
    ``spark.range`` anti-joined with the distinct present numbers, so neither
    the range nor the present set passes through one task.
    """
    present = numbers.select(F.col(col).cast("long").alias("n")).where(F.col("n").isNotNull()).distinct()
    bounds = present.agg(F.min("n").alias("lo"), F.max("n").alias("hi")).first()
    if bounds is None or bounds["lo"] is None:
        return spark.range(0).select(F.col("id").alias(col))
    full = spark.range(bounds["lo"], bounds["hi"] + 1).select(F.col("id").alias("n"))
    return full.join(present, "n", "left_anti").select(F.col("n").alias(col))


def missing_ranges(spark: SparkSession, numbers: DataFrame, col: str) -> DataFrame:
    """D6/H3 as intervals ``(first, last)`` of the numbers in [min, max] that don't occur: as many rows as gaps, however wide they are.

    The distinct numbers are range-partitioned and sorted; each task takes the differences of neighbours and gives its own first and
    last number, which are one row a task: the gaps between tasks come from those.
    """
    ship_package(spark)
    present = numbers.select(F.col(f"`{col}`").cast("long").alias("n")).where(F.col("n").isNotNull()).distinct()
    path = scratch_path(spark, "number-gaps")
    # written, so that the gaps and the borders are of the same ranges
    (present.repartitionByRange("n").sortWithinPartitions("n").mapInArrow(_neighbours, "first long, last long, border boolean").write.parquet(path))
    found = spark.read.schema("first long, last long, border boolean").parquet(path)
    # a row per range: a global window over them is small
    after = F.lead("first").over(Window.orderBy("first"))
    between = (found.where("border").select("last", after.alias("after")).where("after IS NOT NULL").where("after - 1 <> last")
               .selectExpr("last + 1 AS first", "after - 1 AS last"))
    return found.where("NOT border").select("first", "last").union(between)


def _neighbours(batches):
    low = high = None
    for batch in batches:
        n = batch.column(0).to_numpy()
        if not len(n):
            continue
        low = int(n[0]) if low is None else low
        before = np.concatenate([[n[0] if high is None else high], n[:-1]])
        # differences of 64-bit numbers may exceed 64 bits: compare with the next number instead
        at = np.flatnonzero((n != before) & (before + 1 != n))
        high = int(n[-1])
        yield pa.record_batch({"first": pa.array(before[at] + 1), "last": pa.array(n[at] - 1), "border": pa.array(np.zeros(len(at), bool))})
    if low is not None:
        yield pa.record_batch({"first": pa.array([low]), "last": pa.array([high]), "border": pa.array([True])})
