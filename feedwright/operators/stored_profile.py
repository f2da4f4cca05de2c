"""E3/D5/M5 on stored profiles: null counts per partition, saved with the load and merged.

A load profiles what it has just written: one aggregate per partition over those partitions only. The rows are kept in an append-only
log (``sinks.event_log``), the latest row of (table, partition, column) counts; a partition that a load
emptied gets zeros. The profile of the table is then a sum over stored rows (columns x partitions), whatever the table's size, and equals
``null_profile`` of a full scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedwright.functions.exprs import quote_ident as _q
from feedwright.functions.exprs import quote_literal as _lit
from feedwright.operators.profile import compare_profiles
from feedwright.sinks.event_log import EventLog

PROFILE_SCHEMA = T.StructType([T.StructField("table", T.StringType()), T.StructField("partition", T.StringType()),
                               T.StructField("column_name", T.StringType()), T.StructField("n_rows", T.LongType()),
                               T.StructField("nulls", T.LongType())])


def profile_store(spark: SparkSession, path: str) -> EventLog:
    return EventLog(spark, path, PROFILE_SCHEMA, ("table",), ("table", "partition", "column_name"))


def partial_profiles(df: DataFrame, table: str, partition: Column | str) -> DataFrame:
    """A row per partition and column of ``df``: rows and nulls. One aggregate, combined in the map tasks."""
    part = (F.col(partition) if isinstance(partition, str) else partition).cast("string")
    cols = [c for c in df.columns if not (isinstance(partition, str) and c == partition)]
    counts = [F.expr(f"count_if({_q(c)} IS NULL)").alias(f"__c{i}") for i, c in enumerate(cols)]
    one = df.groupBy(part.alias("partition")).agg(F.count(F.lit(1)).alias("n_rows"), *counts)
    pairs = ", ".join(f"{_lit(c)}, __c{i}" for i, c in enumerate(cols))
    return one.selectExpr(f"{_lit(table)} AS `table`", "partition", "n_rows", f"stack({len(cols)}, {pairs}) AS (column_name, nulls)").select(*PROFILE_SCHEMA.names)


def record(store: EventLog, loaded: DataFrame, table: str, partition: Column | str, emptied: list[str] = ()) -> None:
    """Save the profiles of what a load wrote; ``emptied``: partitions that it left without rows."""
    rows = partial_profiles(loaded, table, partition)
    if emptied:
        gone = [(table, p, c, 0, 0) for p in emptied for c in loaded.columns if not (isinstance(partition, str) and c == partition)]
        rows = rows.unionByName(store.spark.createDataFrame(gone, PROFILE_SCHEMA))
    store.append(rows)


def merged_profile(store: EventLog, table: str) -> DataFrame:
    """``(column_name, n_rows, null_pct)`` of the whole table from its stored profiles, as ``null_profile`` has it."""
    return (store.read({"table": table}).groupBy("column_name").agg(F.sum("n_rows").alias("n_rows"), F.sum("nulls").alias("nulls"))
            .selectExpr("column_name", "CAST(n_rows AS BIGINT) AS n_rows",
                        "try_divide(100.0D * CAST(nulls AS DOUBLE), CAST(n_rows AS DOUBLE)) AS null_pct"))


def validate_stored(store: EventLog, left: str, right: str) -> DataFrame:
    """M5 of two tables from their stored profiles: nothing of the tables is read."""
    return compare_profiles(merged_profile(store, left), merged_profile(store, right))
