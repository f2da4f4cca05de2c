"""Refined-row counts per load window with the received-count fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_counts(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Row count per load window; one partial+final aggregate."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def refined_count_with_fallback(received: DataFrame, refined: DataFrame, keys: list[str]) -> DataFrame:
    """Refined count per window; when it is 0 and the received count is not,
    the received count is reported instead (the load is assumed lazy)."""
    j = received.join(refined, keys, "left")
    ref = F.coalesce(F.col("refined_count"), F.lit(0)).cast("long")
    rcv = F.col("received_count").cast("long")
    fallback = (ref == 0) & (rcv != 0)
    return j.select(*keys, rcv.alias("received_count"), ref.alias("refined_count"),
                    F.when(fallback, rcv).otherwise(ref).alias("final_count"),
                    fallback.alias("used_fallback"))
