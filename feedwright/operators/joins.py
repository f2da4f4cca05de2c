"""Broadcast only behind a size check, with the planner's choice as the other way.

Dimension-like inputs (holiday calendars, metadata lists) are small in practice
but are still user data. A side is hinted only when its measured bytes are under
the bound; above it the join is left to the planner: a sort-merge join, which AQE
may still turn into a broadcast from the measured shuffle size, and whose
skewed partitions AQE splits. The result is the same either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_BYTES = 16 * 1024 * 1024


def small_side(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when its rows take at most ``max_bytes`` as text, else ``df``.

    One aggregate over the side; meant for sides that are an aggregate or a small table."""
    text = F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in df.columns])
    size = df.agg(F.coalesce(F.sum(F.octet_length(text) + 16), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= max_bytes else df
