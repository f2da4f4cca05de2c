"""Null profile of a table and the comparison of two profiles.

Wide expressions are written as SQL expression strings (one JVM call each
instead of one per column reference); the plans are the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from feedwright.functions.exprs import quote_ident as _q
from feedwright.functions.exprs import quote_literal as _lit


def null_profile(df: DataFrame) -> DataFrame:
    """``(column_name, n_rows, null_pct)`` for every column, in one scan.

    One aggregate computes the row count and all null counts together (partial
    aggregation per task, one tiny final merge); the one-row result is then
    unpivoted with ``stack``. No separate ``count()`` pass, nothing collected.
    ``null_pct = 100.0 * nulls / rows`` in double, multiply first (R1); null
    for an empty table (R2).
    """
    cols = df.columns
    one = df.selectExpr("count(1) AS __n", *[f"count_if({_q(c)} IS NULL) AS __c{i}" for i, c in enumerate(cols)])
    pairs = ", ".join(f"{_lit(c)}, __c{i}" for i, c in enumerate(cols))
    tall = one.selectExpr("__n", f"stack({len(cols)}, {pairs}) AS (column_name, nulls)")
    return tall.selectExpr("column_name", "CAST(__n AS BIGINT) AS n_rows",
                           "try_divide(100.0D * CAST(nulls AS DOUBLE), CAST(__n AS DOUBLE)) AS null_pct")


def compare_profiles(left: DataFrame, right: DataFrame) -> DataFrame:
    """D5/H1 with the R1-R4 rulings.

    ``added`` = column only on the left, ``removed`` = only on the right;
    ``null_defer`` = both present, integer parts differ and the gap is > 1.0;
    ``full_null_left/right`` = integer part of the percent is 100. Every flag
    needs both percents (an empty table has none, R2).
    """
    l = left.selectExpr("column_name", "n_rows AS left_rows", "null_pct AS left_pct", "true AS _l")
    r = right.selectExpr("column_name", "n_rows AS right_rows", "null_pct AS right_pct", "true AS _r")
    both = "(left_pct IS NOT NULL AND right_pct IS NOT NULL)"
    return l.join(r, "column_name", "full_outer").selectExpr(
        "column_name", "left_rows", "right_rows", "left_pct", "right_pct",
        "(_l IS NOT NULL AND _r IS NULL) AS added",
        "(_l IS NULL AND _r IS NOT NULL) AS removed",
        f"coalesce({both} AND CAST(left_pct AS INT) <> CAST(right_pct AS INT) "
        "AND abs(left_pct - right_pct) > 1.0, false) AS null_defer",
        f"coalesce({both} AND CAST(left_pct AS INT) = 100, false) AS full_null_left",
        f"coalesce({both} AND CAST(right_pct AS INT) = 100, false) AS full_null_right")
