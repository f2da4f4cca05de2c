"""Named report queries and status-report formatting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwright.functions.exprs import expected_flag, lag_text
from feedwright.sources.scans import scan_sql


def parse_report_spec(spec: str) -> list[tuple[str, str]]:
    """``::`` separates reports, ``->`` separates a query from its name;
    unnamed reports are called ``Report No i``."""
    out = []
    for i, part in enumerate(p for p in spec.split("::")):
        part = part.strip()
        if not part:
            continue
        if "->" in part:
            query, name = part.rsplit("->", 1)
        else:
            query, name = part, f"Report No {i + 1}"
        out.append((name.strip(), query.strip()))
    return out


def positional_to_named(query: str) -> str:
    """Report queries written with two positional ``%s`` markers (the run-status
    table, then the report date) become named parameters ``:report_table`` and
    ``:report_dt``; the table name is bound as an identifier."""
    if "%s" not in query:
        return query
    first, rest = query.split("%s", 1)
    return first + "IDENTIFIER(:report_table)" + rest.replace("%s", ":report_dt", 1)


def run_reports(spark: SparkSession, spec: str, params: dict | None = None,
                views: dict[str, DataFrame] | None = None) -> list[tuple[str, DataFrame]]:
    """Run every named report; a ``;`` list runs in order and the last result
    counts. A report with no rows is an empty DataFrame, not an error (R26).
    Queries with positional ``%s`` markers get ``report_table``/``report_dt``."""
    return [(name, scan_sql(spark, positional_to_named(query), params, views))
            for name, query in parse_report_spec(spec)]


def format_status_report(df: DataFrame, hide_first: bool = False) -> DataFrame:
    """Expected-versus-actual flag, ``NA`` lag days, fixed date formats."""
    cols = df.columns
    out = []
    for c in cols:
        if c == "ExtractLagDays":
            out.append(lag_text(F.col(c)).alias(c))
        elif c == "ActualExtractDate":
            out.append(F.date_format(F.col(c), "yyyy-MM-dd").alias(c))
        elif c == "RunDateTime":
            out.append(F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss a").alias(c))
        else:
            out.append(F.col(c))
    if "ExpectedExtractDate" in cols and "ActualExtractDate" in cols:
        out.append(expected_flag(F.col("ActualExtractDate"), F.col("ExpectedExtractDate")).alias("ActualFlag"))
    res = df.select(*out)
    return res.drop(cols[0]) if hide_first else res
