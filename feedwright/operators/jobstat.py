"""Run-status table: lookups, high-water mark, latest line count,
upsert and audit records (B4, B5, B7, D8, L5, L6, M10)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedwright.functions.exprs import quote_ident

COMPLETED = "COMPLETED SUCCESSFULLY"
EXTRACT_COMPLETED = "EXTRACT_COMPLETED"
KEY = ("feed", "jobpid")

JOBSTAT_SCHEMA = T.StructType([
    T.StructField("feed", T.StringType()), T.StructField("jobpid", T.LongType()),
    T.StructField("filename", T.StringType()), T.StructField("process_start", T.TimestampNTZType()),
    T.StructField("process_end", T.TimestampNTZType()), T.StructField("linecount", T.LongType()),
    T.StructField("rowcount", T.LongType()), T.StructField("filedate", T.DateType()),
    T.StructField("status", T.StringType()), T.StructField("message", T.StringType()),
    T.StructField("raw_size", T.LongType()), T.StructField("raw_replica_size", T.LongType()),
    T.StructField("refined_size", T.LongType()), T.StructField("refined_replica_size", T.LongType()),
    T.StructField("partition_col", T.StringType()), T.StructField("file_end_dt", T.DateType()),
    T.StructField("refined_count", T.LongType()),
])

#: Run status as ``ingest`` keeps it: with the source schema, and the stages of the run.
STATUS_SCHEMA = T.StructType([*JOBSTAT_SCHEMA.fields, T.StructField("schema_name", T.StringType()),
                              T.StructField("stages", T.StringType())])


def window_rows(jobstat: DataFrame, windows: DataFrame) -> DataFrame:
    """Run-status rows of the requested (feed, filedate, file_end_dt) windows."""
    w = windows.select("feed", "filedate", "file_end_dt").distinct()
    return jobstat.join(w, ["feed", "filedate", "file_end_dt"], "left_semi")


def high_water_mark(jobstat: DataFrame) -> DataFrame:
    """Per feed the last completed window end; null when never completed.

    A single aggregate over all feeds (partial aggregation absorbs hot feeds)."""
    done = F.when(F.col("status") == COMPLETED, F.col("file_end_dt"))
    return jobstat.groupBy("feed").agg(F.max(done).alias("hwm"))


def latest_linecount(jobstat: DataFrame) -> DataFrame:
    """Per (feed, filedate) the line count of the latest
    ``EXTRACT_COMPLETED`` row, as text. Nulls are skipped (R22); ties on
    process_end go to the highest jobpid. ``max_by`` is a declarative aggregate:
    map-side partial results, so a hot feed never gathers in one task."""
    rows = jobstat.where((F.col("status") == EXTRACT_COMPLETED) & F.col("linecount").isNotNull())
    return (rows.groupBy("feed", "filedate")
            .agg(F.max_by("linecount", F.struct("process_end", "jobpid")).alias("lc"))
            .select("feed", "filedate", F.col("lc").cast("string").alias("linecount")))


def completed_windows(jobstat: DataFrame, requests: DataFrame,
                      from_col: str = "from_date", end_col: str = "end_date") -> DataFrame:
    """The requested windows that already have a completed row."""
    done = (jobstat.where(F.col("status") == COMPLETED)
            .select("feed", F.col("filedate").alias(from_col), F.col("file_end_dt").alias(end_col)).distinct())
    return requests.join(done, ["feed", from_col, end_col], "left_semi")


def keep_latest(rows: DataFrame, keys=KEY, order_cols=("process_end", "status")) -> DataFrame:
    """One row per key: the one with the greatest ``order_cols``. An aggregate
    (``max_by`` over a struct of the other fields), so rows of a hot key are
    combined map-side before the shuffle."""
    cols = rows.columns
    rest = [c for c in cols if c not in keys]
    payload = "struct(" + ", ".join(quote_ident(c) for c in rest) + ")"
    order = "struct(" + ", ".join(quote_ident(c) for c in order_cols) + ")"
    merged = rows.groupBy(*keys).agg(F.expr(f"max_by({payload}, {order})").alias("_row"))
    return merged.selectExpr(*[f"_row.{quote_ident(c)} AS {quote_ident(c)}" if c in rest else quote_ident(c)
                               for c in cols])


def upsert(state: DataFrame, batch: DataFrame, keys=KEY, order_cols=("process_end", "status")) -> DataFrame:
    """Insert-or-update by key; the batch wins over the state, later rows
    win inside the batch.

    MERGE without a table format that supports it: the state rows whose key
    occurs in the batch are removed with a left-anti join and the batch's
    latest rows are appended. Only the batch is aggregated; the state is
    streamed through the anti join (a broadcast of the batch keys when AQE
    measures them small, a shuffle join otherwise). Re-applying the same batch
    leaves the state unchanged.
    """
    latest = keep_latest(batch.select(*state.columns), keys, order_cols)
    kept = state.join(latest.select(*keys), list(keys), "left_anti")
    return kept.unionByName(latest)


def audit_record(spark: SparkSession, feed: str, jobpid: int, status: str, *, filedate=None,
                 file_end_dt=None, process_start=None, process_end=None, filename: str = "",
                 linecount=0, rowcount=0, message: str = "", raw_size=0, raw_replica_size=0,
                 refined_size=0, refined_replica_size=0, partition_col: str = "",
                 refined_count=0) -> DataFrame:
    """One 17-field audit row (R15: every field is written)."""
    now = _dt.datetime.now().replace(microsecond=0)
    row = (feed, int(jobpid), filename, process_start or now, process_end or now, linecount, rowcount,
           filedate, status, message, raw_size, raw_replica_size, refined_size, refined_replica_size,
           partition_col, file_end_dt if file_end_dt is not None else filedate, refined_count)
    return spark.createDataFrame([row], JOBSTAT_SCHEMA)


def jobstat_check(jobstat: DataFrame, target_counts: DataFrame) -> DataFrame:
    """Latest extract line count (source side) against a target count per
    (feed, filedate). A missing or null line count is reported as ``MISSING``;
    ``require_jobstat`` turns that into an error."""
    src = latest_linecount(jobstat)
    j = target_counts.join(src, ["feed", "filedate"], "left")
    lc = F.col("linecount").cast("long")
    return j.select("feed", "filedate", F.col("linecount").alias("src_linecount"),
                    F.col("target_count").cast("long").alias("target_count"),
                    F.when(lc.isNull(), F.lit("MISSING"))
                    .when(lc == F.col("target_count"), F.lit("MATCH"))
                    .otherwise(F.lit("MISMATCH")).alias("dq_status"))


def require_jobstat(check: DataFrame) -> DataFrame:
    """Raise when any (feed, filedate) has no job statistic (reference: abort)."""
    missing = check.where(F.col("dq_status") == "MISSING").select("feed", "filedate").limit(5).collect()
    if missing:
        raise RuntimeError("No job stat found for " + ", ".join(f"[{r.feed}, {r.filedate}]" for r in missing))
    return check
