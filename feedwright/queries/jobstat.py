"""Run-status queries over F5 (derived from events)."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import functions as F

from feedwright.functions.exprs import ts_literal
from feedwright.operators import jobstat as js
from feedwright.operators.report import run_reports
from feedwright.plans.run_report import status_reports
from feedwright.queries import register
from feedwright.queries.duck import JOBSTAT
from feedwright.sources import derive
from feedwright.sources.tables import read_table

_J = f"WITH jobstat AS ({JOBSTAT})\n"
_JCOLS = ("feed, jobpid, filename, process_start, process_end, linecount, rowcount, filedate, status, message, "
          "raw_size, raw_replica_size, refined_size, refined_replica_size, partition_col, file_end_dt, refined_count")


def _jobstat(spark, sf_dir):
    return derive.jobstat_from_events(read_table(spark, sf_dir, "events"))


@register("high_water_mark", _J + """
SELECT feed, max(CASE WHEN status = 'COMPLETED SUCCESSFULLY' THEN file_end_dt END) AS hwm
FROM jobstat GROUP BY feed""")
def high_water_mark(spark, sf_dir):
    return js.high_water_mark(_jobstat(spark, sf_dir))


@register("jobstat_window_rows", _J + f"""
, hwm AS (SELECT feed, max(CASE WHEN status = 'COMPLETED SUCCESSFULLY' THEN file_end_dt END) AS hwm
          FROM jobstat GROUP BY feed)
SELECT {_JCOLS} FROM jobstat j
WHERE EXISTS (SELECT 1 FROM hwm h WHERE h.feed = j.feed AND h.hwm = j.filedate AND h.hwm = j.file_end_dt)""")
def jobstat_window_rows(spark, sf_dir):
    j = _jobstat(spark, sf_dir)
    windows = js.high_water_mark(j).select("feed", F.col("hwm").alias("filedate"), F.col("hwm").alias("file_end_dt"))
    return js.window_rows(j, windows)


@register("latest_linecount", _J + """
, ranked AS (SELECT feed, filedate, linecount,
                    row_number() OVER (PARTITION BY feed, filedate ORDER BY process_end DESC, jobpid DESC) AS rn
             FROM jobstat WHERE status = 'EXTRACT_COMPLETED' AND linecount IS NOT NULL)
SELECT feed, filedate, CAST(linecount AS VARCHAR) AS linecount FROM ranked WHERE rn = 1""")
def latest_linecount(spark, sf_dir):
    return js.latest_linecount(_jobstat(spark, sf_dir))


def _upsert_inputs(spark, sf_dir):
    """State: runs started before Jan 20, as first inserted (status of the first
    audit step). Batch: the runs from Jan 15 on with their final status — the
    overlap updates existing keys, the rest are inserts."""
    j = _jobstat(spark, sf_dir)
    state = (j.where(F.col("process_start") < ts_literal(dt.date(2024, 1, 20)))
             .withColumn("status", F.lit("GENERATE EXTRACT SCRIPT"))
             .withColumn("process_end", F.col("process_start")))
    batch = j.where(F.col("process_start") >= ts_literal(dt.date(2024, 1, 15)))
    return state, batch


@register("jobstat_upsert", _J + f"""
, state AS (SELECT * REPLACE ('GENERATE EXTRACT SCRIPT' AS status, process_start AS process_end), 0 AS src
            FROM jobstat WHERE process_start < TIMESTAMP '2024-01-20 00:00:00'),
  batch AS (SELECT *, 1 AS src FROM jobstat WHERE process_start >= TIMESTAMP '2024-01-15 00:00:00'),
  u AS (SELECT * FROM state UNION ALL BY NAME SELECT * FROM batch),
  r AS (SELECT *, row_number() OVER (PARTITION BY feed, jobpid ORDER BY src DESC, process_end DESC, status DESC) AS rn
        FROM u)
SELECT {_JCOLS} FROM r WHERE rn = 1""")
def jobstat_upsert(spark, sf_dir):
    state, batch = _upsert_inputs(spark, sf_dir)
    return js.upsert(state, batch)


@register("already_completed_windows", _J + """
SELECT DISTINCT feed, filedate AS from_date, file_end_dt AS end_date FROM jobstat r
WHERE status = 'EXTRACT_COMPLETED'
  AND EXISTS (SELECT 1 FROM jobstat c WHERE c.status = 'COMPLETED SUCCESSFULLY' AND c.feed = r.feed
              AND c.filedate = r.filedate AND c.file_end_dt = r.file_end_dt)""")
def already_completed_windows(spark, sf_dir):
    j = _jobstat(spark, sf_dir)
    requests = (j.where(F.col("status") == js.EXTRACT_COMPLETED)
                .select("feed", F.col("filedate").alias("from_date"), F.col("file_end_dt").alias("end_date"))
                .distinct())
    return js.completed_windows(j, requests)


@register("feed_jobstat_check", _J + """
, src AS (SELECT feed, filedate, linecount FROM (
            SELECT feed, filedate, linecount,
                   row_number() OVER (PARTITION BY feed, filedate ORDER BY process_end DESC, jobpid DESC) AS rn
            FROM jobstat WHERE status = 'EXTRACT_COMPLETED' AND linecount IS NOT NULL) WHERE rn = 1),
  tgt AS (SELECT upper(event_type) AS feed, CAST(ts AS DATE) AS filedate, count(*) AS target_count
          FROM events GROUP BY ALL)
SELECT tgt.feed, tgt.filedate, CAST(src.linecount AS VARCHAR) AS src_linecount, target_count,
       CASE WHEN src.linecount IS NULL THEN 'MISSING' WHEN src.linecount = target_count THEN 'MATCH'
            ELSE 'MISMATCH' END AS dq_status
FROM tgt LEFT JOIN src ON tgt.feed = src.feed AND tgt.filedate = src.filedate""")
def feed_jobstat_check(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    target = (events.groupBy(F.upper("event_type").alias("feed"), F.to_date("ts").alias("filedate"))
              .agg(F.count(F.lit(1)).alias("target_count")))
    return js.jobstat_check(derive.jobstat_from_events(events), target)


STATUS_REPORT_SQL = """
SELECT concat(feed, '|', CAST(filedate AS STRING)) AS report_key,
       feed AS Feed, filedate AS ExpectedExtractDate,
       max(CASE WHEN status = 'COMPLETED SUCCESSFULLY' THEN process_end END) AS ActualExtractDate,
       datediff(CAST(max(CASE WHEN status = 'COMPLETED SUCCESSFULLY' THEN process_end END) AS DATE), filedate)
         AS ExtractLagDays,
       max(process_start) AS RunDateTime,
       count(*) AS Runs
FROM IDENTIFIER(:jobstat_table)
GROUP BY feed, filedate"""


@register("run_status_report", _J + """
, g AS (SELECT feed AS Feed, filedate AS ExpectedExtractDate,
               max(CASE WHEN status = 'COMPLETED SUCCESSFULLY' THEN process_end END) AS actual,
               max(process_start) AS run_ts, count(*) AS Runs
        FROM jobstat GROUP BY feed, filedate)
SELECT Feed, ExpectedExtractDate, strftime(actual, '%Y-%m-%d') AS ActualExtractDate,
       coalesce(CAST(datediff('day', ExpectedExtractDate, CAST(actual AS DATE)) AS VARCHAR), 'NA') AS ExtractLagDays,
       strftime(run_ts, '%Y-%m-%d %H:%M:%S %p') AS RunDateTime, Runs,
       CASE WHEN CAST(actual AS DATE) = ExpectedExtractDate THEN 'OK' ELSE 'LATE' END AS ActualFlag
FROM g""")
def run_status_report(spark, sf_dir):
    [(_name, report)] = status_reports(spark, STATUS_REPORT_SQL + " -> Run status", {"jobstat_table": "fw_jobstat"},
                                       views={"fw_jobstat": _jobstat(spark, sf_dir)})
    return report


REPORT_SPEC = (
    "SELECT feed, count(*) AS n FROM IDENTIFIER(:jobstat_table) WHERE status = 'COMPLETED SUCCESSFULLY' "
    "GROUP BY feed -> Completed loads"
    " :: SELECT feed, count_if(filedate = :report_dt) AS n FROM IDENTIFIER(:jobstat_table) GROUP BY feed"
    " :: CREATE OR REPLACE TEMP VIEW fw_extracts AS SELECT feed, filedate FROM fw_jobstat "
    "WHERE status = 'EXTRACT_COMPLETED'; SELECT feed, count(DISTINCT filedate) AS n FROM fw_extracts GROUP BY feed"
    " -> Extract days"
)


@register("named_reports", _J + """
SELECT 'Completed loads' AS report_name, feed, count(*) AS n FROM jobstat
WHERE status = 'COMPLETED SUCCESSFULLY' GROUP BY feed
UNION ALL
SELECT 'Report No 2', feed, count_if(filedate = DATE '2024-01-15') FROM jobstat GROUP BY feed
UNION ALL
SELECT 'Extract days', feed, count(DISTINCT filedate) FROM jobstat WHERE status = 'EXTRACT_COMPLETED' GROUP BY feed""")
def named_reports(spark, sf_dir):
    reports = run_reports(spark, REPORT_SPEC, {"jobstat_table": "fw_jobstat", "report_dt": dt.date(2024, 1, 15)},
                          views={"fw_jobstat": _jobstat(spark, sf_dir)})
    parts = [df.select(F.lit(name).alias("report_name"), "feed", F.col("n").cast("long").alias("n"))
             for name, df in reports]
    return reduce(lambda a, b: a.unionByName(b), parts)
