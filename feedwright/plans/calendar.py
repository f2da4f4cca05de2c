"""M1 calendar decision and M2 incremental window planning, for all feeds at once.

The reference asks the calendar and the run-status table once per feed; here one
query plans every feed: the calendar, the high-water marks and the completed
windows are each one aggregate or join keyed on the feed, so the plan's work is
a few shuffles whatever the number of feeds.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.operators.jobstat import COMPLETED
from feedwright.sources.derive import WEEKDAYS

# Decision codes, in the order they are tested.
NO_CALENDAR = "NO_CALENDAR"
END_WITHOUT_FROM = "END_WITHOUT_FROM"
NOT_SCHEDULED = "NOT_SCHEDULED"
ABORTED = "ABORTED"
GRACEFUL_EXIT = "GRACEFUL_EXIT"
RUN = "RUN"


def calendar_decision(calendar: DataFrame, holidays: DataFrame, run_date: _dt.date,
                      feed_col: str = "SOURCETBLNM", schema_col: str = "SOURCESCHEMA") -> DataFrame:
    """M1/B3/D1 for every calendar row: the effective date is ``run_date - LAG_DAYS``;
    the weekday flag gives Y/N and a holiday overrides it both ways.

    Feeds are told apart by (schema, table): the same table name in two schemas is two feeds.
    Output per feed: schema_name, feed, eff_date, day_of_eff, holiday_dt, run_switch and
    n_calendar_rows (a feed with 0 or >1 joined rows is unusable, R: M1 error).
    """
    eff = f"date_sub(DATE'{run_date.isoformat()}', LAG_DAYS)"
    weekday = "CASE date_format(eff_date, 'EEE') " + " ".join(
        f"WHEN '{d.capitalize()}' THEN RUN_ON_{d}" for d in WEEKDAYS) + " END"
    cal = calendar.selectExpr(f"`{schema_col}` AS schema_name", f"`{feed_col}` AS feed", f"{eff} AS eff_date",
                              "RUN_ON_HOLIDAY", *[f"RUN_ON_{d}" for d in WEEKDAYS])
    j = cal.join(holidays.select("HOLIDAY_DT"), cal["eff_date"] == F.col("HOLIDAY_DT"), "left")
    switch = (f"coalesce(CASE WHEN HOLIDAY_DT IS NOT NULL THEN RUN_ON_HOLIDAY = 'Y' "
              f"ELSE ({weekday}) = 'Y' END, false)")
    # fixed-width aggregation buffers (date, boolean, count) keep this a hash
    # aggregate; the text columns are derived after it
    per_feed = j.groupBy("schema_name", "feed").agg(
        F.max("eff_date").alias("eff_date"), F.max("HOLIDAY_DT").alias("holiday_dt"),
        F.expr(f"max({switch})").alias("_switch"), F.count(F.lit(1)).alias("n_calendar_rows"))
    return per_feed.selectExpr(
        "schema_name", "feed", "eff_date", "date_format(eff_date, 'EEE') AS day_of_eff", "holiday_dt",
        "CASE WHEN _switch THEN 'Y' ELSE 'N' END AS run_switch", "n_calendar_rows")


def plan_windows(requests: DataFrame, decisions: DataFrame, jobstat: DataFrame) -> DataFrame:
    """M2: per request ``(schema_name, feed, explicit_from, explicit_end, override)`` the load
    window and the decision. Requests and decisions meet on (schema, feed) where both name the
    schema, else on the feed; run status is kept per feed, and per schema where it names one.
    Tested in this order:

    0. end date without from date, or not exactly one calendar row -> refused
    1. calendar window of one day and switch N          -> NOT_SCHEDULED
    2. calendar window start after its end               -> ABORTED
    3. a completed row for the window and no override    -> GRACEFUL_EXIT
    4. otherwise                                         -> RUN [from, end]

    A calendar window starts the day after the high-water mark (or at the
    effective date when the feed never completed) and ends at the effective
    date; explicit dates skip the calendar, a missing end defaults to the start.
    """
    # one aggregate over the run-status table: its completed windows; the
    # high-water mark is the latest of them (feeds without one get null below)
    named = "schema_name" in requests.columns
    keys = ["schema_name", "feed"] if named and "schema_name" in decisions.columns else ["feed"]
    state = ["schema_name", "feed"] if named and "schema_name" in jobstat.columns else ["feed"]
    windows = (jobstat.where(F.col("status") == COMPLETED)
               .select(*state, F.col("filedate").alias("from_date"), F.col("file_end_dt").alias("end_date"))
               .distinct())
    hwm = windows.groupBy(*state).agg(F.max("end_date").alias("hwm"))
    done = windows.withColumn("completed", F.lit(True))
    if not named and "schema_name" in decisions.columns:
        decisions = decisions.drop("schema_name")
    p = requests.join(decisions, keys, "left").join(hwm, state, "left")
    out = ["schema_name"] if named else []
    p = p.selectExpr(
        *out, "feed", "explicit_from", "explicit_end", "override", "run_switch", "n_calendar_rows", "hwm",
        "CASE WHEN explicit_from IS NOT NULL THEN explicit_from ELSE coalesce(date_add(hwm, 1), eff_date) END "
        "AS from_date",
        "CASE WHEN explicit_from IS NOT NULL THEN coalesce(explicit_end, explicit_from) ELSE eff_date END AS end_date")
    p = p.join(done, [*state, "from_date", "end_date"], "left")
    decision = f"""CASE
        WHEN explicit_end IS NOT NULL AND explicit_from IS NULL THEN '{END_WITHOUT_FROM}'
        WHEN explicit_from IS NULL AND coalesce(n_calendar_rows, 0) <> 1 THEN '{NO_CALENDAR}'
        WHEN explicit_from IS NULL AND end_date = from_date AND run_switch = 'N' THEN '{NOT_SCHEDULED}'
        WHEN explicit_from IS NULL AND from_date > end_date THEN '{ABORTED}'
        WHEN coalesce(completed, false) AND NOT coalesce(override, false) THEN '{GRACEFUL_EXIT}'
        ELSE '{RUN}' END"""
    ymd = lambda c: f"date_format({c}, 'yyyyMMdd')"
    message = f"""CASE decision
        WHEN '{NOT_SCHEDULED}' THEN concat('JOB NOT SCHEDULED TO RUN FOR ', {ymd('end_date')})
        WHEN '{ABORTED}' THEN concat('JOB ABORTED: FROM DATE ', {ymd('from_date')}, ' GREATER THAN END DATE ',
                                     {ymd('end_date')})
        WHEN '{GRACEFUL_EXIT}' THEN 'GRACEFUL EXIT PERFORMED'
        WHEN '{NO_CALENDAR}' THEN 'give the feed exactly one calendar row'
        WHEN '{END_WITHOUT_FROM}' THEN 'give a from date with the end date'
        ELSE concat('RUN ', {ymd('from_date')}, ' TO ', {ymd('end_date')}) END"""
    return (p.selectExpr(*out, "feed", "from_date", "end_date", "run_switch", "hwm", f"{decision} AS decision")
            .selectExpr("*", f"{message} AS message"))


def job_calendar_check(decisions: DataFrame, feed: str, schema: str | None = None) -> tuple[str, _dt.date]:
    """M1 for one feed, as the reference's per-job call: ``(run_switch,
    effective date)``; no calendar row or more than one is an error."""
    of = decisions.where(F.col("feed") == feed)
    if schema is not None:
        of = of.where(F.upper("schema_name") == schema.upper())
    rows = of.select("run_switch", "eff_date", "n_calendar_rows").limit(2).collect()
    if len(rows) != 1 or rows[0]["n_calendar_rows"] != 1:
        raise RuntimeError(f"{feed} needs exactly one calendar row; add one or remove the others")
    return rows[0]["run_switch"], rows[0]["eff_date"]
