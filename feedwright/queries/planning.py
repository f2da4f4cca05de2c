"""Calendar decision and incremental window planning over all customer feeds."""

from __future__ import annotations

from feedwright.plans.calendar import calendar_decision as _calendar_decision
from feedwright.plans.calendar import plan_windows
from feedwright.queries import register
from feedwright.queries.duck import PLANNING_JOBSTAT
from feedwright.sources import derive
from feedwright.sources.tables import read_table

_CAL = """
WITH ent AS (
  SELECT c_custkey, c_name, 'CRM' AS s, 0 AS shift FROM customer WHERE c_custkey % 13 <> 0 UNION ALL
  SELECT c_custkey, c_name, 'CRM', 0 FROM customer WHERE c_custkey % 17 = 0 UNION ALL
  SELECT c_custkey, c_name, 'ERP', 3 FROM customer WHERE c_custkey % 11 = 0),
cal AS (
  SELECT s AS schema_name, c_name AS feed, CAST((c_custkey + shift) % 5 AS INTEGER) AS lag,
         CASE WHEN (c_custkey + shift) % 3 = 0 THEN 'Y' ELSE 'N' END AS roh,
         CASE WHEN ((c_custkey + shift) >> 0) % 2 = 1 THEN 'Y' ELSE 'N' END AS mon,
         CASE WHEN ((c_custkey + shift) >> 1) % 2 = 1 THEN 'Y' ELSE 'N' END AS tue,
         CASE WHEN ((c_custkey + shift) >> 2) % 2 = 1 THEN 'Y' ELSE 'N' END AS wed,
         CASE WHEN ((c_custkey + shift) >> 3) % 2 = 1 THEN 'Y' ELSE 'N' END AS thu,
         CASE WHEN ((c_custkey + shift) >> 4) % 2 = 1 THEN 'Y' ELSE 'N' END AS fri,
         CASE WHEN ((c_custkey + shift) >> 5) % 2 = 1 THEN 'Y' ELSE 'N' END AS sat,
         CASE WHEN ((c_custkey + shift) >> 6) % 2 = 1 THEN 'Y' ELSE 'N' END AS sun
  FROM ent),
hol AS (
  SELECT DISTINCT DATE '2024-01-01' + CAST(k AS INTEGER) AS holiday_dt
  FROM (SELECT datediff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 30 AS k
        FROM orders WHERE o_orderkey % 97 = 0) WHERE k % 4 = 0),
e AS (SELECT *, DATE '2024-01-15' - lag AS eff FROM cal),
d0 AS (
  SELECT schema_name, feed, eff AS eff_date, strftime(eff, '%a') AS day_of_eff, h.holiday_dt,
         CASE WHEN h.holiday_dt IS NOT NULL THEN (CASE WHEN roh = 'Y' THEN 'Y' ELSE 'N' END)
              ELSE (CASE WHEN (CASE strftime(eff, '%a') WHEN 'Mon' THEN mon WHEN 'Tue' THEN tue WHEN 'Wed' THEN wed
                                    WHEN 'Thu' THEN thu WHEN 'Fri' THEN fri WHEN 'Sat' THEN sat WHEN 'Sun' THEN sun
                               END) = 'Y' THEN 'Y' ELSE 'N' END) END AS run_switch
  FROM e LEFT JOIN hol h ON h.holiday_dt = e.eff),
dec AS (
  SELECT schema_name, feed, max(eff_date) AS eff_date, max(day_of_eff) AS day_of_eff, max(holiday_dt) AS holiday_dt,
         max(run_switch) AS run_switch, count(*) AS n_calendar_rows
  FROM d0 GROUP BY schema_name, feed)
"""


def _decisions(spark, sf_dir):
    customer = read_table(spark, sf_dir, "customer")
    holidays = derive.holidays_from_orders(read_table(spark, sf_dir, "orders"))
    return _calendar_decision(derive.calendar_from_customers(customer), holidays, derive.PLAN_RUN_DATE)


@register("calendar_decision", _CAL + "SELECT * FROM dec")
def calendar_decision(spark, sf_dir):
    return _decisions(spark, sf_dir)


@register("increment_plan", _CAL + f"""
, js AS ({PLANNING_JOBSTAT}),
hwm AS (SELECT feed, max(CASE WHEN status = 'COMPLETED SUCCESSFULLY' THEN file_end_dt END) AS hwm
        FROM js GROUP BY feed),
done AS (SELECT DISTINCT feed, filedate AS from_date, file_end_dt AS end_date FROM js
         WHERE status = 'COMPLETED SUCCESSFULLY'),
req AS (SELECT s AS schema_name, c_name AS feed,
               CASE WHEN c_custkey % 10 = 9 THEN DATE '2024-01-05' END AS explicit_from,
               CASE WHEN c_custkey % 10 = 9 THEN DATE '2024-01-05' END AS explicit_end,
               (c_custkey % 20 = 19) AS override
        FROM (SELECT *, 'CRM' AS s FROM customer UNION ALL SELECT *, 'ERP' AS s FROM customer WHERE c_custkey % 11 = 0)),
p0 AS (
  SELECT r.*, d.run_switch, d.n_calendar_rows, d.eff_date, h.hwm,
         CASE WHEN r.explicit_from IS NOT NULL THEN r.explicit_from
              ELSE coalesce(h.hwm + 1, d.eff_date) END AS from_date,
         CASE WHEN r.explicit_from IS NOT NULL THEN coalesce(r.explicit_end, r.explicit_from)
              ELSE d.eff_date END AS end_date
  FROM req r LEFT JOIN dec d ON r.feed = d.feed AND r.schema_name = d.schema_name LEFT JOIN hwm h ON r.feed = h.feed),
p AS (
  SELECT p0.*, (done.feed IS NOT NULL) AS completed,
         CASE WHEN explicit_end IS NOT NULL AND explicit_from IS NULL THEN 'END_WITHOUT_FROM'
              WHEN explicit_from IS NULL AND coalesce(n_calendar_rows, 0) <> 1 THEN 'NO_CALENDAR'
              WHEN explicit_from IS NULL AND p0.end_date = p0.from_date AND run_switch = 'N' THEN 'NOT_SCHEDULED'
              WHEN explicit_from IS NULL AND p0.from_date > p0.end_date THEN 'ABORTED'
              WHEN done.feed IS NOT NULL AND NOT coalesce(override, false) THEN 'GRACEFUL_EXIT'
              ELSE 'RUN' END AS decision
  FROM p0 LEFT JOIN done ON p0.feed = done.feed AND p0.from_date = done.from_date AND p0.end_date = done.end_date)
SELECT schema_name, feed, from_date, end_date, run_switch, hwm, decision,
       CASE decision
         WHEN 'NOT_SCHEDULED' THEN 'JOB NOT SCHEDULED TO RUN FOR ' || strftime(end_date, '%Y%m%d')
         WHEN 'ABORTED' THEN 'JOB ABORTED: FROM DATE ' || strftime(from_date, '%Y%m%d') || ' GREATER THAN END DATE '
                             || strftime(end_date, '%Y%m%d')
         WHEN 'GRACEFUL_EXIT' THEN 'GRACEFUL EXIT PERFORMED'
         WHEN 'NO_CALENDAR' THEN 'give the feed exactly one calendar row'
         WHEN 'END_WITHOUT_FROM' THEN 'give a from date with the end date'
         ELSE 'RUN ' || strftime(from_date, '%Y%m%d') || ' TO ' || strftime(end_date, '%Y%m%d') END AS message
FROM p""")
def increment_plan(spark, sf_dir):
    customer = read_table(spark, sf_dir, "customer")
    jobstat = derive.planning_jobstat(read_table(spark, sf_dir, "events"), customer)
    return plan_windows(derive.plan_requests(customer), _decisions(spark, sf_dir), jobstat)
