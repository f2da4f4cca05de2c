import datetime as dt


from feedwright.operators import jobstat as js
from feedwright.operators.joins import small_side
from feedwright.plans.calendar import calendar_decision, plan_windows

WED = dt.date(2024, 1, 3)
CAL_SCHEMA = ("SOURCESCHEMA string, SOURCETBLNM string, LAG_DAYS int, RUN_ON_HOLIDAY string, RUN_ON_MON string, "
              "RUN_ON_TUE string, RUN_ON_WED string, RUN_ON_THU string, RUN_ON_FRI string, RUN_ON_SAT string, "
              "RUN_ON_SUN string")


def cal_row(feed, lag, roh, mon="N", wed="N"):
    return ("S", feed, lag, roh, mon, "N", wed, "N", "N", "N", "N")


def test_calendar_decision_f3(spark):
    cal = spark.createDataFrame([cal_row("A", 0, "N", wed="Y"), cal_row("B", 2, "Y"), cal_row("C", 2, "Y"),
                                 cal_row("D", 2, "N", mon="Y"), cal_row("E", 0, "N", wed="Y"),
                                 cal_row("E", 1, "N")], CAL_SCHEMA)
    # B and C differ only by the holiday table used
    hol_none = spark.createDataFrame([], "HOLIDAY_DT date, HOLIDAY_DESC string")
    hol_mon = spark.createDataFrame([(dt.date(2024, 1, 1), "NY")], "HOLIDAY_DT date, HOLIDAY_DESC string")
    a = {r.feed: r for r in calendar_decision(cal, small_side(hol_none), WED).collect()}
    b = {r.feed: r for r in calendar_decision(cal, small_side(hol_mon), WED).collect()}
    assert (a["A"].run_switch, a["A"].eff_date, a["A"].day_of_eff) == ("Y", WED, "Wed")
    assert (a["B"].run_switch, a["B"].eff_date) == ("N", dt.date(2024, 1, 1))
    assert b["C"].run_switch == "Y"            # holiday and RUN_ON_HOLIDAY=Y on an off Monday
    assert b["D"].run_switch == "N"            # Monday flag Y but holiday and RUN_ON_HOLIDAY=N
    assert a["E"].n_calendar_rows == 2         # two calendar rows: unusable


def _jobstat(spark, rows):
    full = [(f, pid, "f", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1), 1, 1, fd, st, "", 0, 0, 0, 0, "", ed, 1)
            for f, pid, fd, ed, st in rows]
    return spark.createDataFrame(full, js.JOBSTAT_SCHEMA)


def test_plan_windows_every_decision(spark):
    eff = WED
    dec = spark.createDataFrame(
        [("never_y", eff, "Y", 1), ("never_n", eff, "N", 1), ("hwm2_n", eff, "N", 1), ("hwm1_n", eff, "N", 1),
         ("hwm3_y", eff, "Y", 1), ("explicit", eff, "Y", 1), ("explicit_ovr", eff, "Y", 1), ("two_cal", eff, "Y", 2)],
        "feed string, eff_date date, run_switch string, n_calendar_rows long")
    x = dt.date(2023, 12, 20)
    req = spark.createDataFrame(
        [(f, None, None, False) for f in ("never_y", "never_n", "hwm2_n", "hwm1_n", "hwm3_y", "two_cal", "no_cal")]
        + [("explicit", x, x, False), ("explicit_ovr", x, x, True), ("end_only", None, x, False)],
        "feed string, explicit_from date, explicit_end date, override boolean")
    jobstat = _jobstat(spark, [("hwm2_n", 1, dt.date(2024, 1, 2), dt.date(2024, 1, 2), js.COMPLETED),
                               ("hwm1_n", 2, dt.date(2024, 1, 1), dt.date(2024, 1, 1), js.COMPLETED),
                               ("hwm3_y", 3, eff, eff, js.COMPLETED),
                               ("explicit", 4, x, x, js.COMPLETED), ("explicit_ovr", 5, x, x, js.COMPLETED)])
    got = {r.feed: (r.decision, r.from_date, r.end_date) for r in plan_windows(req, dec, jobstat).collect()}
    assert got["never_y"] == ("RUN", eff, eff)
    assert got["never_n"][0] == "NOT_SCHEDULED"
    assert got["hwm2_n"][0] == "NOT_SCHEDULED"
    assert got["hwm1_n"] == ("RUN", dt.date(2024, 1, 2), eff)          # catch-up despite switch N
    assert got["hwm3_y"] == ("ABORTED", dt.date(2024, 1, 4), eff)
    assert got["explicit"] == ("GRACEFUL_EXIT", x, x)
    assert got["explicit_ovr"] == ("RUN", x, x)
    assert got["two_cal"][0] == "NO_CALENDAR" and got["no_cal"][0] == "NO_CALENDAR"
    assert got["end_only"][0] == "END_WITHOUT_FROM"


def test_small_side_check(spark):
    df = spark.range(10)
    big = spark.range(100)
    j = big.join(small_side(df, max_bytes=400), "id")
    assert "Broadcast" in j._jdf.queryExecution().executedPlan().toString() or j.count() == 10
    j2 = big.join(small_side(big, max_bytes=400), "id")
    assert j2.count() == 100


def test_job_calendar_check_errors(spark):
    import pytest

    from feedwright.plans.calendar import job_calendar_check
    dec = spark.createDataFrame([("A", WED, "Y", 1), ("B", WED, "N", 2)],
                                "feed string, eff_date date, run_switch string, n_calendar_rows long")
    assert job_calendar_check(dec, "A") == ("Y", WED)
    for feed in ("B", "missing"):
        with pytest.raises(RuntimeError, match="calendar row"):
            job_calendar_check(dec, feed)


def test_same_table_name_in_two_schemas(spark):
    rows = [("S1",) + cal_row("A", 0, "N", wed="Y")[1:], ("S2",) + cal_row("A", 0, "N")[1:]]
    none = spark.createDataFrame([], "HOLIDAY_DT date, HOLIDAY_DESC string")
    dec = calendar_decision(spark.createDataFrame(rows, CAL_SCHEMA), none, WED)
    assert sorted((r.schema_name, r.run_switch, r.n_calendar_rows) for r in dec.collect()) == [("S1", "Y", 1), ("S2", "N", 1)]
    req = spark.createDataFrame([(s, "A", None, None, False) for s in ("S1", "S2", "S3")],
                                "schema_name string, feed string, explicit_from date, explicit_end date, override boolean")
    got = {r.schema_name: r.decision for r in plan_windows(req, dec, _jobstat(spark, [])).collect()}
    assert got == {"S1": "RUN", "S2": "NOT_SCHEDULED", "S3": "NO_CALENDAR"}
