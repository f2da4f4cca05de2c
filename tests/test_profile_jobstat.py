import datetime as dt

import pytest

from feedwright.operators import jobstat as js
from feedwright.operators.profile import compare_profiles, null_profile


def prof(spark, rows):
    return spark.createDataFrame(rows, "column_name string, n_rows long, null_pct double")


def test_null_profile_one_pass(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None), (None, None, "c"), (4, None, "d")],
                               "a int, b int, c string")
    got = {r.column_name: (r.n_rows, r.null_pct) for r in null_profile(df).collect()}
    assert got == {"a": (4, 25.0), "b": (4, 100.0), "c": (4, 25.0)}


def test_null_profile_empty_table(spark):
    df = spark.createDataFrame([], "a int")
    r = null_profile(df).collect()
    assert [(x.n_rows, x.null_pct) for x in r] == [(0, None)]


def test_compare_f7_edges(spark):
    left = prof(spark, [("c1", 10, 10.0), ("c2", 10, 10.2), ("c3", 10, 10.9), ("c4", 10, 100.0),
                        ("c5", 10, 99.9), ("c6", 0, None), ("only_left", 10, 0.0)])
    right = prof(spark, [("c1", 10, 11.0), ("c2", 10, 11.9), ("c3", 10, 11.1), ("c4", 10, 100.0),
                         ("c5", 10, 100.0), ("c6", 5, 0.0), ("only_right", 10, 0.0)])
    got = {r.column_name: (r.added, r.removed, r.null_defer, r.full_null_left, r.full_null_right)
           for r in compare_profiles(left, right).collect()}
    assert got["c1"][2:] == (False, False, False)
    assert got["c2"][2:] == (True, False, False)
    assert got["c3"][2:] == (False, False, False)
    assert got["c4"][2:] == (False, True, True)
    assert got["c5"][2:] == (False, False, True)
    assert got["c6"][2:] == (False, False, False)
    assert got["only_left"][:2] == (True, False) and got["only_right"][:2] == (False, True)


def jobstat_rows(spark, rows):
    """rows: (feed, jobpid, process_end, linecount, filedate, status)."""
    full = []
    for feed, pid, pe, lc, fd, st in rows:
        full.append((feed, pid, "f", pe, pe, lc, lc, fd, st, "", 0, 0, 0, 0, "", fd, lc))
    return spark.createDataFrame(full, js.JOBSTAT_SCHEMA)


D1, D2 = dt.date(2024, 1, 3), dt.date(2024, 1, 4)
T = dt.datetime(2024, 1, 3, 10)


def test_latest_linecount_f5(spark):
    rows = [("A", 1, T, 10, D1, js.EXTRACT_COMPLETED),
            ("A", 2, T + dt.timedelta(hours=1), None, D1, js.EXTRACT_COMPLETED),   # latest but null
            ("B", 3, T, 7, D1, js.EXTRACT_COMPLETED), ("B", 4, T, 8, D1, js.EXTRACT_COMPLETED),  # tie
            ("C", 5, T, 9, D1, js.COMPLETED)]                                    # no extract row
    got = {(r.feed, r.filedate): r.linecount for r in js.latest_linecount(jobstat_rows(spark, rows)).collect()}
    assert got == {("A", D1): "10", ("B", D1): "8"}


def test_high_water_mark_null_when_never(spark):
    rows = [("A", 1, T, 1, D1, js.COMPLETED), ("A", 2, T, 1, D2, js.COMPLETED),
            ("B", 3, T, 1, D2, js.EXTRACT_COMPLETED)]
    got = {r.feed: r.hwm for r in js.high_water_mark(jobstat_rows(spark, rows)).collect()}
    assert got == {"A": D2, "B": None}


def test_upsert_insert_update_idempotent(spark):
    state = jobstat_rows(spark, [("A", 1, T, 1, D1, "GENERATE EXTRACT SCRIPT"), ("B", 2, T, 1, D1, "X")])
    batch = jobstat_rows(spark, [("A", 1, T + dt.timedelta(minutes=5), 5, D1, js.COMPLETED),
                                 ("C", 3, T, 2, D1, "GENERATE EXTRACT SCRIPT")])
    once = js.upsert(state, batch)
    got = sorted((r.feed, r.jobpid, r.status, r.linecount) for r in once.collect())
    assert got == [("A", 1, js.COMPLETED, 5), ("B", 2, "X", 1), ("C", 3, "GENERATE EXTRACT SCRIPT", 2)]
    twice = js.upsert(once, batch)
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_upsert_latest_inside_batch(spark):
    state = jobstat_rows(spark, [])
    batch = jobstat_rows(spark, [("A", 1, T, 1, D1, "GENERATE EXTRACT SCRIPT"),
                                 ("A", 1, T + dt.timedelta(minutes=1), 2, D1, js.COMPLETED)])
    assert [(r.status, r.linecount) for r in js.upsert(state, batch).collect()] == [(js.COMPLETED, 2)]


def test_jobstat_check_missing_is_error(spark):
    j = jobstat_rows(spark, [("A", 1, T, 10, D1, js.EXTRACT_COMPLETED)])
    target = spark.createDataFrame([("A", D1, 10), ("A", D2, 3)], "feed string, filedate date, target_count long")
    chk = js.jobstat_check(j, target)
    got = {r.filedate: r.dq_status for r in chk.collect()}
    assert got == {D1: "MATCH", D2: "MISSING"}
    with pytest.raises(RuntimeError, match="No job stat"):
        js.require_jobstat(chk)


def test_completed_windows_semi(spark):
    j = jobstat_rows(spark, [("A", 1, T, 1, D1, js.COMPLETED)])
    req = spark.createDataFrame([("A", D1, D1), ("A", D2, D2)], "feed string, from_date date, end_date date")
    assert [r.from_date for r in js.completed_windows(j, req).collect()] == [D1]


def test_audit_record_has_17_fields(spark):
    a = js.audit_record(spark, "F", 7, "GENERATE EXTRACT SCRIPT", filedate=D1)
    assert len(a.columns) == 17 and a.first().file_end_dt == D1


def test_null_profile_awkward_column_names(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, 2, None)], "`it's` int, `a``b` int, `sp ace` string")
    got = {r.column_name: r.null_pct for r in null_profile(df).collect()}
    assert got == {"it's": 50.0, "a`b": 50.0, "sp ace": 50.0}
