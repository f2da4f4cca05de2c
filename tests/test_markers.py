"""Parameters in SQL texts, sub-group scripts in one scan, targets on their own server, statistics beyond a decimal."""

import datetime as dt
import decimal

import pytest

from feedwright.operators import dq
from feedwright.plans import reconcile as rec
from feedwright.sources.scans import bind_markers, scan_sql, scan_sql_per_row


def test_markers_in_quotes(spark):
    one = lambda sql, **p: scan_sql(spark, sql, p).first()[0]
    assert one("SELECT count(*) FROM (SELECT 1) WHERE '2024' = '<<A>>'", A=2024) == 1
    assert one("SELECT 'x_<<A>>_<<B>>'", A="a", B=3) == "x_a_3"
    assert one("SELECT DATE '<<D>>' + 1", D=dt.date(2024, 1, 2)) == dt.date(2024, 1, 3)
    assert one("SELECT TIMESTAMP_NTZ '<<D>>'", D=dt.datetime(2024, 1, 2, 3, 4, 5)) == dt.datetime(2024, 1, 2, 3, 4, 5)
    nasty = "it's \\ \"x\" '; DROP TABLE t; --"
    for sql in ("SELECT '<<A>>'", 'SELECT "<<A>>"', "SELECT <<A>>", "SELECT << A >>"):
        assert one(sql, A=nasty) == nasty
    assert one("SELECT '<<NOBODY>>'", A=1) == "<<NOBODY>>"
    assert one("SELECT 'a:A' -- <<A>>\n", A=1) == "a:A"
    with pytest.raises(ValueError, match="in quotes"):
        one("SELECT '<<A>>'", A=None)
    with pytest.raises(Exception):
        one("SELECT <<NOBODY>>")


def test_bound_names_and_comments():
    assert bind_markers("SELECT `<<T>>` /* <<T>> */ FROM x", {"T": "a`b"}) == "SELECT `a``b` /* <<T>> */ FROM x"


def test_source_texts():
    q = "SELECT '<<S>>', 'd<<D>>', <<D>>, \"<<S>>\" FROM t -- <<S>>"
    assert dq.bound_text(q, {"S": "it's", "D": dt.date(2024, 1, 2)}) == \
        "SELECT 'it''s', 'd2024-01-02', DATE '2024-01-02', \"it's\" FROM t -- <<S>>"
    assert dq.bound_text("SELECT '<<X>>', <<Y>>", {}) == "SELECT '<<X>>', <<Y>>"


def sales(spark):
    return spark.createDataFrame([(f"g{i % 7}", i) for i in range(70)], "g string, v long")


def plan(spark, n, script="s.sql"):
    cols = "sub_group_nm string, src_qry_scr string, tgt_qry_scr string, db_type string, db_server string, db_user string"
    return spark.createDataFrame([(f"g{i}", script, "t.sql", "HIVE", "s", "u") for i in range(n)], cols)


@pytest.mark.parametrize("where", ["g = <<SUB_GROUP>>", "g = '<<SUB_GROUP>>'", "concat('g_', substr(g, 2)) = 'g_' || substr(<<SUB_GROUP>>, 2)",
                                   "'p_' || g = 'p_<<SUB_GROUP>>'", "g = :SUB_GROUP"])
def test_sub_groups_are_one_scan(spark, where, monkeypatch):
    calls = []
    real = rec.scan_sql
    monkeypatch.setattr(rec, "scan_sql", lambda *a, **k: calls.append(a) or real(*a, **k))
    scripts = {"s.sql": f"SELECT count(*) AS n, sum(v) AS total FROM mk_sales WHERE {where} AND v < <<MOST>>",
               "t.sql": "SELECT g AS sub_group, count(*) AS n, sum(v) AS total FROM mk_sales GROUP BY g"}
    found = rec.reconcile_scripts(spark, plan(spark, 7), scripts.get, {"MOST": 60}, {"mk_sales": sales(spark)})
    got = {(r.sub_group, r.stat): (r.src_value, r.dq_status) for r in found.collect()}
    for i in range(7):
        part = [v for v in range(70) if v % 7 == i]
        low = [v for v in part if v < 60]
        assert got[f"g{i}", "n"] == (len(low), "MATCH" if low == part else "MISMATCH") and got[f"g{i}", "total"][0] == sum(low)
    assert len(calls) == 1                                       # the target's script; the sub-groups needed none


def test_scripts_that_cant_be_joined_run_per_sub_group(spark):
    views = {"mk_sales": sales(spark)}
    keys = spark.createDataFrame([("g1",)], "SUB_GROUP string")
    listed = "CREATE OR REPLACE TEMP VIEW mk_one AS SELECT * FROM mk_sales WHERE g = <<SUB_GROUP>>; SELECT count(*) AS n FROM mk_one"
    assert scan_sql_per_row(spark, listed, keys, "SUB_GROUP", views=views) is None
    shown = "SELECT <<SUB_GROUP>> AS sub_group, count(*) AS n FROM mk_sales WHERE g = <<SUB_GROUP>>"
    scripts = {"s.sql": shown, "t.sql": "SELECT g AS sub_group, count(*) AS n FROM mk_sales GROUP BY g"}
    found = rec.reconcile_scripts(spark, plan(spark, 7), scripts.get, views=views)
    assert {r.dq_status for r in found.collect()} == {"MATCH"} and found.count() == 7


def test_a_missing_sub_group_is_refused(spark):
    scripts = {"s.sql": "SELECT g, count(*) AS n FROM mk_sales WHERE g = <<SUB_GROUP>> GROUP BY g", "t.sql": "SELECT g AS sub_group, count(*) AS n FROM mk_sales GROUP BY g"}
    with pytest.raises(RuntimeError, match="0 rows for 'g7'"):
        rec.reconcile_scripts(spark, plan(spark, 8), scripts.get, views={"mk_sales": sales(spark)})


def test_the_target_has_its_own_server(spark, monkeypatch):
    seen = []

    def jdbc(spark, db_type, server, query, user=None, password=None):
        seen.append((db_type, server, user, password))
        return spark.createDataFrame([(f"g{i}", 10) for i in range(2)], "sub_group string, n long")
    monkeypatch.setattr(rec, "scan_jdbc", jdbc)
    scripts = {"s.sql": "SELECT g AS sub_group, count(*) AS n FROM mk_sales WHERE g < 'g2' GROUP BY g", "t.sql": "SELECT sub_group, n FROM t"}
    views = {"mk_sales": sales(spark)}
    with pytest.raises(ValueError, match="needs a server"):
        rec.reconcile_scripts(spark, plan(spark, 2), scripts.get, views=views, target_type="ORACLE")
    for extra, place in (({"target": {"server": "tgt", "user": "me"}}, ("tgt", "me")), ({}, ("own", "you"))):
        p = plan(spark, 2)
        if not extra:
            p = p.selectExpr("*", "'own' AS tgt_db_server", "'you' AS tgt_db_user")
        found = rec.reconcile_scripts(spark, p, scripts.get, views=views, target_type="ORACLE", secrets={"tgt": "pw", "s": "no"}, **extra)
        assert {r.dq_status for r in found.collect()} == {"MATCH"}
        assert seen[-1] == ("ORACLE", *place, "pw" if place[0] == "tgt" else None)


def test_statistics_that_no_decimal_holds(spark):
    side = lambda v: dq.to_stats(spark.createDataFrame([("g", v)], "sub_group string, n double"))
    status = lambda a, b: dq.reconcile(side(a), side(b)).first().dq_status
    nan, big = float("nan"), 1e30
    assert (status(nan, nan), status(big, big), status(big, 2e30), status(nan, 1.0), status(big, 1.0)) == (
        "MATCH", "MATCH", "MISMATCH", "MISMATCH", "MISMATCH")
    assert status(1.5, 1.5) == "MATCH" and dq.reconcile(side(1.5), side(2.5)).first()["diff"] == decimal.Decimal(1)
