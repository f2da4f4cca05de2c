import pytest

from feedwright.functions.exprs import not_blank
from feedwright.operators import dq
from feedwright.operators.metadata import dq_plan
from feedwright.plans.reconcile import dq_reconcile


def test_dq_plan_f6_edges(spark):
    mdq = spark.createDataFrame([("SG1", "s1", "t1"), ("SG2", "s2", "t2")], "sub_group_nm string, src_qry_scr string, tgt_qry_scr string")
    grouping = spark.createDataFrame([("G", 1), ("OFF", 0)], "group_nm string, dq_chk_flg int")
    xref = spark.createDataFrame([("G", "SG1", "f1", "S", "T1"), ("OFF", "SG1", "f2", "S", "T1"),
                                  ("G", None, "f3", "S", "T1"), ("G", "", "f4", "S", "T1"),
                                  ("G", "SG2", "f5", "S", "NOMETA")],
                                 "group_nm string, sub_group_nm string, filename string, sourceschema string, sourcetblnm string")
    tbl = spark.createDataFrame([("S", "T1", "HIVE", "srv", "u")],
                                "sourceschema string, sourcetblnm string, db_type string, db_server string, db_user string")
    got = [(r.group_nm, r.sub_group_nm, r.filename) for r in dq_plan(mdq, grouping, xref, tbl).collect()]
    assert got == [("G", "SG1", "f1")]
    assert dq_plan(mdq, grouping, xref, tbl, group_nm="OFF").count() == 0


def test_reconcile_finds_injected_mismatch(spark):
    src = spark.createDataFrame([("A", 5), ("B", 3), ("C", 1)], "k string, v long")
    tgt = spark.createDataFrame([("A", 5), ("B", 2)], "k string, v long")
    views = {"dq_src": src, "dq_tgt": tgt}
    q = "SELECT k AS sub_group, count(*) AS n, sum(v) AS total FROM IDENTIFIER(<<T>>) GROUP BY k"
    res = dq_reconcile(spark, {"db_type": "HIVE", "query": q, "params": {"T": "dq_src"}, "views": views},
                       {"db_type": "hive", "query": q, "params": {"T": "dq_tgt"}, "views": views})
    got = {(r.sub_group, r.stat): r.dq_status for r in res.collect()}
    assert got[("A", "total")] == "MATCH" and got[("B", "total")] == "MISMATCH"
    assert got[("C", "n")] == "MISSING_TARGET"


def test_unknown_source_type_is_error(spark):
    with pytest.raises(ValueError):
        dq.run_check(spark, "MAINFRAME", query="select 1")


def test_every_source_type_dispatches():
    for t in ("HIVE", "JOBSTAT", "ORACLE", "ORACLE-SQOOP", "SYBASE-SQOOP", "TERADATA", "SQLSERVER", "GREENPLUM",
              "GPHDFS-PULL", "PSQL"):
        assert t in dq.CHECKS


def test_single_row_rule(spark):
    ok = spark.createDataFrame([("A", 1)], "sub_group string, n long")
    assert dq.require_single_row(ok) is ok
    bad = spark.createDataFrame([("A", 1), ("A", 2)], "sub_group string, n long")
    with pytest.raises(RuntimeError):
        dq.require_single_row(bad)


def test_blank_subgroups_dropped(spark):
    df = spark.createDataFrame([(None,), ("",), ("x",)], "s string")
    assert [r.s for r in df.where(not_blank("s")).collect()] == ["x"]


def test_jobstat_check_against_hive_target(spark):
    import datetime as dt

    from feedwright.operators.jobstat import EXTRACT_COMPLETED, JOBSTAT_SCHEMA
    t = dt.datetime(2024, 1, 3, 10)
    d = dt.date(2024, 1, 3)
    rows = [("F", 1, "f", t, t, 10, 10, d, EXTRACT_COMPLETED, "", 0, 0, 0, 0, "", d, 10),
            ("G", 2, "f", t, t, 7, 7, d, EXTRACT_COMPLETED, "", 0, 0, 0, 0, "", d, 7)]
    jobstat = spark.createDataFrame(rows, JOBSTAT_SCHEMA)
    target = spark.createDataFrame([("F|2024-01-03", 10), ("G|2024-01-03", 6)], "sub_group string, linecount long")
    src = dq.run_check(spark, "JOBSTAT", jobstat=jobstat)
    tgt = dq.run_check(spark, "HIVE", query="SELECT * FROM dq_tgt_lc", views={"dq_tgt_lc": target})
    got = {(r.sub_group, r.stat): r.dq_status for r in dq.reconcile(src, tgt).collect()}
    assert got == {("F|2024-01-03", "linecount"): "MATCH", ("G|2024-01-03", "linecount"): "MISMATCH"}


def test_reconcile_per_subgroup_scripts(spark):
    from feedwright.plans.reconcile import reconcile_scripts
    src = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5)], "g string, v long")
    tgt = spark.createDataFrame([("a", 1), ("a", 2), ("b", 4)], "g string, v long")
    scripts = {"s.sql": "SELECT count(*) AS n, sum(v) AS total FROM dq_s WHERE g = <<SUB_GROUP>>",
               "t.sql": "SELECT count(*) AS n, sum(v) AS total FROM dq_t WHERE g = <<SUB_GROUP>>"}
    plan = spark.createDataFrame([("G", "a", "s.sql", "t.sql", "HIVE", "srv"), ("G", "b", "s.sql", "t.sql", "HIVE", "srv")],
                                 "group_nm string, sub_group_nm string, src_qry_scr string, tgt_qry_scr string, "
                                 "db_type string, db_server string")
    res = reconcile_scripts(spark, plan, scripts.get, views={"dq_s": src, "dq_t": tgt})
    got = {(r.sub_group, r.stat): r.dq_status for r in res.collect()}
    assert got == {("a", "n"): "MATCH", ("a", "total"): "MATCH", ("b", "n"): "MATCH", ("b", "total"): "MISMATCH"}
