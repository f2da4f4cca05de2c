import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from feedwright.operators import metadata as md
from feedwright.operators.postprocess import apply_postprocessors
from feedwright.operators.report import format_status_report, parse_report_spec, run_reports
from feedwright.plans.calendar import plan_windows
from feedwright.plans.ingest import FeedSpec, ingest
from feedwright.session import scratch_path
from feedwright.sinks.tables import compact, retention_candidates, write_metrics, write_partitioned
from feedwright.sources.scans import dated_path, scan_delta, scan_raw, scan_refined, scan_sql


def test_table_metadata_f1(spark):
    cols = ("SOURCESCHEMA string, SOURCETBLNM string, EXTRACTLANDINGDIR string, HIVE_RAW_RETENTION int, "
            "REFRESH_REFINED_DDL_DML string, SOURCE_SQL_TXT string, HDFSEXTRACTDIR string")
    meta = spark.createDataFrame([("crm", "t1", "/a/b", None, "", "select 'x' from T", " Ex/Dir "),
                                  ("CRM", "T2", "/a/b/", 5, "n", None, "y")], cols)
    n = md.normalise_table_metadata(meta)
    rows = {r.SOURCETBLNM: r for r in n.collect()}
    assert rows["T1"].EXTRACTLANDINGDIR == "/a/b/" and rows["T2"].EXTRACTLANDINGDIR == "/a/b/"
    assert rows["T1"].HIVE_RAW_RETENTION == 0 and rows["T1"].REFRESH_REFINED_DDL_DML == "Y"
    assert rows["T1"].SOURCE_SQL_TXT == "select 'x' from T"          # kept as written (R30)
    assert rows["T1"].HDFSEXTRACTDIR == "ex/dir"
    assert md.lookup_table_metadata(n, "crm", "t1").count() == 1


def test_projection_and_twins_f2(spark):
    spec = md.projection_spec([
        {"SOURCECOLNM": "a", "RAW_COL_INHIVE": "A", "RFND_COL_INHIVE": "A_R", "RFND_COL_TYPE_INHIVE": "INT",
         "IS_EXTRACTED": "Y", "IS_PARTITIONED": "Y", "SEQ_NB": 2},
        {"SOURCECOLNM": "b", "RAW_COL_INHIVE": "B", "RFND_COL_INHIVE": "B_R", "RFND_COL_TYPE_INHIVE": "STRING",
         "IS_EXTRACTED": "N", "IS_PARTITIONED": "N", "SEQ_NB": 1},
        {"SOURCECOLNM": "c", "RAW_COL_INHIVE": "C", "RFND_COL_INHIVE": "C_R", "RFND_COL_TYPE_INHIVE": "DATE",
         "IS_EXTRACTED": "Y", "IS_PARTITIONED": "Y", "SEQ_NB": 0}])
    df = spark.createDataFrame([("12", "x", "2024-01-03"), ("oops", "y", "2024-01-04")], "a string, b string, c string")
    p = md.project(df, spec)
    assert p.columns == ["c_r", "a_r"]
    assert [r.a_r for r in p.collect()] == [12, None]                       # failed cast -> null
    assert md.cast_rejects(df, spec).first()["a_r"] == 1
    out, ptn, dq_col = md.add_partition_twins(p, ["c_r", "a_r"])
    assert ptn == "c_r_ptn,a_r_ptn" and dq_col == "c_r_ptn"
    assert out.first()["c_r_ptn"] == "20240103"


def test_scans(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, d, 12), f"2024010{d}") for d in range(1, 6)],
                               "ts timestamp_ntz, loaddate string")
    assert scan_raw(df, "20240102").count() == 1
    assert scan_raw(df, None).count() == 5
    assert scan_refined(df, "ts", "20240102", "20240104").count() == 3
    assert scan_refined(df, "ts", "20240102").count() == 1
    assert scan_refined(df, None, "20240102").count() == 5
    assert scan_delta(df, "ts", ">", "20240103").count() == 2
    assert scan_delta(df, "ts", "<=", "20240103").count() == 3
    assert scan_delta(df, None, ">", "20240103").count() == 5             # no delta column: 1 = 1
    assert dated_path("/land/<<%Y/%m/%d>>/x", "20240105") == "/land/2024/01/05/x"


def test_scan_sql_params_and_statement_list(spark):
    spark.createDataFrame([(1,), (2,), (3,)], "x int").createOrReplaceTempView("t_params")
    r = scan_sql(spark, "CREATE OR REPLACE TEMP VIEW t2 AS SELECT x FROM t_params WHERE x >= <<LO>>; "
                        "SELECT count(*) AS n FROM t2", {"LO": 2})
    assert r.first().n == 2


def test_report_spec_b8(spark):
    spec = "SELECT 1 AS a -> First :: SELECT 2 AS a :: SELECT 3 AS a WHERE 1 = 0 -> Empty"
    assert [n for n, _ in parse_report_spec(spec)] == ["First", "Report No 2", "Empty"]
    reps = run_reports(spark, spec)
    assert [df.count() for _, df in reps] == [1, 1, 0]


def test_report_positional_markers(spark):
    import datetime as _d
    spark.createDataFrame([("A", _d.date(2024, 1, 3)), ("A", _d.date(2024, 1, 4))],
                          "feed string, filedate date").createOrReplaceTempView("js_rep")
    spec = "SELECT feed, count(*) AS n FROM %s WHERE filedate = %s GROUP BY feed -> Day"
    [(name, df)] = run_reports(spark, spec, {"report_table": "js_rep", "report_dt": _d.date(2024, 1, 3)})
    assert name == "Day" and [tuple(r) for r in df.collect()] == [("A", 1)]


def test_numeric_delta_column(spark):
    df = spark.range(10).selectExpr("id", "id * 10 AS v")
    assert scan_delta(df, "v", ">", "40", col_type="NUMBER").count() == 5
    assert scan_delta(df, "v", "between", "10", "30", col_type="NUMBER").count() == 3
    assert scan_delta(df, "v", "=", "7.5", col_type="NUMBER").count() == 0


def test_status_report_format_f13(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 3), dt.datetime(2024, 1, 4, 13, 5), None,
                                 dt.datetime(2024, 1, 4, 13, 5, 9))],
                               "idx int, ExpectedExtractDate date, ActualExtractDate timestamp_ntz, "
                               "ExtractLagDays int, RunDateTime timestamp_ntz")
    r = format_status_report(df, hide_first=True).first()
    assert "idx" not in r.asDict()
    assert (r.ActualExtractDate, r.ExtractLagDays, r.RunDateTime, r.ActualFlag) == \
        ("2024-01-04", "NA", "2024-01-04 13:05:09 PM", "LATE")


def test_postprocessors_u3(spark):
    df = spark.createDataFrame([(1, " A ", 5), (1, " A ", 7), (2, "b", 1)], "k int, s string, v int")
    out = apply_postprocessors(df, "trim;upper:s;dedupe:k;rename:v=value")
    assert sorted(tuple(r) for r in out.collect()) == [(1, "A", 7), (2, "B", 1)]
    with pytest.raises(ValueError):
        apply_postprocessors(df, "explode")


def test_metrics_rerun_l3(spark):
    path = scratch_path(spark, "metrics-test")
    d1, d2 = dt.date(2024, 1, 15), dt.date(2024, 1, 16)
    mk = lambda d, v: spark.createDataFrame([(d, "x", v)], "process_dt date, k string, v long")
    write_metrics(mk(d1, 1), path)
    write_metrics(mk(d2, 2), path)
    write_metrics(mk(d1, 3), path)                 # rerun of day 1 replaces only day 1
    got = sorted((str(r.process_dt), r.v) for r in spark.read.parquet(path).collect())
    assert got == [("2024-01-15", 3), ("2024-01-16", 2)]


def test_truncate_modes_l2(spark):
    path = scratch_path(spark, "trunc")
    a = spark.createDataFrame([("1", 1), ("2", 2)], "p string, v int")
    write_partitioned(a, path, ["p"], truncate="P")
    write_partitioned(spark.createDataFrame([("2", 20)], "p string, v int"), path, ["p"], truncate="P")
    assert sorted((r.p, r.v) for r in spark.read.parquet(path).select(F.col("p").cast("string"), "v").collect()) == \
        [("1", 1), ("2", 20)]
    write_partitioned(spark.createDataFrame([("3", 3)], "p string, v int"), path, ["p"], truncate="N")
    assert spark.read.parquet(path).count() == 3
    write_partitioned(spark.createDataFrame([("4", 4)], "p string, v int"), path, ["p"], truncate="Y")
    assert spark.read.parquet(path).count() == 1


def test_compaction_and_retention_l7_l8(spark):
    src = scratch_path(spark, "raw-src")
    spark.range(100).repartition(8).write.parquet(src)
    out = compact(spark, src, scratch_path(spark, "raw-compact"), files=1)
    assert out.count() == 100 and out.inputFiles().__len__() == 1
    parts = spark.createDataFrame([("20240101",), ("20240110",), ("20240114",), ("20240115",)], "loaddate string")
    run = dt.date(2024, 1, 15)
    assert sorted(r[0] for r in retention_candidates(parts, "loaddate", run, 5).collect()) == ["20240101"]
    assert retention_candidates(parts, "loaddate", run, 0).count() == 0
    assert sorted(r[0] for r in retention_candidates(parts, "loaddate", run, -1).collect()) == \
        ["20240101", "20240110", "20240114", "20240115"]


def test_ingest_end_to_end_and_second_run_exits(spark):
    src = spark.createDataFrame([(i, dt.datetime(2024, 1, 1 + i % 5), f"s{i % 2}", "x" if i % 10 == 1 else str(i))
                                 for i in range(50)],
                                "id long, ts timestamp_ntz, st string, code string")
    meta = [{"SOURCECOLNM": "id", "RAW_COL_INHIVE": "ID", "RFND_COL_INHIVE": "ID", "RFND_COL_TYPE_INHIVE": "BIGINT",
             "IS_EXTRACTED": "Y", "IS_PARTITIONED": "N", "SEQ_NB": 1},
            {"SOURCECOLNM": "ts", "RAW_COL_INHIVE": "TS", "RFND_COL_INHIVE": "BUS_DT", "RFND_COL_TYPE_INHIVE": "DATE",
             "IS_EXTRACTED": "Y", "IS_PARTITIONED": "Y", "SEQ_NB": 2},
            {"SOURCECOLNM": "st", "RAW_COL_INHIVE": "ST", "RFND_COL_INHIVE": "ST", "RFND_COL_TYPE_INHIVE": "STRING",
             "IS_EXTRACTED": "N", "IS_PARTITIONED": "N", "SEQ_NB": 3},
            {"SOURCECOLNM": "code", "RAW_COL_INHIVE": "CODE", "RFND_COL_INHIVE": "CODE_NUM",
             "RFND_COL_TYPE_INHIVE": "INT", "IS_EXTRACTED": "Y", "IS_PARTITIONED": "N", "SEQ_NB": 4}]
    base = scratch_path(spark, "ingest-test")
    spec = FeedSpec("FEED1", src.repartition(6), meta, f"{base}/raw", f"{base}/refined", delta_col="ts",
                    operator="between", raw_retention=3)
    res = ingest(spark, spec, "20240102", "20240103", run_date="20240103", jobpid=11)
    raw_files = [f for f in os.listdir(f"{base}/raw/loaddate=20240102") if f.endswith(".parquet")]
    assert len(raw_files) == 1
    assert res["rowcount"] == 20 and res["refined_count"] == 20 and res["partition_col"] == "bus_dt_ptn"
    assert res["raw_size"] > 0 and res["raw_replica_size"] == 3 * res["raw_size"]
    assert res["cast_rejects"] == {"code_num": 5}       # ids 1, 11, 21, 31, 41: all on Jan 2
    statuses = [r.status for r in res["audit"].collect()]
    assert statuses[0] == "GENERATE EXTRACT SCRIPT" and statuses[-1] == "COMPLETED SUCCESSFULLY"
    state = res["jobstat"]
    assert [(r.feed, r.status) for r in state.collect()] == [("FEED1", "COMPLETED SUCCESSFULLY")]
    # a rerun of the same window replaces its partitions: same refined content
    before = sorted(map(tuple, spark.read.schema(res["refined_schema"]).parquet(spec.refined_path).collect()))
    again = ingest(spark, spec, "20240102", "20240103", run_date="20240103", jobpid=12, jobstat=state)
    after = sorted(map(tuple, spark.read.schema(res["refined_schema"]).parquet(spec.refined_path).collect()))
    assert before == after and again["refined_count"] == 20
    assert sorted(r.jobpid for r in again["jobstat"].collect()) == [11, 12]
    from feedwright.plans.ingest import persist_jobstat
    v = persist_jobstat(spark, again["jobstat"])
    assert spark.read.parquet(v).count() == 2
    # a second plan for the same window finds the completed row
    req = spark.createDataFrame([("FEED1", dt.date(2024, 1, 2), dt.date(2024, 1, 3), False)],
                                "feed string, explicit_from date, explicit_end date, override boolean")
    dec = spark.createDataFrame([], "feed string, eff_date date, run_switch string, n_calendar_rows long")
    assert plan_windows(req, dec, state).first().decision == "GRACEFUL_EXIT"
    for bad in ("XYZ", "EL", "Q", "GELF"):               # unknown, no G, no G, F without SQL
        with pytest.raises(ValueError):
            ingest(spark, spec, "20240102", stages=bad)
    with pytest.raises(NotImplementedError):
        ingest(spark, spec, "20240102", stages="P")


def test_bucketing_clause_and_colocated_join(spark):
    from feedwright.sinks.tables import parse_bucketing_clause, write_bucketed_table
    assert parse_bucketing_clause("") is None
    assert parse_bucketing_clause("CLUSTERED BY (A, b) SORTED BY (A) INTO 16 BUCKETS") == (["a", "b"], 16)
    cols, n = parse_bucketing_clause("CLUSTERED BY (K) INTO 4 BUCKETS")
    left = spark.range(200).selectExpr("id AS k", "id * 2 AS v")
    right = spark.range(200).selectExpr("id AS k", "id * 3 AS w")
    write_bucketed_table(spark, left, "t_bucket_l", n, cols, path=scratch_path(spark, "bl"))
    write_bucketed_table(spark, right, "t_bucket_r", n, cols, path=scratch_path(spark, "br"))
    j = spark.table("t_bucket_l").join(spark.table("t_bucket_r"), "k")
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and j.count() == 200


def test_ingest_with_custom_sql_file(spark):
    src = spark.createDataFrame([(i, dt.datetime(2024, 1, 1 + i % 5)) for i in range(50)], "id long, ts timestamp_ntz")
    meta = [{"SOURCECOLNM": "id", "RAW_COL_INHIVE": "ID", "RFND_COL_INHIVE": "ID", "RFND_COL_TYPE_INHIVE": "BIGINT",
             "IS_EXTRACTED": "Y", "IS_PARTITIONED": "N", "SEQ_NB": 1},
            {"SOURCECOLNM": "ts", "RAW_COL_INHIVE": "TS", "RFND_COL_INHIVE": "BUS_DT", "RFND_COL_TYPE_INHIVE": "DATE",
             "IS_EXTRACTED": "Y", "IS_PARTITIONED": "Y", "SEQ_NB": 2}]
    base = scratch_path(spark, "ingest-sql")
    os.makedirs(base, exist_ok=True)
    sql_file = os.path.join(base, "extract.sql")
    with open(sql_file, "w") as fh:
        fh.write("SELECT id, ts FROM src_custom WHERE to_date(ts) BETWEEN <<FROM_DT>> AND <<END_DT>> AND id % 2 = 0")
    spec = FeedSpec("FEED2", src, meta, f"{base}/raw", f"{base}/refined", source_sql=sql_file,
                    source_views={"src_custom": src})
    res = ingest(spark, spec, "20240102", "20240103", run_date="20240103", jobpid=21)
    assert res["rowcount"] == 10 and res["refined_count"] == 10


def test_ingest_quality_stage(spark):
    src = spark.createDataFrame([(i, dt.datetime(2024, 1, 2), None if i % 2 else "x") for i in range(20)],
                                "id long, ts timestamp_ntz, note string")
    meta = [{"SOURCECOLNM": "id", "RAW_COL_INHIVE": "ID", "RFND_COL_INHIVE": "ID", "RFND_COL_TYPE_INHIVE": "BIGINT",
             "IS_EXTRACTED": "Y", "IS_PARTITIONED": "N", "SEQ_NB": 1},
            {"SOURCECOLNM": "ts", "RAW_COL_INHIVE": "TS", "RFND_COL_INHIVE": "BUS_DT", "RFND_COL_TYPE_INHIVE": "DATE",
             "IS_EXTRACTED": "Y", "IS_PARTITIONED": "Y", "SEQ_NB": 2},
            {"SOURCECOLNM": "note", "RAW_COL_INHIVE": "NOTE", "RFND_COL_INHIVE": "NOTE", "RFND_COL_TYPE_INHIVE": "STRING",
             "IS_EXTRACTED": "Y", "IS_PARTITIONED": "N", "SEQ_NB": 3}]
    base = scratch_path(spark, "ingest-q")
    spec = FeedSpec("FEED3", src, meta, f"{base}/raw", f"{base}/refined", delta_col="ts")
    res = ingest(spark, spec, "20240102", stages="GELQ", jobpid=31)
    q = {r.column_name: (r.left_pct, r.right_pct, r.added, r.removed) for r in res["quality"].collect()}
    assert q["note"] == (50.0, 50.0, False, False)
    assert q["id"][:2] == (0.0, 0.0) and q["bus_dt"] == (0.0, 0.0, False, False)     # a renamed column is compared with itself
    assert "DATA QUALITY CHECKED" in [r.status for r in res["audit"].collect()]
