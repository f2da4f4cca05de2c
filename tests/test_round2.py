"""Cases the registered queries don't reach: refusals, faults, formats, exactness, durable state."""

import datetime as dt
import decimal
import os

import pytest
from pyspark.sql import functions as F

from feedwright.functions.keys import lower_keys
from feedwright.operators import dq
from feedwright.operators.jobstat import JOBSTAT_SCHEMA, completed_windows
from feedwright.operators.metrics import path_bytes, total_and_external
from feedwright.operators.rules import unnumbered_jobs
from feedwright.plans.ingest import FeedSpec, audit_table, ingest, purge_path_partitions, status_table
from feedwright.plans.size_metrics import run_size_metrics
from feedwright.plans.xml_feed import xml_feed_to_csv
from feedwright.session import scratch_path
from feedwright.sinks.tables import retention_candidates, write_partitioned
from feedwright.sources import storage
from feedwright.sources.feeds import open_file
from feedwright.sources.files import read_first_n, read_multiline_csv
from feedwright.sources.jdbc import jdbc_url
from feedwright.sources.scans import read_sql_text, scan_delta, scan_sql, spark_format, split_statements
from feedwright.sources.xml import CORRUPT, read_xml_raw, read_xml_rows, xml_faults


def write(path, text, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as f:
        f.write(text)


def meta(*cols):
    return [{"SOURCECOLNM": c, "RAW_COL_INHIVE": c.upper(), "RFND_COL_INHIVE": c.upper(), "RFND_COL_TYPE_INHIVE": t, "IS_EXTRACTED": "Y",
             "IS_PARTITIONED": p, "SEQ_NB": i} for i, (c, t, p) in enumerate(cols)]


def source(spark):
    return spark.createDataFrame([(i, dt.datetime(2024, 1, 1 + i % 6, 5), f"s{i % 2}") for i in range(60)], "id long, ts timestamp_ntz, st string")


def spec(spark, cols, **kw):
    base = scratch_path(spark, "round2")
    return FeedSpec("F", source(spark), cols, f"{base}/raw", f"{base}/refined", delta_col="ts", **kw)


PLAIN = meta(("id", "BIGINT", "N"), ("ts", "DATE", "N"), ("st", "STRING", "N"))
BY_STATUS = meta(("id", "BIGINT", "N"), ("ts", "DATE", "N"), ("st", "STRING", "Y"))
BY_DATE = meta(("id", "BIGINT", "N"), ("ts", "DATE", "Y"), ("st", "STRING", "N"))


@pytest.mark.parametrize("cols", [PLAIN, BY_STATUS])
def test_truncate_p_is_refused_where_it_would_lose_rows(spark, cols):
    with pytest.raises(ValueError, match="outside the loaded window"):
        ingest(spark, spec(spark, cols, truncate="P"), "20240102")
    with pytest.raises(ValueError):
        write_partitioned(spark.range(1).toDF("id"), scratch_path(spark, "p"), [], truncate="P")


def test_truncate_y_replaces_the_table(spark):
    s = spec(spark, BY_STATUS, truncate="Y")
    for d in ("20240102", "20240103"):
        res = ingest(spark, s, d)
    assert spark.read.schema(res["refined_schema"]).parquet(s.refined_path).select("ts").distinct().collect()[0][0] == dt.date(2024, 1, 3)


def test_partial_rerun_drops_days_without_rows(spark):
    s = spec(spark, BY_DATE)
    ingest(spark, s, "20240101", "20240104")
    s.source = s.source.where("day(ts) <> 2")
    res = ingest(spark, s, "20240101", "20240104")
    assert res["rowcount"] == 30 and res["refined_count"] == 30
    assert storage.partition_values(spark, s.refined_path, "ts_ptn") == ["20240101", "20240103", "20240104"]


def test_status_is_durable_and_completed_windows_exit(spark):
    s = spec(spark, BY_DATE, status_path=scratch_path(spark, "state"))
    assert ingest(spark, s, "20240102")["decision"] == "RUN"
    assert ingest(spark, s, "20240102")["decision"] == "GRACEFUL_EXIT"
    assert ingest(spark, s, "20240103")["decision"] == "RUN"
    table = status_table(spark, s.status_path)
    assert {(r.filedate, r.status) for r in table.read().collect()} == {(dt.date(2024, 1, d), "COMPLETED SUCCESSFULLY") for d in (2, 3)}
    assert table.versions() == [1, 2]
    s.source = s.source.select("id")
    with pytest.raises(Exception):
        ingest(spark, s, "20240104", jobpid=77)
    assert "FAILED" in {r.status for r in audit_table(spark, s.status_path).where("jobpid = 77").collect()}
    # an unfinished version (no commit marker) is not read
    write(f"{table.path}/v3/part-0.parquet", "broken")
    assert table.versions() == [1, 2] and table.read().count() == 2


def test_versions_are_bounded(spark):
    from feedwright.sinks.tables import VersionedTable
    t = VersionedTable(spark, scratch_path(spark, "versions"), "id long", keep=3)
    assert t.read().count() == 0
    for i in range(5):
        t.save(spark.range(i + 1))
    assert t.versions() == [3, 4, 5] and t.read().count() == 5


def test_raw_size_and_purge_after_extract_only(spark):
    s = spec(spark, BY_DATE, raw_retention=2)
    ingest(spark, s, "20240101", stages="GE")
    res = ingest(spark, s, "20240105", stages="GE")
    assert res["raw_size"] > 0 and storage.partition_values(spark, s.raw_path, "loaddate") == ["20240105"]


def test_quality_flags_a_nulled_renamed_column(spark):
    s = spec(spark, BY_DATE)
    s.source = s.source.withColumn("st", F.when(F.col("id") % 2 == 0, "x").otherwise("7"))
    s.col_meta = [dict(r, RFND_COL_INHIVE="STATE_NO", RFND_COL_TYPE_INHIVE="INT") if r["SOURCECOLNM"] == "st" else r for r in s.col_meta]
    res = ingest(spark, s, "20240102", "20240103", stages="GELQ")
    q = {r.column_name: r for r in res["quality"].collect()}
    assert not any(r.added or r.removed for r in q.values()) and q["state_no"].right_pct > q["state_no"].left_pct
    assert any("1 column(s) flagged" in r.message for r in res["audit"].collect())


def test_postprocess_writes_the_window_only(spark):
    s = spec(spark, BY_DATE, postprocess="drop:st", publish_path=scratch_path(spark, "published"))
    ingest(spark, s, "20240101")
    res = ingest(spark, s, "20240102")
    assert {r.ts for r in res["postprocessed"].collect()} == {dt.date(2024, 1, 2)} and "st" not in res["postprocessed"].columns
    assert storage.names(spark, s.publish_path) == ["window=20240101-20240101", "window=20240102-20240102"]


def test_retention_on_other_partitions(spark):
    parts = spark.createDataFrame([("20240101",), ("2024-01-02",), ("east",), (None,)], "p string")
    assert sorted(r[0] for r in retention_candidates(parts, "p", dt.date(2024, 3, 1), 5).collect()) == ["2024-01-02", "20240101"]
    root = scratch_path(spark, "other")
    spark.createDataFrame([(1, "east"), (2, "20240101")], "id int, p string").write.partitionBy("p").parquet(root)
    assert purge_path_partitions(spark, root, "p", "20240301", 5) == ["20240101"]
    assert storage.partition_values(spark, root, "p") == ["east"]


def test_external_bytes_against_the_file_system(spark):
    root = scratch_path(spark, "sizes")
    spark.range(100).selectExpr("id", "id % 3 AS p").write.partitionBy("p").parquet(root)
    on_disk = lambda d, data: sum(os.path.getsize(os.path.join(b, f)) for b, _, fs in os.walk(d) for f in fs if (f[0] not in "_.") == data)
    r = total_and_external(spark, {"t": root}).first()
    # checksum files belong to the local file system itself, which doesn't list them
    crc = sum(os.path.getsize(os.path.join(b, f)) for b, _, fs in os.walk(root) for f in fs if f.endswith(".crc"))
    assert r.data_bytes == on_disk(root, True)
    write(f"{root}/_stats/x.json", "0123456789")
    r = total_and_external(spark, {"t": root}).first()
    assert r.external_bytes in (10, 10 + crc) and r.total_bytes == r.data_bytes + r.external_bytes
    assert path_bytes(spark, root, 3, ["p=0", "p=9"])[1] == 3 * path_bytes(spark, root, 1, ["p=0"])[0] > 0


def test_all_four_metrics(spark):
    rel = spark.createDataFrame([("dm", "t", 10, 5)], "nspname string, relname string, size_bytes long, reltuples long")
    ns = spark.createDataFrame([("dm",)], "nspname string")
    ptn = spark.createDataFrame([], "partitiontablename string, partitionschemaname string, tablename string, schemaname string")
    data, out = scratch_path(spark, "metric-data"), scratch_path(spark, "metric-rows")
    spark.range(10).write.parquet(data)
    run_size_metrics(rel, ns, ptn, ["dm"], dt.date(2024, 1, 1), out, {"t": data})
    assert {r.query_info for r in spark.read.parquet(out).collect()} == {
        "SCHEMA_SIZE", "TABLE_SIZE_AND_PARTITIONS", "DATABASE_SIZE", "TABLE_TOTAL_AND_EXTERNAL"}


def test_xml_rows_after_a_fault_survive(spark, tmp_path):
    write(f"{tmp_path}/x/a.xml", '<?xml version="1.0"?><!-- head --><R>\n<row><k>1</k></row><row><k>2</k><v></row><row a="x"><k>3</k></row>'
                                 '<row><k>4</k>\n<row><k>5</k></row><row/><row><k>6</k></row>\n</R>')
    write(f"{tmp_path}/x/b.xml", "<R><k>7</k></row><row><k>8</k></row><row><k>9</k><v>cut")
    raw = read_xml_raw(spark, f"{tmp_path}/x", "row", ["k", "v"])
    assert sorted(r.k for r in read_xml_rows(spark, f"{tmp_path}/x", "row", ["k", "v"], key="k").collect()) == ["1", "3", "5", "6", "8"]
    assert xml_faults(raw).first()["faults"] == 4        # 2, 4, the headless 7 and the cut 9
    assert all("<row" in r[CORRUPT] or "7" in r[CORRUPT] for r in raw.where(F.col(CORRUPT).isNotNull()).collect())
    res = xml_feed_to_csv(spark, f"{tmp_path}/x", "row", ["k", "v"], f"{tmp_path}/csv", key="k")
    assert (res["rows_written"], res["rows_faulty"], res["rows_rejected"]) == (5, 4, 1)
    assert res["status"] == "XML Parsing Completed With Errors"


def test_xml_is_split_at_records(spark, tmp_path):
    write(f"{tmp_path}/big.xml", "<R>" + "".join(f"<row><k>{i}</k></row>\n" for i in range(40000)) + "</R>")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        rows = read_xml_rows(spark, f"{tmp_path}/big.xml", "row", ["k"])
        assert rows.rdd.getNumPartitions() > 3 and rows.select("k").distinct().count() == 40000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_csv_and_lines(spark, tmp_path):
    write(f"{tmp_path}/c/a.csv", 'a,b\n1,""\n2,"x\ny",extra\n3\n')
    got = [tuple(r) for r in read_multiline_csv(spark, f"{tmp_path}/c", 3).orderBy("a").collect()]
    assert got == [("1", "", None), ("2", "x y", "extra"), ("3", None, None)]
    write(f"{tmp_path}/l/a.txt", b"a|b\r\nc|d\r\n", "wb")
    assert sorted(tuple(r) for r in read_first_n(spark, f"{tmp_path}/l", 2, "|").collect()) == [("a", "b"), ("c", "d")]
    df = open_file(spark, "20240105", f"{tmp_path}/<<%d>>/", "csv", ["x", "y"]) if os.path.isdir(f"{tmp_path}/05") else None
    assert df is None
    write(f"{tmp_path}/05/a.txt", "1;2\n")
    assert open_file(spark, "20240105", f"{tmp_path}/<<%d>>", "delimited", ["x", "y"], ";").collect()[0].asDict() == {"x": "1", "y": "2"}
    with pytest.raises(ValueError):
        open_file(spark, "20240105", str(tmp_path), "ebcdic", ["x"])


def test_delta_columns(spark):
    assert spark_format("YYYY-MM-DD HH24:MI:SS") == "yyyy-MM-dd HH:mm:ss" and spark_format("yyyyMMdd") == "yyyyMMdd"
    hours = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, CAST(id AS INT)) AS Ts FROM range(48)")
    assert scan_delta(hours, "TS", ">", "2024-01-01 10:00:00").count() == 37
    assert scan_delta(hours, "TS", from_val="20240101").count() == 24 and scan_delta(hours, "ts", "<>", "20240101").count() == 24
    text = spark.createDataFrame([("02/01/2024",), ("01/02/2024",)], "d string")
    assert scan_delta(text, "D", "=", "20240102", col_fmt="DD/MM/YYYY").count() == 1
    with pytest.raises(ValueError, match="doesn't sort"):
        scan_delta(text, "d", ">", "20240102", col_fmt="DD/MM/YYYY")
    with pytest.raises(ValueError):
        scan_delta(text, "missing", "=", "20240102")
    plan = scan_delta(spark.read.parquet("/root/testdata/sf0.001/orders.parquet"), "O_ORDERDATE", ">", "2024-01-01 10:00:00")
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan" in plan._jdf.queryExecution().executedPlan().toString()


def test_sql_text(spark, tmp_path):
    assert split_statements("SELECT ';' AS a; -- x;y\nSELECT \"a;b\", `c;d` /* ; */ ;") == ["SELECT ';' AS a", "-- x;y\nSELECT \"a;b\", `c;d` /* ; */"]
    assert scan_sql(spark, "SELECT 'a;b' AS v").first().v == "a;b"
    long = "SELECT 1 AS v /* " + "x" * 5000 + " */"
    write(f"{tmp_path}/q.sql", long)
    assert read_sql_text(spark, f"{tmp_path}/q.sql") == long == read_sql_text(spark, long)


def test_null_records_stay_null(spark):
    df = spark.sql("SELECT CAST(NULL AS STRUCT<A: INT>) AS R UNION ALL SELECT named_struct('A', 1)")
    assert sorted(str(r.r) for r in lower_keys(df).collect()) == ["None", "Row(a=1)"]


def test_statistics_compare_exactly(spark):
    big = 2 ** 53
    wide = lambda n, t: spark.createDataFrame([("g", n, t)], "sub_group string, n long, t string")
    status = {r.stat: r.dq_status for r in dq.reconcile(dq.to_stats(wide(big, "a")), dq.to_stats(wide(big + 1, "a"))).collect()}
    assert status == {"n": "MISMATCH", "t": "MATCH"}
    row = dq.reconcile(dq.to_stats(wide(big, "a")), dq.to_stats(wide(big + 1, "b")), tolerance=1).where("stat = 'n'").first()
    assert row.dq_status == "MATCH" and row["diff"] == decimal.Decimal(1)


def test_a_check_needs_one_row_per_group(spark):
    none = spark.createDataFrame([], "sub_group string, n long")
    with pytest.raises(RuntimeError, match="0 rows"):
        dq.require_single_row(none)
    one = spark.createDataFrame([("a", 1)], "sub_group string, n long")
    with pytest.raises(RuntimeError, match="0 rows for 'b'"):
        dq.require_single_row(one, expected=["a", "b"])
    with pytest.raises(RuntimeError, match="2 rows"):
        dq.require_single_row(one.union(one))


def test_parameters_of_source_queries():
    q = "SELECT <<N>>, <<S>>, <<D>>, <<X>> FROM <<T>>"
    args = {"N": 3, "S": "it's; DROP", "D": dt.date(2024, 1, 2), "X": None, "T": dq.Identifier("dw.orders")}
    assert dq.bound_text(q, args) == "SELECT 3, 'it''s; DROP', DATE '2024-01-02', NULL FROM dw.orders"
    with pytest.raises(ValueError):
        dq.bound_text(q, {"T": dq.Identifier("orders; DROP TABLE x")})


def test_scripts_run_where_they_belong(spark):
    from feedwright.plans.reconcile import reconcile_scripts
    t = dt.datetime(2024, 1, 3)
    jobstat = spark.createDataFrame([("F", 1, "f", t, t, 10, 10, t.date(), "EXTRACT_COMPLETED", "", 0, 0, 0, 0, "", t.date(), 10)], JOBSTAT_SCHEMA)
    tgt = spark.createDataFrame([("F|2024-01-03", 10), ("a", 2), ("b", 3)], "g string, n long")
    scripts = {"all.sql": "SELECT g AS sub_group, n AS linecount FROM dq_round2", "one.sql": "SELECT n AS linecount FROM dq_round2 WHERE g = <<SUB_GROUP>>"}
    cols = "sub_group_nm string, src_qry_scr string, tgt_qry_scr string, db_type string, db_server string, db_user string"
    plan = spark.createDataFrame([("F|2024-01-03", "-", "one.sql", "JOBSTAT", "s", "u"), ("a", "all.sql", "one.sql", "HIVE", "s", "u"),
                                  ("b", "all.sql", "one.sql", "HIVE", "s", "u")], cols)
    views = {"dq_round2": tgt.where("g <> 'F|2024-01-03'")}
    both = lambda v: reconcile_scripts(spark, plan, scripts.get, views=v, jobstat=jobstat)
    with pytest.raises(RuntimeError, match="0 rows"):
        both(views)           # the target has no row for the job-status group
    got = {(r.sub_group, r.stat): r.dq_status for r in reconcile_scripts(
        spark, plan, scripts.get, views={"dq_round2": tgt}, jobstat=jobstat).collect()}
    assert got == {("F|2024-01-03", "linecount"): "MATCH", ("a", "linecount"): "MATCH", ("b", "linecount"): "MATCH"}
    with pytest.raises(ValueError, match="no DQ check"):
        reconcile_scripts(spark, plan.withColumn("db_type", F.lit("CICS")), scripts.get, views=views)


def test_small_things(spark):
    assert jdbc_url("ORACLE-SQOOP-TNS", "tns1")[0] == "jdbc:oracle:thin:@tns1" and jdbc_url("sqlserver-sqoop", "h")[0] == "jdbc:sqlserver://h"
    jobs = spark.createDataFrame([("ABC012-X",), ("NONAME",), ("NONAME",)], "jobname string")
    assert [r.jobname for r in unnumbered_jobs(jobs).collect()] == ["NONAME"]
    d = dt.date(2024, 1, 1)
    rows = spark.createDataFrame([("A", i, "f", None, None, 1, 1, d, "COMPLETED SUCCESSFULLY", "", 0, 0, 0, 0, "", d, 1) for i in range(50)], JOBSTAT_SCHEMA)
    req = spark.createDataFrame([("A", d, d)], "feed string, from_date date, end_date date")
    found = completed_windows(rows, req)
    assert found.count() == 1 and "Aggregate" in found._jdf.queryExecution().executedPlan().toString()


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from feedwright.session import checkpoint_root
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None),
                           sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(fake)


def test_catalog_partitions_are_dropped(spark):
    from feedwright.sinks.tables import purge_partitions
    name, path = "purge_round2", scratch_path(spark, "purge-table")
    spark.createDataFrame([(1, "20240101"), (2, "20240220"), (3, "east")], "id int, p string").write.partitionBy("p").option(
        "path", path).saveAsTable(name)
    parts = spark.table(name).select("p").distinct()
    assert purge_partitions(spark, name, "p", retention_candidates(parts, "p", dt.date(2024, 3, 1), 30)) == 1
    assert sorted(r.id for r in spark.table(name).collect()) == [2, 3]
    spark.sql(f"DROP TABLE {name}")
