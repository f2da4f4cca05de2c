"""Loads that are repeated, fail or overlap: comparisons after an earlier load, reruns of failed loads, run status with
several writers, stages."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.operators.jobstat import STATUS_SCHEMA
from feedwright.operators.profile import compare_profiles, null_profile
from feedwright.operators.stored_profile import merged_profile, profile_store
from feedwright.plans.ingest import FeedSpec, ingest, read_refined, status_table
from feedwright.plans.run_feeds import run_feeds
from feedwright.queries import register
from feedwright.queries.duck import JOBSTAT
from feedwright.queries.loads import APRIL, MARCH, _meta, _spec
from feedwright.session import scratch_path
from feedwright.sinks.event_log import EventLog
from feedwright.sinks.files import write_csv
from feedwright.sources import derive, storage
from feedwright.sources.feeds import feed_spec, planned_feeds
from feedwright.sources.tables import read_table

#: The comparisons of a delta load.
COMPARISONS = (">", ">=", "<", "<=", "=", "<>")

_MONTH = "CAST(date_trunc('month', o_orderdate) AS DATE)"


@register("ingest_operators", " UNION ALL ".join(
    f"SELECT '{op}' AS operator, o_orderkey AS order_key, {_MONTH} AS order_month FROM orders "
    f"WHERE {_MONTH} BETWEEN DATE '1996-01-01' AND DATE '1996-05-01' OR {_MONTH} {op} DATE '1996-03-01'" for op in COMPARISONS))
def ingest_operators(spark, sf_dir):
    """Each comparison after an earlier load of five months, with default settings: what the comparison extracts is replaced
    or added, and every month that it doesn't extract stays."""
    months = read_table(spark, sf_dir, "orders").select("o_orderkey", F.to_date(F.date_trunc("month", "o_orderdate")).alias("o_month"))
    meta = [{"SOURCECOLNM": src, "RAW_COL_INHIVE": raw, "RFND_COL_INHIVE": rf, "RFND_COL_TYPE_INHIVE": typ, "IS_EXTRACTED": "Y",
             "IS_PARTITIONED": ptn, "SEQ_NB": i} for i, (src, raw, rf, typ, ptn) in enumerate((
                 ("o_orderkey", "ORDERKEY", "ORDER_KEY", "BIGINT", "N"), ("o_month", "MONTH", "ORDER_MONTH", "DATE", "Y")))]
    base = scratch_path(spark, "operators")
    feed = lambda i, op: FeedSpec(f"OP{i}", months, meta, f"{base}/raw{i}", f"{base}/refined{i}", delta_col="o_month", operator=op)
    runs = [(feed(i, "between"), "19960101", "19960501") for i in range(len(COMPARISONS))]
    first, _ = run_feeds(spark, runs, 6)
    second, results = run_feeds(spark, [(feed(i, op), "19960301", None) for i, op in enumerate(COMPARISONS)], 6)
    if bad := [r.asDict() for r in first.union(second).where("status <> 'LOADED' OR rowcount <> refined_count").collect()]:
        raise RuntimeError(f"loads failed or counted wrongly: {bad}")
    return reduce(DataFrame.unionByName, [
        read_refined(spark, feed(i, op), results["", f"OP{i}"]["refined_schema"]).select(
            F.lit(op).alias("operator"), "order_key", "order_month") for i, op in enumerate(COMPARISONS)])


@register("ingest_failed_rerun", " UNION ALL ".join(
    f"""SELECT '{n}' AS feed, o_orderkey AS order_key, o_totalprice AS total_price, o_orderstatus AS order_status FROM orders
        WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1996-03-31'""" for n in ("PLAIN", "BY_STATUS", "BY_DATE")))
def ingest_failed_rerun(spark, sf_dir):
    """A load that fails after its refined write (its published copy can't be written), its rerun, and a forced
    third run: each row is there once, without partitions, by status and by date."""
    blocked = scratch_path(spark, "blocked")
    storage.create_new(spark, blocked, "a file where a folder should be")
    specs = [_spec(spark, sf_dir, name, ptn, status_path=scratch_path(spark, f"status-{name}"), postprocess="drop:cust_key")
             for name, ptn in (("PLAIN", ()), ("BY_STATUS", ("o_orderstatus",)), ("BY_DATE", ("o_orderdate",)))]
    for s in specs:
        s.publish_path = f"{blocked}/{s.feed}"
    failed, _ = run_feeds(spark, [(s, *MARCH) for s in specs], 3)
    for s in specs:
        s.publish_path = scratch_path(spark, f"published-{s.feed}")
    again, _ = run_feeds(spark, [(s, *MARCH) for s in specs], 3)
    forced, results = run_feeds(spark, [(s, *MARCH) for s in specs], 3, override=True)
    states = [[r.status for r in df.orderBy("feed").collect()] for df in (failed, again, forced)]
    if states != [["FAILED"] * 3, ["LOADED"] * 3, ["LOADED"] * 3]:
        raise RuntimeError(f"unexpected run states {states}")
    return reduce(DataFrame.unionByName, [
        read_refined(spark, s, results["", s.feed]["refined_schema"]).select(
            F.lit(s.feed).alias("feed"), "order_key", "total_price", "order_status") for s in specs])


_J = f"WITH jobstat AS ({JOBSTAT})\n"


@register("status_log", _J + """
SELECT CASE WHEN jobpid % 3 = 0 THEN 'OPS' ELSE 'CRM' END AS schema_name, feed, jobpid, filedate, file_end_dt,
       status, CASE WHEN jobpid % 5 = 0 THEN 'second' ELSE 'first' END AS message, linecount, true AS bounded
FROM jobstat""")
def status_log(spark, sf_dir):
    """The run status of all feeds by two writers that take turns, one of whose writes fails before its commit and is
    repeated; every fifth run gets a second row. Every run is there with its last row, feeds of one name in two
    schemas apart, and the live files stay within the merge's bound."""
    runs = derive.jobstat_from_events(read_table(spark, sf_dir, "events")).withColumns({
        "schema_name": F.when(F.col("jobpid") % 3 == 0, "OPS").otherwise("CRM"), "stages": F.lit("GEL"), "message": F.lit("first")})
    # the keys' order is what counts, so the writers hold the same log
    path = scratch_path(spark, "status-log")
    args = (path, STATUS_SCHEMA, ("schema_name", "feed"), ("schema_name", "feed", "jobpid"))
    one, two = (EventLog(spark, *args, buckets=4, fan_in=4, grace=0) for _ in range(2))
    broken = runs.withColumn("linecount", F.expr("if(jobpid % 2 = 0, raise_error('the writer dies'), linecount)"))
    try:
        one.append(broken)
    except Exception as e:  # the failure is the case
        if "the writer dies" not in str(e):
            raise
    stale = runs.withColumn("status", F.lit("GENERATE EXTRACT SCRIPT"))
    for i in range(6):  # both write, in turns, the rows of one sixth of the runs: first as started, then as ended
        part = F.col("jobpid") % 6 == i
        one.append(stale.where(part))
        two.append(runs.where(part))
    two.append(runs.where("jobpid % 5 = 0").withColumn("message", F.lit("second")))
    live = {b: len(storage.names(spark, f"{path}/commits/{b}")) for b in storage.names(spark, f"{path}/commits")}
    if len(one.versions()) >= 13 * max(1, len(live)) or not live:
        raise RuntimeError(f"nothing was merged: {live}")
    return one.read().select("schema_name", "feed", "jobpid", "filedate", "file_end_dt", "status", "message", "linecount",
                             F.lit(max(live.values()) <= 8).alias("bounded"))


_N = "(SELECT count(*) FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1996-03-31')"


@register("ingest_stages", f"""
SELECT s AS schema_name, 'ORDERS' AS feed, 1 AS step, 'EXTRACT_COMPLETED' AS status, 'GE' AS stages, CAST({_N} AS BIGINT) AS rowcount,
       CAST(0 AS BIGINT) AS refined_count FROM (VALUES ('CRM')) v(s) UNION ALL
SELECT s, 'ORDERS', 2, 'COMPLETED SUCCESSFULLY', 'GL', 0, {_N} FROM (VALUES ('CRM')) v(s) UNION ALL
SELECT 'OPS', 'ORDERS', 4, 'COMPLETED SUCCESSFULLY', 'GEL', {_N}, {_N}""")
def ingest_stages(spark, sf_dir):
    """An extract alone doesn't complete its window, the load after it does; the next load exits. A table of the same name
    in another schema has its own status."""
    status, base = scratch_path(spark, "stages"), scratch_path(spark, "stage-feeds")
    orders, exits = read_table(spark, sf_dir, "orders"), []
    for step, (schema, stages) in enumerate((("CRM", "GE"), ("CRM", "GL"), ("CRM", "GEL"), ("OPS", "GEL")), 1):
        spec = FeedSpec("ORDERS", orders, _meta(("o_orderdate",)), f"{base}/{schema}/raw", f"{base}/{schema}/refined", delta_col="o_orderdate",
                        status_path=status, schema=schema)
        exits += [step] if ingest(spark, spec, *MARCH, stages=stages, jobpid=step)["decision"] == "GRACEFUL_EXIT" else []
    if exits != [3]:
        raise RuntimeError(f"runs {exits} exited")
    log = status_table(spark, status).read().where(F.col("filedate") == F.lit(dt.date(1996, 3, 1)))
    return log.select("schema_name", "feed", F.col("jobpid").cast("int").alias("step"), "status", "stages", "rowcount", "refined_count")


@register("ingest_bucketed", """
SELECT o_orderkey AS order_key, o_totalprice AS src_price, CASE WHEN o_orderkey % 50 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS tgt_price,
       CASE WHEN o_orderkey % 50 = 0 THEN 'MISMATCH' ELSE 'MATCH' END AS dq_status FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1996-04-30'""")
def ingest_bucketed(spark, sf_dir):
    """L2 with a bucketing clause: a feed and its target, each loaded in two windows (the first one twice) into bucketed tables, joined on the
    bucket column without an exchange; one file per bucket and load."""
    tables = []
    for name in ("BUCKETED_SRC", "BUCKETED_TGT"):
        spec = _spec(spark, sf_dir, name, bucketing="CLUSTERED BY (ORDER_KEY) SORTED BY (ORDER_KEY) INTO 4 BUCKETS")
        spec.table = f"fw_{name.lower()}_{spec.refined_path.rpartition('load-')[2].replace('/', '_').replace('-', '_').lower()}"
        if name.endswith("TGT"):
            spec.source = spec.source.withColumn("o_totalprice", F.expr("CASE WHEN o_orderkey % 50 = 0 THEN o_totalprice + 1 ELSE o_totalprice END"))
        for i, window in enumerate((MARCH, APRIL, MARCH)):
            res = ingest(spark, spec, *window, jobpid=i)
        files = [len(storage.file_sizes(spark, f"{spec.refined_path}/{f}")) for f in storage.names(spark, spec.refined_path) if "=" in f]
        if len(files) != 2 or max(files) > 4:
            raise RuntimeError(f"{name}: {files} files in its loads")
        tables.append(read_refined(spark, spec, res["refined_schema"]).select("order_key", F.col("total_price").alias(f"{name[-3:].lower()}_price")))
    # merge: a broadcast of a small side would hide what the buckets are for
    both = tables[0].hint("merge").join(tables[1], "order_key")
    if "Exchange hashpartitioning" in both._jdf.queryExecution().executedPlan().toString():
        raise RuntimeError("the join of two bucketed tables shuffles")
    return both.withColumn("dq_status", F.expr("CASE WHEN src_price = tgt_price THEN 'MATCH' ELSE 'MISMATCH' END"))


@register("profile_merged", """
SELECT 'order_key' AS column_name, count(*) AS left_rows, count(*) AS right_rows, 0.0 AS left_pct, 0.0 AS right_pct FROM orders WHERE {0} UNION ALL
SELECT 'price', count(*), count(*), 100.0 * count_if(o_custkey % 7 = 0) / count(*), 100.0 * count_if(o_custkey % 7 = 0) / count(*)
FROM orders WHERE {0}""".format("CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1996-04-30' AND NOT (o_orderdate >= DATE '1996-03-10' AND o_orderdate < DATE '1996-03-12')"))
def profile_merged(spark, sf_dir):
    """E3/D5/M5 from profiles stored per partition: two windows, the first loaded again without two of its days. The merged profile (left)
    equals a full scan (right), and no file of the refined table is opened for it."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", F.expr("CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_totalprice END").alias("o_price"),
                                                        "o_orderdate")
    meta = [{"SOURCECOLNM": src, "RAW_COL_INHIVE": raw, "RFND_COL_INHIVE": rf, "RFND_COL_TYPE_INHIVE": typ, "IS_EXTRACTED": "Y", "IS_PARTITIONED": ptn,
             "SEQ_NB": i} for i, (src, raw, rf, typ, ptn) in enumerate((
                 ("o_orderkey", "ORDERKEY", "ORDER_KEY", "BIGINT", "N"), ("o_price", "PRICE", "PRICE", "DOUBLE", "N"), ("o_orderdate", "ORDERDATE", "ORDER_DATE", "DATE", "Y")))]
    base = scratch_path(spark, "profiled")
    spec = FeedSpec("PROFILED", orders, meta, f"{base}/raw", f"{base}/refined", delta_col="o_orderdate", profile_path=f"{base}/profiles")
    for i, window in enumerate((MARCH, APRIL)):
        ingest(spark, spec, *window, jobpid=i)
    spec.source = orders.where("NOT (o_orderdate >= DATE'1996-03-10' AND o_orderdate < DATE'1996-03-12')")
    res = ingest(spark, spec, *MARCH, jobpid=2)
    stored = merged_profile(profile_store(spark, spec.profile_path), spec.refined_path)
    if any(f"{spec.refined_path}/" in f for f in stored.inputFiles()):
        raise RuntimeError("the stored profile reads the table")
    full = null_profile(read_refined(spark, spec, res["refined_schema"]))
    return compare_profiles(stored, full).where("column_name IN ('order_key', 'price')").select("column_name", "left_rows", "right_rows", "left_pct", "right_pct")


_FEED_SETTINGS = """
SELECT upper(c_name) AS feed, c_custkey AS k,
       CASE c_custkey % 4 WHEN 0 THEN 'HIVE' WHEN 1 THEN 'TERADATA' WHEN 2 THEN 'ORACLE-SQOOP' ELSE 'FILE' END AS db_type,
       CASE c_custkey % 3 WHEN 0 THEN 'P' WHEN 1 THEN 'Y' ELSE 'N' END AS trunc,
       c_custkey % 4 <> 0 AS has_delta, c_custkey % 9 = 0 AS has_sql,
       (4 + c_custkey) % 4 <> 0 AS date_col, (2 + c_custkey) % 4 <> 0 AS status_col,
       (4 * 5 + c_custkey) % 6 < (2 * 5 + c_custkey) % 6 AS date_first FROM customer"""


@register("ingest_all_feeds", f"""
WITH f AS ({_FEED_SETTINGS}),
g AS (SELECT *, CASE WHEN date_col AND (NOT status_col OR date_first) THEN 'date' WHEN status_col THEN 'value' ELSE 'plain' END AS first_ptn FROM f),
p AS (SELECT *, CASE WHEN trunc = 'P' AND NOT (first_ptn = 'date' AND (has_delta OR has_sql)) THEN 'truncate P would replace other windows'
                     WHEN db_type = 'FILE' AND has_delta AND NOT date_col THEN 'the delta column isn''t in the file' END AS problem,
             db_type || '|' || trunc || '|' || CASE WHEN has_delta THEN 'delta' ELSE 'all' END || '|' || CASE WHEN has_sql THEN 'sql' ELSE 'table' END
               || '|' || first_ptn AS settings FROM g)
SELECT 'CRM' AS schema_name, feed, settings, problem, CASE WHEN problem IS NULL THEN 'LOADED' ELSE 'INVALID' END AS status,
       CASE WHEN problem IS NOT NULL THEN NULL
            WHEN has_delta AND NOT has_sql THEN (SELECT count(*) FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1996-03-31')
            WHEN has_sql THEN (SELECT count(*) FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1996-03-01')
            ELSE (SELECT count(*) FROM orders) END AS rowcount
FROM p""")
def ingest_all_feeds(spark, sf_dir):
    """B1, B2 -> M2/M3 for all metadata rows: every feed's spec is built and checked in one DataFrame step; bad ones are reported. The good ones
    load side by side, one feed for each combination of settings (all feeds here have the same source, so feeds of
    equal settings load the same), and each feed is reported with what its settings loaded."""
    customer, orders = read_table(spark, sf_dir, "customer"), read_table(spark, sf_dir, "orders")
    tables = derive.table_metadata_from_customers(customer)
    tables = tables.withColumn("SOURCE_SQL_TXT", F.when(F.trim("SOURCE_SQL_TXT") != "", "SELECT * FROM fw_feed_orders WHERE to_date(o_orderdate) = <<FROM_DT>>").otherwise(""))
    feeds = planned_feeds(tables, derive.column_metadata_from_customers(customer))
    base = scratch_path(spark, "all-feeds")
    # one feed of each combination of settings: settings are few, whatever the number of feeds
    row = F.struct(*[c for c in feeds.columns if c != "settings"])
    chosen = feeds.where("problem IS NULL").groupBy("settings").agg(F.min_by(row, "SOURCETBLNM").alias("r")).select("settings", "r.*").collect()
    landed = orders.select(*[F.col(c).cast("string") if c != "o_orderdate" else F.date_format(c, "yyyy-MM-dd").alias(c) for c in orders.columns])
    runs = []
    for i, row in enumerate(chosen):
        table = row.asDict()
        columns = [c.asDict() for c in row["feed_columns"]]
        if table["DB_TYPE"] == "FILE" and not table["SOURCE_SQL_TXT"]:
            table["EXTRACTLANDINGDIR"], table["DELTACOLUMNFMT"] = f"{base}/{i}{table['EXTRACTLANDINGDIR']}", "YYYY-MM-DD"
            write_csv(landed.select(*[c["SOURCECOLNM"] for c in columns]), f"{table['EXTRACTLANDINGDIR']}orders_19960301", sep=table["DELIMITER"] or ",")
        spec = feed_spec(table, columns, f"{base}/{i}", source=None if table["DB_TYPE"] == "FILE" else orders, file_kind="delimited",
                         file_name="orders_<<%Y%m%d>>", views={"fw_feed_orders": orders})
        runs.append((spec, *MARCH))
    report, _ = run_feeds(spark, runs, 6)
    loaded = spark.createDataFrame([(r["settings"], s.feed) for r, (s, _, _) in zip(chosen, runs, strict=True)], "settings string, loaded_feed string").join(
        report.select(F.col("feed").alias("loaded_feed"), "status", "message", "rowcount"), "loaded_feed")
    out = feeds.join(loaded, "settings", "left")
    if bad := out.where("problem IS NULL AND status <> 'LOADED'").select("settings", "message").distinct().collect():
        raise RuntimeError(f"feeds failed: {bad}")
    return out.select(F.col("SOURCESCHEMA").alias("schema_name"), F.col("SOURCETBLNM").alias("feed"), "settings", "problem",
                      F.when(F.col("problem").isNotNull(), "INVALID").otherwise(F.col("status")).alias("status"),
                      F.when(F.col("problem").isNull(), F.col("rowcount")).alias("rowcount"))
