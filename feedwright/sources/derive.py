"""At-scale inputs derived from the driver tables (FIXTURES.md F3-F9).

The reference keeps its control data (calendar, run status, DQ plan, catalog
sizes) in a metadata database. Here every such table is derived by Spark from
the driver tables, so each query's work grows with them.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwright.functions.exprs import ts_literal

# Run-status vocabulary written by the ingest job, by event_id % 4.
STATUS_BY_MOD4 = ("COMPLETED SUCCESSFULLY", "EXTRACT_COMPLETED",
                  "Completed Execute source db script", "GENERATE EXTRACT SCRIPT")
COMPLETED = "COMPLETED SUCCESSFULLY"
EXTRACT_COMPLETED = "EXTRACT_COMPLETED"

# Weekday flag columns, Monday first.
WEEKDAYS = ("MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN")

# Catalog schemas, by p_partkey % 6 (mixed case on purpose), and
# the schemas the size metrics keep.
SCHEMA_BY_MOD6 = ("dm", "Dops", "STAGE", "bak", "scratch", "Archive")
METRIC_SCHEMAS = ("DM", "DOPS", "STAGE", "BAK")

PLAN_RUN_DATE = _dt.date(2024, 1, 15)
EXPLICIT_DATE = _dt.date(2024, 1, 5)
HOLIDAY_BASE = _dt.date(2024, 1, 1)


def jobstat_from_events(events: DataFrame, feed: Column | str | None = None) -> DataFrame:
    """one run-status row per event, keyed by (feed, jobpid)."""
    if isinstance(feed, Column):
        events = events.withColumn("__feed", feed)
        feed_sql = "__feed"
    else:
        feed_sql = feed or "upper(event_type)"
    lc = "CASE WHEN event_id % 11 = 0 THEN CAST(NULL AS BIGINT) ELSE CAST(floor(value * 100) AS BIGINT) END"
    rc = f"{lc} - CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END"
    statuses = ", ".join(f"'{x}'" for x in STATUS_BY_MOD4)
    return events.selectExpr(
        f"{feed_sql} AS feed", "event_id AS jobpid",
        "concat(lower(event_type), '_', date_format(ts, 'yyyyMMdd'), '.dat') AS filename",
        "ts AS process_start",
        "ts + make_dt_interval(0, 0, CAST(event_id % 7 + 1 AS INT)) AS process_end",
        f"{lc} AS linecount", f"{rc} AS rowcount", "to_date(ts) AS filedate",
        f"element_at(array({statuses}), CAST(event_id % 4 + 1 AS INT)) AS status",
        "'' AS message", "event_id * 10 AS raw_size", "event_id * 30 AS raw_replica_size",
        "event_id * 8 AS refined_size", "event_id * 24 AS refined_replica_size",
        "'filedate_ptn' AS partition_col", "to_date(ts) AS file_end_dt", f"{rc} AS refined_count")


def planning_jobstat(events: DataFrame, customer: DataFrame, run_date=PLAN_RUN_DATE) -> DataFrame:
    """F5 for planning: rows before the run date, feed = c_name of the user."""
    before = events.where(F.col("ts") < ts_literal(run_date))
    joined = before.join(customer.select(F.col("c_custkey").alias("user_id"), "c_name"), "user_id")
    return jobstat_from_events(joined, "c_name")


def calendar_from_customers(customer: DataFrame) -> DataFrame:
    """the calendar rows of the feeds (customers). Every 11th table name occurs in a second
    schema with other flags, every 13th feed has no row in the first one, every 17th has two."""
    flags = [f"CASE WHEN shiftright(c_custkey + shift, {i}) % 2 = 1 THEN 'Y' ELSE 'N' END AS RUN_ON_{d}"
             for i, d in enumerate(WEEKDAYS)]
    entries = customer.selectExpr("c_custkey", "c_name", """explode(filter(array(
        named_struct('s', 'CRM', 'shift', 0, 'ok', c_custkey % 13 <> 0),
        named_struct('s', 'CRM', 'shift', 0, 'ok', c_custkey % 17 = 0),
        named_struct('s', 'ERP', 'shift', 3, 'ok', c_custkey % 11 = 0)), x -> x.ok)) AS e""").selectExpr(
        "c_custkey", "c_name", "e.s AS s", "e.shift AS shift")
    return entries.selectExpr(
        "s AS SOURCESCHEMA", "c_name AS SOURCETBLNM", "CAST((c_custkey + shift) % 5 AS INT) AS LAG_DAYS",
        "CASE WHEN (c_custkey + shift) % 3 = 0 THEN 'Y' ELSE 'N' END AS RUN_ON_HOLIDAY", *flags)


def holidays_from_orders(orders: DataFrame) -> DataFrame:
    """holiday dates (at most 30 distinct by construction)."""
    k = "datediff(to_date(o_orderdate), DATE'1995-01-01') % 30"
    return (orders.where("o_orderkey % 97 = 0").selectExpr(f"{k} AS k").where("k % 4 = 0")
            .selectExpr(f"date_add(DATE'{HOLIDAY_BASE.isoformat()}', CAST(k AS INT)) AS HOLIDAY_DT",
                        "concat('HOLIDAY ', CAST(k AS STRING)) AS HOLIDAY_DESC")
            .distinct())


def plan_requests(customer: DataFrame) -> DataFrame:
    """One planning request per feed of the first schema, and of the second where the name occurs there;
    some ask for an explicit window."""
    d = f"DATE'{EXPLICIT_DATE.isoformat()}'"
    return customer.selectExpr(
        "c_custkey", "c_name", "explode(filter(array('CRM', CASE WHEN c_custkey % 11 = 0 THEN 'ERP' END), x -> x IS NOT NULL)) AS s",
    ).selectExpr(
        "s AS schema_name", "c_name AS feed",
        f"CASE WHEN c_custkey % 10 = 9 THEN {d} END AS explicit_from",
        f"CASE WHEN c_custkey % 10 = 9 THEN {d} END AS explicit_end",
        "c_custkey % 20 = 19 AS override")


def lineitem_raw(lineitem: DataFrame) -> DataFrame:
    """F7 raw side: l_discount null on line 1, l_tax always null."""
    repl = {"l_discount": "CASE WHEN l_linenumber = 1 THEN CAST(NULL AS DOUBLE) ELSE l_discount END AS l_discount",
            "l_tax": "CAST(NULL AS DOUBLE) AS l_tax"}
    return lineitem.selectExpr(*[repl.get(c, c) for c in lineitem.columns])


def lineitem_refined(lineitem: DataFrame) -> DataFrame:
    """F7 refined side: no l_returnflag, a load_tag, l_discount null on lines 1-2."""
    repl = {"l_discount": "CASE WHEN l_linenumber IN (1, 2) THEN CAST(NULL AS DOUBLE) ELSE l_discount END "
                          "AS l_discount",
            "l_tax": "CAST(NULL AS DOUBLE) AS l_tax"}
    return lineitem.selectExpr(*[repl.get(c, c) for c in lineitem.columns if c != "l_returnflag"], "'r1' AS load_tag")


def dq_metadata(region: DataFrame, nation: DataFrame, supplier: DataFrame) -> dict[str, DataFrame]:
    """the four DQ-plan tables, derived from region / nation / supplier."""
    k = F.col("s_suppkey")
    grouping = region.select(F.col("r_name").alias("group_nm"),
                             F.when(F.col("r_regionkey") % 4 == 3, F.lit(0)).otherwise(F.lit(1)).alias("dq_chk_flg"))
    sub = F.concat(F.lit("SG_"), (k % 50).cast("string"))
    xref = (supplier.join(nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey"), "s_nationkey")
            .join(region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("group_nm")),
                  "n_regionkey")
            .select("group_nm",
                    F.when(k % 10 == 7, F.lit(None).cast("string")).when(k % 10 == 8, F.lit(""))
                    .otherwise(sub).alias("sub_group_nm"),
                    F.concat(F.lower("s_name"), F.lit(".dat")).alias("filename"),
                    F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("sourceschema"),
                    F.upper("s_name").alias("sourcetblnm")))
    db_types = F.element_at(F.array(F.lit("HIVE"), F.lit("TERADATA"), F.lit("ORACLE"), F.lit("JOBSTAT")),
                            (k % 4 + 1).cast("int"))
    tbl_meta = supplier.where(k % 13 != 0).select(
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("sourceschema"),
        F.upper("s_name").alias("sourcetblnm"),
        db_types.alias("db_type"),
        F.concat(F.lit("srv"), F.col("s_nationkey").cast("string")).alias("db_server"),
        F.concat(F.lit("u"), (k % 3).cast("string")).alias("db_user"))
    metadata_dq = (supplier.select((k % 50).alias("g")).distinct().where(F.col("g") % 7 != 6)
                   .select(F.concat(F.lit("SG_"), F.col("g").cast("string")).alias("sub_group_nm"),
                           F.concat(F.lit("src_"), F.col("g").cast("string"), F.lit(".sql")).alias("src_qry_scr"),
                           F.concat(F.lit("tgt_"), F.col("g").cast("string"), F.lit(".sql")).alias("tgt_qry_scr")))
    return {"metadata_dq": metadata_dq, "grouping": grouping, "entity_group_xref": xref,
            "table_metadata": tbl_meta}


def catalog_from_part(part: DataFrame) -> dict[str, DataFrame]:
    """F8: relations, namespaces and partitions of a database catalog."""
    k = F.col("p_partkey")
    schema = F.element_at(F.array(*[F.lit(s) for s in SCHEMA_BY_MOD6]), (k % 6 + 1).cast("int"))
    relations = part.select(
        F.concat(F.lit("t_"), k.cast("string")).alias("relname"),
        schema.alias("nspname"),
        F.call_function("shiftleft", F.round(F.col("p_retailprice") * 100).cast("long"),
                        (F.col("p_size") % 28).cast("int")).alias("size_bytes"),
        (F.col("p_size").cast("long") * 1000 + k % 97).alias("reltuples"),
        F.col("p_brand").alias("brand"),
        k.alias("relid"))
    namespaces = relations.select("nspname").distinct()
    partitions = relations.where(F.col("relid") % 4 != 0).select(
        F.col("relname").alias("partitiontablename"),
        F.col("nspname").alias("partitionschemaname"),
        F.concat(F.lit("p_"), F.lower(F.regexp_replace("brand", "#", ""))).alias("tablename"),
        F.col("nspname").alias("schemaname"))
    return {"relations": relations.drop("brand"), "namespaces": namespaces, "partitions": partitions}


def job_conditions_from_part(part: DataFrame) -> DataFrame:
    """F9 at scale: one job per part — name, its (last) in-condition and out-condition."""
    k = F.col("p_partkey")
    num = F.lpad(((F.col("p_size") * 17) % 1000).cast("string"), 3, "0")
    job = F.concat(F.lit("JB"), num, F.lit("-"), F.upper(F.split_part(F.col("p_type"), F.lit(" "), F.lit(1))),
                   k.cast("string"))
    inc = (F.when(k % 5 == 0, F.lit(None).cast("string"))
           .when(k % 5 == 1, F.concat(F.lit("PL-"), job, F.lit("-OK")))
           .when(k % 5 == 2, F.lit("WAIT"))
           .when(k % 5 == 3, F.lit("WAIT-OK"))
           .otherwise(F.lit("PL-X")))
    out = F.when(k % 3 == 0, F.concat(F.lit("PL-"), job, F.lit("-BAD"))).otherwise(F.concat(F.lit("PL-"), job, F.lit("-OK")))
    return part.select(k.alias("job_id"), job.alias("jobname"), inc.alias("incond"), out.alias("outcond"),
                       (F.col("p_size") % 2 == 0).alias("two_inconds"))


def job_definitions_from_part(part: DataFrame) -> DataFrame:
    """F9 shaped for the XML writer: attribute columns, repeated conditions
    (jobs with an even size get a first in-condition before the real one)."""
    c = job_conditions_from_part(part)
    inc = F.col("incond")
    incond = F.when(inc.isNull(), F.lit(None)).when(
        F.col("two_inconds"), F.array(F.struct(F.lit("FIRST-IN").alias("_NAME")), F.struct(inc.alias("_NAME")))
    ).otherwise(F.array(F.struct(inc.alias("_NAME"))))
    return c.select(F.col("jobname").alias("_JOBNAME"), incond.alias("INCOND"),
                    F.array(F.struct(F.col("outcond").alias("_NAME"))).alias("OUTCOND"))


def orders_with_nulls(orders: DataFrame) -> DataFrame:
    """Orders with injected nulls for the profile (driver tables hold none)."""
    return orders.select(
        "o_orderkey", "o_custkey",
        F.when((F.col("o_orderkey") % 5 == 0) & (F.col("o_orderstatus") == "F"), F.lit(None).cast("string"))
        .otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_custkey") % 7 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
    )


def table_metadata_from_customers(customer: DataFrame) -> DataFrame:
    """F1 at scale: one raw (not yet normalised) table-metadata row per feed."""
    k = F.col("c_custkey")
    seg = F.lower("c_mktsegment")
    nat = F.col("c_nationkey").cast("string")
    db_type = F.element_at(F.array(F.lit("hive"), F.lit("teradata"), F.lit("oracle-sqoop"), F.lit("file")),
                           (k % 4 + 1).cast("int"))
    trunc = F.element_at(F.array(F.lit("p"), F.lit("y"), F.lit("n")), (k % 3 + 1).cast("int"))
    s = lambda v: F.lit(v)
    return customer.select(
        F.when(k % 2 == 0, s("crm")).otherwise(s("CRM")).alias("SOURCESCHEMA"),
        F.col("c_name").alias("SOURCETBLNM"),
        s("daily").alias("REFRESHRATE"),
        F.when(k % 4 == 0, s("")).otherwise(s("o_orderdate")).alias("DELTACOLUMN"),
        s("date").alias("DELTACOLUMNTYPE"),
        s("yyyymmdd").alias("DELTACOLUMNFMT"),
        db_type.alias("DB_TYPE"),
        F.concat(s("srv"), nat).alias("DB_SERVER"),
        seg.alias("DB_USER"),
        F.concat(s("/landing/"), seg, F.when(k % 2 == 0, s("/")).otherwise(s(""))).alias("EXTRACTLANDINGDIR"),
        F.concat(s("/Data/"), F.col("c_mktsegment")).alias("HDFS_BASEDIR"),
        F.concat(s("  Extract/"), nat, s(" ")).alias("HDFSEXTRACTDIR"),
        F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(s("|")).alias("DELIMITER"),
        s("").alias("BUCKETINGCLAUSE"),
        s("stage").alias("TGT_STG_DB"),
        s("dm").alias("TGT_DB"),
        trunc.alias("HIVE_TBL_TRUNCATE"),
        F.lower(F.regexp_replace("c_name", "#", "_")).alias("TRGTTBLNM"),
        F.concat(s(" /Raw/"), nat).alias("HIVE_RAW_DIR"),
        F.concat(s("/Refined/"), nat, s(" ")).alias("HIVE_REFINED_DIR"),
        F.when(k % 7 == 0, s("")).otherwise(s("n")).alias("REFRESH_REFINED_DDL_DML"),
        s("n").alias("V1SUPPORT"),
        F.when(k % 9 == 0, s("select * from Orders where o_custkey = <<CUST>>")).otherwise(s("")).alias("SOURCE_SQL_TXT"),
        F.when(k % 6 == 0, s("o_orderkey")).otherwise(F.lit(None).cast("string")).alias("SPLIT_BY"),
        F.when(k % 8 == 0, F.lit(None).cast("string")).otherwise(s("parquet")).alias("RFND_FILE_FMT"),
        F.when(k % 4 == 1, F.lit(None).cast("int")).otherwise((k % 30).cast("int")).alias("HIVE_RAW_RETENTION"),
        F.when(k % 10 == 0, F.lit(None).cast("int")).otherwise(F.lit(90)).alias("HIVE_REFINED_RETENTION"),
    )


# The orders columns each feed's column metadata describes, with
# raw name, refined name and refined type.
ORDERS_COLUMN_META = (
    ("o_orderkey", "ORDERKEY", "ORDER_KEY", "BIGINT"),
    ("o_custkey", "CUSTKEY", "CUST_KEY", "INT"),
    ("o_orderstatus", "ORDERSTATUS", "ORDER_STATUS", "STRING"),
    ("o_totalprice", "TOTALPRICE", "TOTAL_PRICE", "DOUBLE"),
    ("o_orderdate", "ORDERDATE", "ORDER_DATE", "DATE"),
    ("o_orderpriority", "ORDERPRIORITY", "ORDER_PRIORITY", "STRING"),
)


def column_metadata_from_customers(customer: DataFrame) -> DataFrame:
    """F2 at scale: six column rows per feed, SEQ_NB a per-feed permutation,
    some columns not extracted, o_orderdate and o_orderstatus partitioned."""
    k = F.col("c_custkey")
    entries = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(src).alias("SOURCECOLNM"), F.lit(raw).alias("RAW_COL_INHIVE"),
                                 F.lit(rf).alias("RFND_COL_INHIVE"), F.lit(t).alias("RFND_COL_TYPE_INHIVE"))
                        for i, (src, raw, rf, t) in enumerate(ORDERS_COLUMN_META)])
    e = customer.select(F.lit("CRM").alias("SOURCESCHEMA"), F.col("c_name").alias("SOURCETBLNM"),
                        k.alias("k"), F.explode(entries).alias("m"))
    i = F.col("m.i")
    return e.select(
        "SOURCESCHEMA", "SOURCETBLNM", "m.SOURCECOLNM", "m.RAW_COL_INHIVE", "m.RFND_COL_INHIVE",
        "m.RFND_COL_TYPE_INHIVE",
        F.lit("").alias("LENGTH"),
        F.when((i + F.col("k")) % 4 == 0, F.lit("N")).otherwise(F.lit("Y")).alias("IS_EXTRACTED"),
        F.lit("N").alias("IS_ENCRYPTED"),
        F.when(F.col("m.SOURCECOLNM").isin("o_orderdate", "o_orderstatus"), F.lit("Y")).otherwise(F.lit("N")).alias("IS_PARTITIONED"),
        ((i * 5 + F.col("k")) % 6 + 1).cast("int").alias("SEQ_NB"),
    )
