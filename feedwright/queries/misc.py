"""Metadata normalisation, column order, key lower-casing, retention
candidates, end-to-end ingest and post-processing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from feedwright.functions.keys import lower_keys
from feedwright.operators import metadata as md
from feedwright.plans.ingest import FeedSpec, ingest
from feedwright.queries import register
from feedwright.session import scratch_path
from feedwright.sinks.tables import retention_candidates as _retention_candidates
from feedwright.sources import derive
from feedwright.sources.tables import read_table

_F1_RAW = """
f1 AS (
  SELECT CASE WHEN c_custkey % 2 = 0 THEN 'crm' ELSE 'CRM' END AS SOURCESCHEMA, c_name AS SOURCETBLNM,
         'daily' AS REFRESHRATE, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'o_orderdate' END AS DELTACOLUMN,
         'date' AS DELTACOLUMNTYPE, 'yyyymmdd' AS DELTACOLUMNFMT,
         CASE c_custkey % 4 WHEN 0 THEN 'hive' WHEN 1 THEN 'teradata' WHEN 2 THEN 'oracle-sqoop' ELSE 'file' END AS DB_TYPE,
         'srv' || CAST(c_nationkey AS VARCHAR) AS DB_SERVER, lower(c_mktsegment) AS DB_USER,
         '/landing/' || lower(c_mktsegment) || CASE WHEN c_custkey % 2 = 0 THEN '/' ELSE '' END AS EXTRACTLANDINGDIR,
         '/Data/' || c_mktsegment AS HDFS_BASEDIR, '  Extract/' || CAST(c_nationkey AS VARCHAR) || ' ' AS HDFSEXTRACTDIR,
         CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE '|' END AS DELIMITER, '' AS BUCKETINGCLAUSE,
         'stage' AS TGT_STG_DB, 'dm' AS TGT_DB,
         CASE c_custkey % 3 WHEN 0 THEN 'p' WHEN 1 THEN 'y' ELSE 'n' END AS HIVE_TBL_TRUNCATE,
         lower(replace(c_name, '#', '_')) AS TRGTTBLNM, ' /Raw/' || CAST(c_nationkey AS VARCHAR) AS HIVE_RAW_DIR,
         '/Refined/' || CAST(c_nationkey AS VARCHAR) || ' ' AS HIVE_REFINED_DIR,
         CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'n' END AS REFRESH_REFINED_DDL_DML, 'n' AS V1SUPPORT,
         CASE WHEN c_custkey % 9 = 0 THEN 'select * from Orders where o_custkey = <<CUST>>' ELSE '' END AS SOURCE_SQL_TXT,
         CASE WHEN c_custkey % 6 = 0 THEN 'o_orderkey' END AS SPLIT_BY,
         CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE 'parquet' END AS RFND_FILE_FMT,
         CASE WHEN c_custkey % 4 = 1 THEN NULL ELSE CAST(c_custkey % 30 AS INTEGER) END AS HIVE_RAW_RETENTION,
         CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE 90 END AS HIVE_REFINED_RETENTION
  FROM customer)"""


@register("table_metadata_normalised", "WITH " + _F1_RAW + """
SELECT upper(SOURCESCHEMA) AS SOURCESCHEMA, upper(SOURCETBLNM) AS SOURCETBLNM, upper(REFRESHRATE) AS REFRESHRATE,
       upper(DELTACOLUMN) AS DELTACOLUMN, upper(DELTACOLUMNTYPE) AS DELTACOLUMNTYPE,
       upper(DELTACOLUMNFMT) AS DELTACOLUMNFMT, upper(DB_TYPE) AS DB_TYPE, upper(DB_SERVER) AS DB_SERVER,
       upper(DB_USER) AS DB_USER,
       CASE WHEN ends_with(EXTRACTLANDINGDIR, '/') THEN EXTRACTLANDINGDIR ELSE EXTRACTLANDINGDIR || '/' END
         AS EXTRACTLANDINGDIR,
       lower(HDFS_BASEDIR) AS HDFS_BASEDIR, lower(trim(HDFSEXTRACTDIR)) AS HDFSEXTRACTDIR,
       coalesce(DELIMITER, '') AS DELIMITER, upper(BUCKETINGCLAUSE) AS BUCKETINGCLAUSE,
       upper(TGT_STG_DB) AS TGT_STG_DB, upper(TGT_DB) AS TGT_DB, upper(HIVE_TBL_TRUNCATE) AS HIVE_TBL_TRUNCATE,
       upper(TRGTTBLNM) AS TRGTTBLNM, lower(trim(HIVE_RAW_DIR)) AS HIVE_RAW_DIR,
       lower(trim(HIVE_REFINED_DIR)) AS HIVE_REFINED_DIR,
       coalesce(nullif(upper(REFRESH_REFINED_DDL_DML), ''), 'Y') AS REFRESH_REFINED_DDL_DML,
       upper(V1SUPPORT) AS V1SUPPORT, coalesce(SOURCE_SQL_TXT, '') AS SOURCE_SQL_TXT,
       coalesce(SPLIT_BY, '') AS SPLIT_BY, coalesce(RFND_FILE_FMT, '') AS RFND_FILE_FMT,
       coalesce(HIVE_RAW_RETENTION, 0) AS HIVE_RAW_RETENTION, coalesce(HIVE_REFINED_RETENTION, 0) AS HIVE_REFINED_RETENTION
FROM f1""")
def table_metadata_normalised(spark, sf_dir):
    return md.normalise_table_metadata(derive.table_metadata_from_customers(read_table(spark, sf_dir, "customer")))


def _f2_duck() -> str:
    entries = ", ".join(
        f"{{'i': {i}, 'src': '{src}', 'raw': '{raw}', 'rf': '{rf}', 't': '{t}'}}"
        for i, (src, raw, rf, t) in enumerate(derive.ORDERS_COLUMN_META))
    return f"""
WITH e AS (SELECT c_custkey AS k, c_name, unnest([{entries}]) AS m FROM customer),
f2 AS (
  SELECT 'CRM' AS SOURCESCHEMA, c_name AS SOURCETBLNM, m.src AS SOURCECOLNM, m.raw AS RAW_COL_INHIVE,
         m.rf AS RFND_COL_INHIVE, m.t AS RFND_COL_TYPE_INHIVE, '' AS LENGTH,
         CASE WHEN (m.i + k) % 4 = 0 THEN 'N' ELSE 'Y' END AS IS_EXTRACTED, 'N' AS IS_ENCRYPTED,
         CASE WHEN m.src IN ('o_orderdate', 'o_orderstatus') THEN 'Y' ELSE 'N' END AS IS_PARTITIONED,
         CAST((m.i * 5 + k) % 6 + 1 AS INTEGER) AS SEQ_NB
  FROM e)
SELECT *, row_number() OVER (PARTITION BY SOURCESCHEMA, SOURCETBLNM ORDER BY SEQ_NB, SOURCECOLNM) AS col_position
FROM f2 WHERE IS_EXTRACTED = 'Y'"""


@register("column_metadata_ordered", _f2_duck())
def column_metadata_ordered(spark, sf_dir):
    return md.extracted_columns(derive.column_metadata_from_customers(read_table(spark, sf_dir, "customer")))


@register("key_lowercase", """
SELECT c_custkey, c_name, c_nationkey AS nation_key, c_mktsegment AS segment, 'SEG' AS first_tag_key,
       c_acctbal AS acctbal, CAST(c_nationkey AS DOUBLE) AS nation
FROM customer""")
def key_lowercase(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    nested = c.select(
        F.struct(F.col("c_custkey").alias("C_CUSTKEY"), F.col("c_name").alias("C_Name"),
                 F.struct(F.col("c_nationkey").alias("NATION_KEY"), F.col("c_mktsegment").alias("Segment"))
                 .alias("DETAILS"),
                 F.array(F.struct(F.lit("SEG").alias("KEY"), F.col("c_mktsegment").alias("VALUE"))).alias("TAGS"))
        .alias("RECORD"),
        F.create_map(F.lit("ACCTBAL"), F.col("c_acctbal"), F.lit("Nation"), F.col("c_nationkey").cast("double"))
        .alias("PROPS"))
    low = lower_keys(nested)
    return low.select(F.col("record.c_custkey").alias("c_custkey"), F.col("record.c_name").alias("c_name"),
                      F.col("record.details.nation_key").alias("nation_key"),
                      F.col("record.details.segment").alias("segment"),
                      F.try_element_at(F.col("record.tags"), F.lit(1)).getField("key").alias("first_tag_key"),
                      F.col("props")["acctbal"].alias("acctbal"), F.col("props")["nation"].alias("nation"))


@register("retention_candidates", """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS part_date FROM orders
WHERE CAST(o_orderdate AS DATE) < DATE '2001-08-01' - INTERVAL 365 DAY""")
def retention_candidates(spark, sf_dir):
    parts = read_table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("part_date"))
    return _retention_candidates(parts, "part_date", dt.date(2001, 8, 1), 365)


def orders_feed_meta() -> list[dict]:
    rows = []
    for i, (src, raw, rf, typ) in enumerate(derive.ORDERS_COLUMN_META):
        rows.append({"SOURCECOLNM": src, "RAW_COL_INHIVE": raw, "RFND_COL_INHIVE": rf, "RFND_COL_TYPE_INHIVE": typ,
                     "IS_EXTRACTED": "N" if src == "o_orderpriority" else "Y",
                     "IS_PARTITIONED": "Y" if src in ("o_orderdate", "o_orderstatus") else "N", "SEQ_NB": 6 - i})
    return rows


def _ingest_orders(spark, sf_dir, postprocess=None, publish=False):
    base = scratch_path(spark, "ingest-orders")
    spec = FeedSpec(feed="ORDERS", source=read_table(spark, sf_dir, "orders"), col_meta=orders_feed_meta(),
                    raw_path=f"{base}/raw/orders_raw", refined_path=f"{base}/refined/orders",
                    delta_col="o_orderdate", operator="between", truncate="P", raw_retention=400,
                    refined_retention=0, postprocess=postprocess,
                    publish_path=f"{base}/published" if publish else None)
    first = ingest(spark, spec, "19960301", "19960331", run_date="19960401", jobpid=1)
    again = ingest(spark, spec, "19960301", "19960331", run_date="19960401", jobpid=2,
                   jobstat=first["jobstat"])      # a rerun replaces the same partitions
    return spec, again


_INGEST_DUCK = """
SELECT CAST(o_orderdate AS DATE) AS order_date, o_totalprice AS total_price, o_orderstatus AS order_status,
       CAST(o_custkey AS INTEGER) AS cust_key, o_orderkey AS order_key,
       strftime(o_orderdate, '%Y%m%d') AS order_date_ptn, o_orderstatus AS order_status_ptn
FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1996-03-31'"""


@register("ingest_refined", _INGEST_DUCK)
def ingest_refined(spark, sf_dir):
    spec, res = _ingest_orders(spark, sf_dir)
    return spark.read.schema(res["refined_schema"]).parquet(spec.refined_path)


POSTPROCESS = "lower:order_status;drop:order_status_ptn;rename:total_price=amount;dedupe:order_key"


@register("postprocess", f"""
SELECT order_date, total_price AS amount, lower(order_status) AS order_status, cust_key, order_key, order_date_ptn
FROM ({_INGEST_DUCK})""")
def postprocess(spark, sf_dir):
    _spec, res = _ingest_orders(spark, sf_dir, POSTPROCESS, publish=True)
    return res["postprocessed"]


@register("dated_path_scan", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
WHERE strftime(o_orderdate, '%Y-%m') = '1997-03'""")
def dated_path_scan(spark, sf_dir):
    """A5: orders land in one folder per month; the feed's landing template
    picks the folder of the run date."""
    from feedwright.sources.scans import scan_dated_path
    root = scratch_path(spark, "landing")
    orders = read_table(spark, sf_dir, "orders")
    (orders.withColumn("month", F.date_format("o_orderdate", "yyyy-MM")).hint("rebalance", "month")
     .write.partitionBy("month").parquet(root))
    return scan_dated_path(spark, f"{root}/month=<<%Y-%m>>", "19970315")


@register("bucketed_refined", "SELECT * FROM orders")
def bucketed_refined(spark, sf_dir):
    """L2 with a bucketing clause from the table metadata: orders written as a
    table bucketed and sorted by the order key (in the shared folder), read back."""
    from feedwright.sinks.tables import parse_bucketing_clause, write_bucketed_table
    cols, n = parse_bucketing_clause("CLUSTERED BY (O_ORDERKEY) INTO 8 BUCKETS")
    name = "fw_orders_bucketed"
    write_bucketed_table(spark, read_table(spark, sf_dir, "orders"), name, n, cols,
                         path=scratch_path(spark, "bucketed"))
    return spark.table(name)
