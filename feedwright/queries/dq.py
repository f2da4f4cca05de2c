"""DQ plan, blank sub-groups and the source/target reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedwright.functions.exprs import not_blank
from feedwright.operators.metadata import dq_plan as _dq_plan
from feedwright.plans.reconcile import dq_reconcile as _dq_reconcile
from feedwright.plans.reconcile import reconcile_scripts
from feedwright.queries import register
from feedwright.sources import derive
from feedwright.sources.tables import read_table

_F6 = """
WITH grp AS (SELECT r_name AS group_nm, CASE WHEN r_regionkey % 4 = 3 THEN 0 ELSE 1 END AS dq_chk_flg FROM region),
xref AS (
  SELECT r.r_name AS group_nm,
         CASE WHEN s.s_suppkey % 10 = 7 THEN NULL WHEN s.s_suppkey % 10 = 8 THEN ''
              ELSE 'SG_' || CAST(s.s_suppkey % 50 AS VARCHAR) END AS sub_group_nm,
         lower(s.s_name) || '.dat' AS filename,
         'N' || CAST(s.s_nationkey AS VARCHAR) AS sourceschema, upper(s.s_name) AS sourcetblnm
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
tbl AS (
  SELECT 'N' || CAST(s_nationkey AS VARCHAR) AS sourceschema, upper(s_name) AS sourcetblnm,
         CASE s_suppkey % 4 WHEN 0 THEN 'HIVE' WHEN 1 THEN 'TERADATA' WHEN 2 THEN 'ORACLE' ELSE 'JOBSTAT' END AS db_type,
         'srv' || CAST(s_nationkey AS VARCHAR) AS db_server, 'u' || CAST(s_suppkey % 3 AS VARCHAR) AS db_user
  FROM supplier WHERE s_suppkey % 13 <> 0),
mdq AS (
  SELECT DISTINCT 'SG_' || CAST(g AS VARCHAR) AS sub_group_nm, 'src_' || CAST(g AS VARCHAR) || '.sql' AS src_qry_scr,
         'tgt_' || CAST(g AS VARCHAR) || '.sql' AS tgt_qry_scr
  FROM (SELECT s_suppkey % 50 AS g FROM supplier) WHERE g % 7 <> 6)
"""


def _f6(spark, sf_dir):
    return derive.dq_metadata(read_table(spark, sf_dir, "region"), read_table(spark, sf_dir, "nation"),
                              read_table(spark, sf_dir, "supplier"))


@register("dq_plan", _F6 + """
SELECT x.group_nm, x.sub_group_nm, x.filename, m.src_qry_scr, m.tgt_qry_scr, t.db_type, t.db_server, t.db_user
FROM xref x JOIN grp g ON x.group_nm = g.group_nm JOIN mdq m ON m.sub_group_nm = x.sub_group_nm
     JOIN tbl t ON t.sourceschema = x.sourceschema AND t.sourcetblnm = x.sourcetblnm
WHERE g.dq_chk_flg = 1 AND x.sub_group_nm IS NOT NULL AND x.sub_group_nm <> ''""")
def dq_plan(spark, sf_dir):
    f6 = _f6(spark, sf_dir)
    return _dq_plan(f6["metadata_dq"], f6["grouping"], f6["entity_group_xref"], f6["table_metadata"])


@register("dq_not_empty_groups", _F6 + """
SELECT group_nm, sub_group_nm, filename, sourceschema, sourcetblnm FROM xref
WHERE sub_group_nm IS NOT NULL AND sub_group_nm <> ''""")
def dq_not_empty_groups(spark, sf_dir):
    x = _f6(spark, sf_dir)["entity_group_xref"]
    return x.where(not_blank(F.col("sub_group_nm")))


# The DQ script of both sides: statistics per return flag; the table is a bound
# identifier parameter (C11).
DQ_STATS_SQL = """
SELECT l_returnflag AS sub_group, count(*) AS row_count, sum(l_quantity) AS sum_qty,
       sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS sum_price_cents,
       CAST(1152921504606846976 AS DECIMAL(38,0)) + count(*) AS large_sum, max(l_linestatus) AS last_status
FROM IDENTIFIER(<<TABLE>>)
GROUP BY l_returnflag"""

_DQ_DUCK = """
SELECT l_returnflag AS sub_group, count(*) AS row_count, sum(l_quantity) AS sum_qty,
       sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS sum_price_cents,
       CAST(1152921504606846976 AS HUGEINT) + count(*) AS large_sum
FROM ({src}) t GROUP BY l_returnflag"""


_STATS = ("row_count", "sum_qty", "sum_price_cents", "large_sum")


def _tall(q: str) -> str:
    # exact: integers as they are, the quantity (a double) to ten places
    return " UNION ALL ".join(f"SELECT sub_group, '{c}' AS stat, CAST({c} AS DECIMAL(38,10)) AS value FROM ({q})" for c in _STATS)


def _last(src: str) -> str:
    return f"SELECT l_returnflag AS sub_group, max(l_linestatus) AS text FROM ({src}) GROUP BY l_returnflag"


@register("dq_reconcile", f"""
WITH s AS ({_tall(_DQ_DUCK.format(src="SELECT * FROM lineitem"))}),
     t AS ({_tall(_DQ_DUCK.format(src="SELECT * FROM lineitem WHERE l_linenumber <> 7"))}),
     sx AS ({_last("SELECT * FROM lineitem")}), tx AS ({_last("SELECT * FROM lineitem WHERE l_linenumber <> 7")})
SELECT coalesce(s.sub_group, t.sub_group) AS sub_group, coalesce(s.stat, t.stat) AS stat,
       CAST(s.value AS DOUBLE) AS src_value, CAST(t.value AS DOUBLE) AS tgt_value, CAST(t.value - s.value AS DOUBLE) AS diff,
       CASE WHEN s.value IS NULL THEN 'MISSING_SOURCE' WHEN t.value IS NULL THEN 'MISSING_TARGET'
            WHEN t.value = s.value THEN 'MATCH' ELSE 'MISMATCH' END AS dq_status
FROM s FULL OUTER JOIN t ON s.sub_group = t.sub_group AND s.stat = t.stat
UNION ALL
SELECT coalesce(sx.sub_group, tx.sub_group), 'last_status', NULL, NULL, NULL,
       CASE WHEN sx.text IS NULL THEN 'MISSING_SOURCE' WHEN tx.text IS NULL THEN 'MISSING_TARGET'
            WHEN sx.text = tx.text THEN 'MATCH' ELSE 'MISMATCH' END
FROM sx FULL OUTER JOIN tx ON sx.sub_group = tx.sub_group""")
def dq_reconcile(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    views = {"fw_dq_source": li, "fw_dq_target": li.where(F.col("l_linenumber") != 7)}
    found = _dq_reconcile(
        spark,
        {"db_type": "HIVE", "query": DQ_STATS_SQL, "params": {"TABLE": "fw_dq_source"}, "views": views},
        {"db_type": "HIVE", "query": DQ_STATS_SQL, "params": {"TABLE": "fw_dq_target"}, "views": views})
    # compared exactly; shown as doubles
    return found.select("sub_group", "stat", *[F.col(c).cast("double").alias(c) for c in ("src_value", "tgt_value", "diff")], "dq_status")


_SG_DUCK = """SELECT 'SG_' || CAST(l_suppkey % 50 AS VARCHAR) AS g, count(*) AS row_count, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS cents
FROM lineitem {0} GROUP BY ALL"""

SUB_GROUP_SQL = """
SELECT count(*) AS row_count, coalesce(sum(CAST(round(l_extendedprice * 100) AS BIGINT)), 0) AS cents
FROM IDENTIFIER(<<TABLE>>) WHERE concat('SG_', l_suppkey % 50) = '<<SUB_GROUP>>'"""


@register("dq_subgroups", f"""
WITH p AS (SELECT DISTINCT 'SG_' || CAST(s_suppkey % 50 AS VARCHAR) AS sub_group FROM supplier),
s AS ({_SG_DUCK.format("")}), t AS ({_SG_DUCK.format("WHERE l_linenumber <> 7 OR l_suppkey % 3 = 0")}),
j AS (SELECT sub_group, coalesce(s.row_count, 0) AS sn, coalesce(t.row_count, 0) AS tn, coalesce(s.cents, 0) AS sc, coalesce(t.cents, 0) AS tc
      FROM p LEFT JOIN s ON s.g = sub_group LEFT JOIN t ON t.g = sub_group)
SELECT sub_group, 'row_count' AS stat, CAST(sn AS DOUBLE) AS src_value, CAST(tn AS DOUBLE) AS tgt_value, CAST(tn - sn AS DOUBLE) AS diff,
       CASE WHEN sn = tn THEN 'MATCH' ELSE 'MISMATCH' END AS dq_status FROM j
UNION ALL SELECT sub_group, 'cents', sc, tc, tc - sc, CASE WHEN sc = tc THEN 'MATCH' ELSE 'MISMATCH' END FROM j""")
def dq_subgroups(spark, sf_dir):
    """M4 with a script per sub-group (as many as suppliers give, 50 at most): each side is one scan."""
    li = read_table(spark, sf_dir, "lineitem")
    plan = read_table(spark, sf_dir, "supplier").select(F.concat(F.lit("SG_"), (F.col("s_suppkey") % 50).cast("string")).alias("sub_group_nm")).distinct().select(
        "sub_group_nm", F.lit("src.sql").alias("src_qry_scr"), F.lit("tgt.sql").alias("tgt_qry_scr"), F.lit("HIVE").alias("db_type"),
        F.lit("srv").alias("db_server"), F.lit("u").alias("db_user"))
    scripts = {"src.sql": SUB_GROUP_SQL.replace("<<TABLE>>", "'fw_sg_source'"), "tgt.sql": SUB_GROUP_SQL.replace("<<TABLE>>", "'fw_sg_target'")}
    found = reconcile_scripts(spark, plan, scripts.get, views={
        "fw_sg_source": li, "fw_sg_target": li.where("l_linenumber <> 7 OR l_suppkey % 3 = 0")})
    return found.select("sub_group", "stat", *[F.col(c).cast("double").alias(c) for c in ("src_value", "tgt_value", "diff")], "dq_status")
