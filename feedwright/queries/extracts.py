"""Extract semantics: raw / refined / delta scans, metadata projection, partition
twins, custom SQL, first-n columns and the refined-count fallback."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from feedwright.operators import metadata as md
from feedwright.operators.counts import refined_count_with_fallback, window_counts
from feedwright.queries import register
from feedwright.session import scratch_path
from feedwright.sources import derive, storage
from feedwright.sources.scans import scan_delta, scan_raw, scan_refined, scan_sql
from feedwright.sources.tables import read_table

_O = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@register("scan_raw_by_loaddate",
          f"SELECT {_O} FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1997-03-15'")
def scan_raw_by_loaddate(spark, sf_dir):
    return scan_raw(read_table(spark, sf_dir, "orders"), "19970315", load_col="o_orderdate")


@register("scan_refined_between",
          f"SELECT {_O} FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-03-31'")
def scan_refined_between(spark, sf_dir):
    return scan_refined(read_table(spark, sf_dir, "orders"), "o_orderdate", "19960101", "19960331")


_DELTA_OPS = {"gt": ">", "ge": ">=", "lt": "<", "le": "<=", "eq": "=", "ne": "<>"}


def _delta_query(op):
    def q(spark, sf_dir):
        return scan_delta(read_table(spark, sf_dir, "orders"), "o_orderdate", op, "19990101",
                          col_type="DATE", col_fmt="yyyyMMdd")
    return q


for _suffix, _op in _DELTA_OPS.items():
    register(f"delta_extract_{_suffix}",
             f"SELECT {_O} FROM orders WHERE CAST(o_orderdate AS DATE) {_op} DATE '1999-01-01'")(_delta_query(_op))


@register("delta_extract_range",
          "SELECT * FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-03-31'")
def delta_extract_range(spark, sf_dir):
    return scan_delta(read_table(spark, sf_dir, "lineitem"), "l_shipdate", "between", "19960101", "19960331",
                      col_type="DATE")


def _orders_spec():
    # o_orderpriority is not extracted; SEQ_NB runs against the physical order.
    rows = []
    for i, (src, raw, rf, typ) in enumerate(derive.ORDERS_COLUMN_META):
        rows.append({"SOURCECOLNM": src, "RAW_COL_INHIVE": raw, "RFND_COL_INHIVE": rf,
                     "RFND_COL_TYPE_INHIVE": typ, "IS_EXTRACTED": "N" if src == "o_orderpriority" else "Y",
                     "IS_PARTITIONED": "Y" if src in ("o_orderdate", "o_orderstatus") else "N",
                     "SEQ_NB": 6 - i})
    return md.projection_spec(rows)


@register("projected_refined", """
SELECT TRY_CAST(o_orderdate AS DATE) AS order_date, TRY_CAST(o_totalprice AS DOUBLE) AS total_price,
       TRY_CAST(o_orderstatus AS VARCHAR) AS order_status, TRY_CAST(o_custkey AS INTEGER) AS cust_key,
       TRY_CAST(o_orderkey AS BIGINT) AS order_key
FROM orders""")
def projected_refined(spark, sf_dir):
    return md.project(read_table(spark, sf_dir, "orders"), _orders_spec())


@register("partition_twins", """
SELECT CAST(o_orderdate AS DATE) AS order_date, o_totalprice AS total_price, o_orderstatus AS order_status,
       CAST(o_custkey AS INTEGER) AS cust_key, o_orderkey AS order_key,
       strftime(o_orderdate, '%Y%m%d') AS order_date_ptn, o_orderstatus AS order_status_ptn,
       'order_date_ptn,order_status_ptn' AS partition_col, 'order_date_ptn' AS dq_partition_col
FROM orders""")
def partition_twins(spark, sf_dir):
    spec = _orders_spec()
    projected = md.project(read_table(spark, sf_dir, "orders"), spec)
    ptn = [r["RFND_COL_INHIVE"].lower() for r in spec if r["IS_PARTITIONED"] == "Y"]
    ptn.sort(key=lambda c: 0 if c == "order_date" else 1)
    out, ptn_list, dq_col = md.add_partition_twins(projected, ptn)
    return out.withColumn("partition_col", F.lit(ptn_list)).withColumn("dq_partition_col", F.lit(dq_col))


@register("refined_count_fallback", """
WITH rcv AS (SELECT o_orderstatus AS feed, CAST(date_trunc('month', o_orderdate) AS DATE) AS window_start,
                    count(*) AS received_count FROM orders GROUP BY ALL),
     ref AS (SELECT o_orderstatus AS feed, CAST(date_trunc('month', o_orderdate) AS DATE) AS window_start,
                    count(*) AS refined_count FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL)
SELECT rcv.feed, rcv.window_start, received_count, coalesce(refined_count, 0) AS refined_count,
       CASE WHEN coalesce(refined_count, 0) = 0 AND received_count <> 0 THEN received_count
            ELSE coalesce(refined_count, 0) END AS final_count,
       (coalesce(refined_count, 0) = 0 AND received_count <> 0) AS used_fallback
FROM rcv LEFT JOIN ref ON rcv.feed = ref.feed AND rcv.window_start = ref.window_start""")
def refined_count_fallback(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    win = lambda df: df.select(F.col("o_orderstatus").alias("feed"),
                               F.trunc(F.to_date("o_orderdate"), "month").alias("window_start"))
    received = window_counts(win(orders), ["feed", "window_start"], "received_count")
    refined_tbl = orders.where(F.col("o_orderstatus") != "P")   # the load that lost one feed
    refined = window_counts(win(refined_tbl), ["feed", "window_start"], "refined_count")
    return refined_count_with_fallback(received, refined, ["feed", "window_start"])


CUSTOM_SQL = """
SELECT c.c_mktsegment AS segment, count(*) AS n_orders, max(o.o_totalprice) AS max_price,
       min(o.o_orderdate) AS first_order
FROM orders_src o JOIN customer_src c ON o.o_custkey = c.c_custkey
WHERE o.o_orderdate BETWEEN to_timestamp_ntz(<<FROM_TS>>) AND to_timestamp_ntz(<<END_TS>>)
GROUP BY c.c_mktsegment"""


@register("custom_sql_extract", """
SELECT c.c_mktsegment AS segment, count(*) AS n_orders, max(o.o_totalprice) AS max_price,
       min(o.o_orderdate) AS first_order
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE o.o_orderdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1998-12-31 00:00:00'
GROUP BY c.c_mktsegment""")
def custom_sql_extract(spark, sf_dir):
    return scan_sql(spark, CUSTOM_SQL,
                    params={"FROM_TS": "1996-01-01 00:00:00", "END_TS": "1998-12-31 00:00:00"},
                    views={"orders_src": read_table(spark, sf_dir, "orders"),
                           "customer_src": read_table(spark, sf_dir, "customer")})


@register("first_n_columns", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem")
def first_n_columns(spark, sf_dir):
    return md.first_columns(read_table(spark, sf_dir, "lineitem"), 4)


# Markers bare, in quotes, inside a longer text, in a typed literal and in a quoted name.
MARKERS_SQL = """
SELECT o_orderkey, '<<TAG>>' AS tag, 'x_<<TAG>>_<<FROM_DT>>' AS label, <<TAG>> AS bare, <<N>> AS n -- '<<TAG>>' stays here
FROM `<<VIEW>>` WHERE o_orderdate >= DATE '<<FROM_DT>>' AND o_orderdate < <<END_DT>> AND '<<N>>' = '5' AND '<<OTHER>>' <> ''"""


@register("custom_sql_markers", " UNION ALL ".join(f"""
SELECT o_orderkey, 'it''s \\ "q"' AS tag, 'x_it''s \\ "q"_1996-03-01' AS label, 'it''s \\ "q"' AS bare, 5 AS n, '{way}' AS way FROM orders
WHERE o_orderdate >= DATE '1996-03-01' AND o_orderdate < DATE '1996-04-01'""" for way in ("inline", "file")))
def custom_sql_markers(spark, sf_dir):
    """A4/C11: ``<<KEY>>`` markers in every place a script can hold them, from a text and from a file."""
    path = scratch_path(spark, "marker-scripts") + "/script.sql"
    storage.create_new(spark, path, MARKERS_SQL)
    params = {"TAG": "it's \\ \"q\"", "N": 5, "VIEW": "fw_marker_orders", "FROM_DT": dt.date(1996, 3, 1), "END_DT": dt.date(1996, 4, 1)}
    views = {"fw_marker_orders": read_table(spark, sf_dir, "orders")}
    return (scan_sql(spark, MARKERS_SQL, params, views).withColumn("way", F.lit("inline"))
            .unionByName(scan_sql(spark, path, params, views).withColumn("way", F.lit("file"))))
