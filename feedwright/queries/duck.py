"""DuckDB text fragments shared by the oracle queries (the driver registers the
parquet tables as views with the driver table names)."""

from __future__ import annotations

LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]

LINEITEM_RAW = """SELECT * REPLACE (CASE WHEN l_linenumber = 1 THEN NULL ELSE l_discount END AS l_discount,
                        CAST(NULL AS DOUBLE) AS l_tax) FROM lineitem"""
LINEITEM_REFINED = """SELECT * EXCLUDE (l_returnflag) REPLACE (
                        CASE WHEN l_linenumber IN (1, 2) THEN NULL ELSE l_discount END AS l_discount),
                        'r1' AS load_tag FROM ({raw}) r""".format(raw=LINEITEM_RAW)

ORDERS_NULLS = """SELECT * REPLACE (
    CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
    CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
    CASE WHEN o_orderkey % 5 = 0 AND o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END AS o_orderstatus)
  FROM orders"""

JOBSTAT_SELECT = """
  SELECT {feed} AS feed, event_id AS jobpid,
         lower(event_type) || '_' || strftime(ts, '%Y%m%d') || '.dat' AS filename,
         ts AS process_start,
         ts + to_minutes(CAST(event_id % 7 + 1 AS BIGINT)) AS process_end,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(floor(value * 100) AS BIGINT) END AS linecount,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(floor(value * 100) AS BIGINT) END
           - CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS rowcount,
         CAST(ts AS DATE) AS filedate,
         CASE event_id % 4 WHEN 0 THEN 'COMPLETED SUCCESSFULLY' WHEN 1 THEN 'EXTRACT_COMPLETED'
              WHEN 2 THEN 'Completed Execute source db script' ELSE 'GENERATE EXTRACT SCRIPT' END AS status,
         '' AS message,
         event_id * 10 AS raw_size, event_id * 30 AS raw_replica_size,
         event_id * 8 AS refined_size, event_id * 24 AS refined_replica_size,
         'filedate_ptn' AS partition_col,
         CAST(ts AS DATE) AS file_end_dt,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(floor(value * 100) AS BIGINT) END
           - CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS refined_count
  FROM {source}"""

JOBSTAT = JOBSTAT_SELECT.format(feed="upper(event_type)", source="events")

PLANNING_JOBSTAT = JOBSTAT_SELECT.format(
    feed="c_name",
    source="(SELECT e.*, c.c_name FROM events e JOIN customer c ON c.c_custkey = e.user_id "
           "WHERE e.ts < TIMESTAMP '2024-01-15 00:00:00') ev")


def profile_sql(source: str, columns: list[str]) -> str:
    """Oracle of ``null_profile``: one aggregate, then one row per column."""
    counts = ",\n".join(f"  count(*) - count({c}) AS c{i}" for i, c in enumerate(columns))
    rows = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, n AS n_rows, "
        f"CASE WHEN n = 0 THEN NULL ELSE CAST(100.0 AS DOUBLE) * CAST(c{i} AS DOUBLE) / CAST(n AS DOUBLE) END AS null_pct FROM a"
        for i, c in enumerate(columns))
    return f"WITH a AS (SELECT count(*) AS n,\n{counts}\nFROM ({source}) t)\n{rows}"


def compare_sql(left: str, right: str) -> str:
    """Oracle of ``compare_profiles`` over two profile queries."""
    return f"""
WITH l AS ({left}), r AS ({right})
SELECT coalesce(l.column_name, r.column_name) AS column_name,
       l.n_rows AS left_rows, r.n_rows AS right_rows, l.null_pct AS left_pct, r.null_pct AS right_pct,
       (l.column_name IS NOT NULL AND r.column_name IS NULL) AS added,
       (l.column_name IS NULL AND r.column_name IS NOT NULL) AS removed,
       coalesce(l.null_pct IS NOT NULL AND r.null_pct IS NOT NULL
                AND CAST(trunc(l.null_pct) AS INTEGER) <> CAST(trunc(r.null_pct) AS INTEGER)
                AND abs(l.null_pct - r.null_pct) > 1.0, false) AS null_defer,
       coalesce(l.null_pct IS NOT NULL AND r.null_pct IS NOT NULL
                AND CAST(trunc(l.null_pct) AS INTEGER) = 100, false) AS full_null_left,
       coalesce(l.null_pct IS NOT NULL AND r.null_pct IS NOT NULL
                AND CAST(trunc(r.null_pct) AS INTEGER) = 100, false) AS full_null_right
FROM l FULL OUTER JOIN r ON l.column_name = r.column_name"""


def pretty_sql(x: str) -> str:
    """Oracle of ``size_pretty`` (integer shifts, half-up per unit)."""
    b = f"CAST({x} AS BIGINT)"
    parts = [f"WHEN abs({b}) < 10240 THEN CAST({b} AS VARCHAR) || ' bytes'"]
    for unit, shift in (("kB", 9), ("MB", 19), ("GB", 29)):
        parts.append(f"WHEN abs({b} >> {shift}) < 20479 THEN CAST((({b} >> {shift}) + 1) >> 1 AS VARCHAR) || ' {unit}'")
    return "CASE " + " ".join(parts) + f" ELSE CAST((({b} >> 39) + 1) >> 1 AS VARCHAR) || ' TB' END"


CATALOG = """
rel AS (
  SELECT 't_' || CAST(p_partkey AS VARCHAR) AS relname,
         CASE p_partkey % 6 WHEN 0 THEN 'dm' WHEN 1 THEN 'Dops' WHEN 2 THEN 'STAGE' WHEN 3 THEN 'bak'
                            WHEN 4 THEN 'scratch' ELSE 'Archive' END AS nspname,
         CAST(round(p_retailprice * 100) AS BIGINT) << CAST(p_size % 28 AS BIGINT) AS size_bytes,
         CAST(p_size AS BIGINT) * 1000 + p_partkey % 97 AS reltuples,
         p_brand AS brand, p_partkey AS relid
  FROM part),
nsp AS (SELECT DISTINCT nspname FROM rel),
ptn AS (SELECT relname AS partitiontablename, nspname AS partitionschemaname,
               'p_' || lower(replace(brand, '#', '')) AS tablename, nspname AS schemaname
        FROM rel WHERE relid % 4 <> 0),
rp AS (
  SELECT coalesce(p.schemaname, r.nspname) AS schema_name, coalesce(p.tablename, r.relname) AS table_name,
         r.relname, r.size_bytes, r.reltuples
  FROM rel r JOIN nsp n ON r.nspname = n.nspname
       LEFT JOIN ptn p ON r.relname = p.partitiontablename AND r.nspname = p.partitionschemaname),
tsz AS (
  SELECT schema_name, table_name, CAST(sum(size_bytes) AS BIGINT) AS size_bytes, count(*) AS n_partitions,
         CAST(sum(reltuples) AS BIGINT) AS n_rows
  FROM rp WHERE upper(schema_name) IN ('DM', 'DOPS', 'STAGE', 'BAK') GROUP BY ALL),
per AS (SELECT nspname, CAST(sum(size_bytes) AS BIGINT) AS size_bytes FROM rel GROUP BY nspname),
ssz AS (
  SELECT nspname AS schema_name, size_bytes,
         CAST(100.0 AS DOUBLE) * CAST(size_bytes AS DOUBLE) / CAST((SELECT sum(size_bytes) FROM per) AS DOUBLE) AS share_pct
  FROM per WHERE upper(nspname) IN ('DM', 'DOPS', 'STAGE', 'BAK'))
"""
