"""Catalog size metrics (F8 derived from part) and file sizes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from feedwright.functions.exprs import isin_ci, size_pretty as _size_pretty
from feedwright.operators import metrics as m
from feedwright.queries import register
from feedwright.queries.duck import CATALOG, pretty_sql
from feedwright.session import scratch_path
from feedwright.plans.size_metrics import run_size_metrics
from feedwright.sinks.files import write_lines
from feedwright.sources import derive, storage
from feedwright.sources.tables import DRIVER_TABLES, read_table

_W = "WITH " + CATALOG


def _catalog(spark, sf_dir):
    return derive.catalog_from_part(read_table(spark, sf_dir, "part"))


def _rel_parent(spark, sf_dir):
    c = _catalog(spark, sf_dir)
    return m.relations_with_parent(c["relations"], c["namespaces"], c["partitions"])


@register("relations_with_parent", _W + "SELECT * FROM rp")
def relations_with_parent(spark, sf_dir):
    return _rel_parent(spark, sf_dir)


@register("table_sizes", _W + f"SELECT schema_name, table_name, size_bytes, {pretty_sql('size_bytes')} AS size_pretty, "
                              "n_partitions, n_rows FROM tsz")
def table_sizes(spark, sf_dir):
    return m.table_sizes(_rel_parent(spark, sf_dir), derive.METRIC_SCHEMAS)


@register("schema_share", _W + f"SELECT schema_name, size_bytes, {pretty_sql('size_bytes')} AS size_pretty, share_pct "
                               "FROM ssz")
def schema_share(spark, sf_dir):
    return m.schema_share(_catalog(spark, sf_dir)["relations"], derive.METRIC_SCHEMAS)


@register("size_pretty", _W + f"SELECT relname, size_bytes, {pretty_sql('size_bytes')} AS size_pretty FROM rel")
def size_pretty(spark, sf_dir):
    rel = _catalog(spark, sf_dir)["relations"]
    return rel.select("relname", "size_bytes", _size_pretty("size_bytes").alias("size_pretty"))


@register("schema_membership", _W + "SELECT relname, nspname FROM rel WHERE upper(nspname) IN ('DM', 'DOPS', 'STAGE', 'BAK')")
def schema_membership(spark, sf_dir):
    rel = _catalog(spark, sf_dir)["relations"]
    return rel.where(isin_ci(F.col("nspname"), derive.METRIC_SCHEMAS)).select("relname", "nspname")


_METRIC_DAY_SQL = """
SELECT 'SCHEMA_SIZE' AS query_info, DATE '{d}' AS process_dt, 'SCHEMA' AS entity_type, schema_name AS container_name,
       schema_name AS entity_name, {pretty_s} AS size1, printf('%.2f', share_pct) AS size2, size_bytes, share_pct,
       CAST(NULL AS BIGINT) AS n_partitions, CAST(NULL AS BIGINT) AS n_rows FROM ssz
UNION ALL
SELECT 'TABLE_SIZE_AND_PARTITIONS', DATE '{d}', 'TABLE', schema_name, table_name, {pretty_t},
       CAST(n_partitions AS VARCHAR), size_bytes, CAST(NULL AS DOUBLE), n_partitions, n_rows FROM tsz"""

METRIC_DAYS = (dt.date(2024, 1, 15), dt.date(2024, 1, 16))


@register("metrics_rerun", _W + "\nUNION ALL\n".join(
    _METRIC_DAY_SQL.format(d=d.isoformat(), pretty_s=pretty_sql("size_bytes"), pretty_t=pretty_sql("size_bytes"))
    for d in METRIC_DAYS))
def metrics_rerun(spark, sf_dir):
    c = _catalog(spark, sf_dir)
    path = scratch_path(spark, "metrics")
    # first day, the same day again (rerun replaces it), then the next day
    for d in (METRIC_DAYS[0], METRIC_DAYS[0], METRIC_DAYS[1]):
        run_size_metrics(c["relations"], c["namespaces"], c["partitions"], derive.METRIC_SCHEMAS, d, path)
    back = spark.read.parquet(path)
    return back.withColumn("process_dt", F.col("process_dt").cast("date"))


@register("file_sizes")
def file_sizes(spark, sf_dir):
    """E8 (rows only: the oracle cannot see the file paths): bytes and files per
    driver table — a file or a folder of part files — plus the database total over distinct files."""
    root = sf_dir.rstrip("/")
    files = None
    for t in DRIVER_TABLES:
        one = m.file_listing(spark, f"{root}/{t}.parquet").withColumn("table_name", F.lit(t))
        files = one if files is None else files.unionByName(one)
    per_table = files.groupBy("table_name").agg(F.sum("length").alias("size_bytes"),
                                                F.count(F.lit(1)).alias("n_files"))
    total = m.database_size(files).select(F.lit("DATABASE").alias("table_name"), "size_bytes", "n_files")
    return per_table.unionByName(total).withColumn("size_pretty", _size_pretty("size_bytes"))


@register("total_external_size")
def total_external_size(spark, sf_dir):
    """E9 (rows only): written copies of part and supplier, partitioned — per table the
    bytes in data files and the bytes in markers, checksums and metadata, largest first."""
    tables = {"part": ("part", "p_brand"), "supplier": ("supplier", "s_nationkey")}
    paths = {}
    for name, (table, by) in tables.items():
        paths[name] = scratch_path(spark, f"{name}-sizes")
        read_table(spark, sf_dir, table).write.partitionBy(by).parquet(paths[name])
    sizes = m.total_and_external(spark, paths)
    return sizes.select("*", _size_pretty("total_bytes").alias("size1"), _size_pretty("external_bytes").alias("size2"))


@register("metrics_rerun_empty", _W + _METRIC_DAY_SQL.format(
    d=METRIC_DAYS[1].isoformat(), pretty_s=pretty_sql("size_bytes"), pretty_t=pretty_sql("size_bytes")))
def metrics_rerun_empty(spark, sf_dir):
    """L3: a rerun of a day that now has no rows clears that day and leaves the others."""
    c = _catalog(spark, sf_dir)
    path = scratch_path(spark, "metrics-empty")
    for d in METRIC_DAYS:
        run_size_metrics(c["relations"], c["namespaces"], c["partitions"], derive.METRIC_SCHEMAS, d, path)
    nothing = c["relations"].where("size_bytes < 0")
    run_size_metrics(nothing, c["namespaces"], c["partitions"], derive.METRIC_SCHEMAS, METRIC_DAYS[0], path)
    return spark.read.parquet(path).withColumn("process_dt", F.col("process_dt").cast("date"))


# The lines of the written copies; a line is its bytes and one line feed, and a table has a 10-byte metadata file.
_COPIES = {"nation": ("n_name", "n_name"), "part": ("p_name || '|' || p_type", "concat(p_name, '|', p_type)")}
_BYTES = ", ".join(f"(SELECT sum(strlen({duck}) + 1) FROM {t}) AS {t}" for t, (duck, _) in _COPIES.items())
_NO = "CAST(NULL AS DOUBLE) AS share_pct, CAST(NULL AS BIGINT) AS n_partitions, CAST(NULL AS BIGINT) AS n_rows"


@register("metrics_all", _W + _METRIC_DAY_SQL.format(d=METRIC_DAYS[0].isoformat(), pretty_s=pretty_sql("size_bytes"), pretty_t=pretty_sql("size_bytes")) + f"""
UNION ALL BY NAME
SELECT 'DATABASE_SIZE' AS query_info, DATE '{METRIC_DAYS[0]}' AS process_dt, 'DATABASE' AS entity_type, 'DATABASE' AS container_name,
       'DATABASE' AS entity_name, {pretty_sql("size_bytes")} AS size1, '2' AS size2, size_bytes, {_NO}
FROM (SELECT CAST(nation + part AS BIGINT) AS size_bytes FROM (SELECT {_BYTES}))
UNION ALL BY NAME
SELECT 'TABLE_TOTAL_AND_EXTERNAL' AS query_info, DATE '{METRIC_DAYS[0]}' AS process_dt, 'TABLE' AS entity_type, 'DATABASE' AS container_name,
       t AS entity_name, {pretty_sql("size_bytes")} AS size1, '10 bytes' AS size2, size_bytes, {_NO}
FROM (SELECT t, CAST(n + 10 AS BIGINT) AS size_bytes FROM (SELECT {_BYTES}) UNPIVOT (n FOR t IN (nation, part)))""")
def metrics_all(spark, sf_dir):
    """All four size metrics in one run, the file metrics over written copies of known size: text files, with a metadata file
    of ten bytes beside the data of each table."""
    c = _catalog(spark, sf_dir)
    paths = {}
    for t, (_, line) in _COPIES.items():
        paths[t] = scratch_path(spark, f"sized-{t}")
        write_lines(read_table(spark, sf_dir, t).select(F.expr(line).alias("value")).coalesce(1), paths[t])
        storage.create_new(spark, f"{paths[t]}/_stats", "0123456789")
    out = scratch_path(spark, "metrics-all")
    run_size_metrics(c["relations"], c["namespaces"], c["partitions"], derive.METRIC_SCHEMAS, METRIC_DAYS[0], out, paths)
    return spark.read.parquet(out).withColumn("process_dt", F.col("process_dt").cast("date"))
