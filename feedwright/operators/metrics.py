"""Catalog sizes and file sizes.

The reference asks the database catalog (relation, namespace and partition
lists) for sizes; here the catalog is a set of DataFrames and file sizes come
from Spark's own file listing (``binaryFile`` without content, or the
``_metadata`` column of a scan), so the work is distributed over files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedwright.functions.exprs import isin_ci, percent, size_pretty


def relations_with_parent(relations: DataFrame, namespaces: DataFrame, partitions: DataFrame) -> DataFrame:
    """Relations of known namespaces, with a partition's parent table
    and schema taken from the partition list (unpartitioned tables keep their own)."""
    r = relations.join(namespaces, "nspname")
    p = partitions.select(F.col("partitiontablename").alias("relname"), F.col("partitionschemaname").alias("nspname"),
                          F.col("tablename").alias("parent_table"), F.col("schemaname").alias("parent_schema"))
    j = r.join(p, ["relname", "nspname"], "left")
    return j.select(F.coalesce("parent_schema", "nspname").alias("schema_name"),
                    F.coalesce("parent_table", "relname").alias("table_name"),
                    "relname", "size_bytes", "reltuples")


def table_sizes(rel_parent: DataFrame, schemas, ordered: bool = True) -> DataFrame:
    """Size, partition count and row count per table of the listed
    schemas (case-insensitive; unpartitioned tables kept, R14), largest first
    (the sort runs on the per-table aggregate, one row per table)."""
    t = rel_parent.where(isin_ci(F.col("schema_name"), schemas))
    g = t.groupBy("schema_name", "table_name").agg(
        F.sum("size_bytes").alias("size_bytes"), F.count(F.lit(1)).alias("n_partitions"),
        F.sum("reltuples").alias("n_rows"))
    out = g.select("schema_name", "table_name", "size_bytes", size_pretty("size_bytes").alias("size_pretty"),
                   "n_partitions", "n_rows")
    return out.orderBy(F.desc("size_bytes"), "schema_name", "table_name") if ordered else out


def schema_share(relations: DataFrame, schemas) -> DataFrame:
    """Size per schema and its share of the database total.

    One aggregate per schema; the database total is a window over that
    aggregate (one row per schema, a handful of rows), not a second scan and
    not a cross join."""
    per = relations.groupBy("nspname").agg(F.sum("size_bytes").alias("size_bytes"))
    total = F.sum("size_bytes").over(Window.partitionBy())
    w = per.select("nspname", "size_bytes", total.alias("db_bytes"))
    return (w.where(isin_ci(F.col("nspname"), schemas))
            .select(F.col("nspname").alias("schema_name"), "size_bytes",
                    size_pretty("size_bytes").alias("size_pretty"),
                    percent(F.col("size_bytes"), F.col("db_bytes")).alias("share_pct")))


def file_listing(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """All files below ``path`` with their sizes; the content is not read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select("path", "length", "modificationTime")


def database_size(files: DataFrame) -> DataFrame:
    """Total bytes over distinct files."""
    return files.select("path", "length").distinct().agg(F.sum("length").alias("size_bytes"),
                                                         F.count(F.lit(1)).alias("n_files"))


def table_files(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """``(table_name, path, length)``: the listings of several table paths as one frame."""
    from functools import reduce
    return reduce(DataFrame.unionByName, [file_listing(spark, path).select(F.lit(name).alias("table_name"), "path", "length")
                                          for name, path in tables.items()])


def total_and_external(spark: SparkSession, tables: dict[str, str], files: DataFrame | None = None) -> DataFrame:
    """E9 (re-aimed): per table path all bytes (hidden files included), the bytes of
    its data files and the bytes outside them (checksums, markers, metadata), largest first.

    Spark's own listing hides ``_`` and ``.`` files, so the totals come from
    the file system: one content summary per table. The data files are one job over all tables' listings (``files``, if
    they are listed already)."""
    from feedwright.sources import storage
    if not tables:
        return spark.createDataFrame([], "table_name string, total_bytes long, data_bytes long, external_bytes long")
    listed = files if files is not None else table_files(spark, tables)
    data = {r["table_name"]: int(r["n"]) for r in listed.groupBy("table_name").agg(F.sum("length").cast("long").alias("n")).collect()}
    rows = [(name, total, data.get(name, 0), total - data.get(name, 0))
            for name, path in tables.items() for total in [storage.total_bytes(spark, path)]]
    out = spark.createDataFrame(rows, "table_name string, total_bytes long, data_bytes long, external_bytes long")
    return out.orderBy(F.desc("total_bytes"), "table_name")


def path_bytes(spark: SparkSession, path: str, replicas: int = 3, partitions: list[str] | None = None) -> tuple[int, int]:
    """Bytes below a table path, or below the named partition folders only (nothing
    else is listed), and bytes x replicas."""
    from feedwright.sources import storage
    root = path.rstrip("/")
    size = sum(storage.total_bytes(spark, f"{root}/{p}") for p in partitions) if partitions is not None \
        else storage.total_bytes(spark, root)
    return size, size * replicas


def metric_rows(schema_sizes: DataFrame, tables: DataFrame, process_dt) -> DataFrame:
    """L3/M6: the metrics table rows (F8 layout plus typed columns)."""
    d = F.lit(process_dt).cast("date")
    s = schema_sizes.select(
        F.lit("SCHEMA_SIZE").alias("query_info"), d.alias("process_dt"), F.lit("SCHEMA").alias("entity_type"),
        F.col("schema_name").alias("container_name"), F.col("schema_name").alias("entity_name"),
        F.col("size_pretty").alias("size1"), F.format_string("%.2f", F.col("share_pct")).alias("size2"),
        "size_bytes", "share_pct", F.lit(None).cast("long").alias("n_partitions"),
        F.lit(None).cast("long").alias("n_rows"))
    t = tables.select(
        F.lit("TABLE_SIZE_AND_PARTITIONS").alias("query_info"), d.alias("process_dt"), F.lit("TABLE").alias("entity_type"),
        F.col("schema_name").alias("container_name"), F.col("table_name").alias("entity_name"),
        F.col("size_pretty").alias("size1"), F.col("n_partitions").cast("string").alias("size2"),
        "size_bytes", F.lit(None).cast("double").alias("share_pct"), "n_partitions", "n_rows")
    return s.unionByName(t)


def storage_rows(database: DataFrame, external: DataFrame, process_dt, name: str = "DATABASE") -> DataFrame:
    """M6: the database size and the per-table size with its external part as metric rows."""
    d = F.lit(process_dt).cast("date")
    none = lambda t: F.lit(None).cast(t)
    db = database.select(
        F.lit("DATABASE_SIZE").alias("query_info"), d.alias("process_dt"), F.lit("DATABASE").alias("entity_type"),
        F.lit(name).alias("container_name"), F.lit(name).alias("entity_name"),
        size_pretty("size_bytes").alias("size1"), F.col("n_files").cast("string").alias("size2"),
        "size_bytes", none("double").alias("share_pct"), none("long").alias("n_partitions"), none("long").alias("n_rows"))
    ext = external.select(
        F.lit("TABLE_TOTAL_AND_EXTERNAL").alias("query_info"), d.alias("process_dt"), F.lit("TABLE").alias("entity_type"),
        F.lit(name).alias("container_name"), F.col("table_name").alias("entity_name"),
        size_pretty("total_bytes").alias("size1"), size_pretty("external_bytes").alias("size2"),
        F.col("total_bytes").alias("size_bytes"), none("double").alias("share_pct"), none("long").alias("n_partitions"),
        none("long").alias("n_rows"))
    return db.unionByName(ext)
