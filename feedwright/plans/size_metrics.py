"""M6: size metrics of a catalog for one process date, written idempotently."""

from __future__ import annotations

from pyspark.sql import DataFrame

from feedwright.operators import metrics as m
from feedwright.sinks.tables import write_metrics


def size_metric_rows(relations: DataFrame, namespaces: DataFrame, partitions: DataFrame, schemas,
                     process_dt) -> DataFrame:
    """Schema sizes with their share (E6) and table sizes with partition and
    row counts (E7), as metric rows for ``process_dt``."""
    tables = m.table_sizes(m.relations_with_parent(relations, namespaces, partitions), schemas, ordered=False)
    return m.metric_rows(m.schema_share(relations, schemas), tables, process_dt)


def storage_metric_rows(files: DataFrame, external: DataFrame, process_dt, database: str = "DATABASE") -> DataFrame:
    """The two metrics that come from files: the database size over its files (E8) and, per
    table, its total with the external part (E9), in the layout of ``size_metric_rows``."""
    return m.storage_rows(m.database_size(files), external, process_dt, database)


def run_size_metrics(relations: DataFrame, namespaces: DataFrame, partitions: DataFrame, schemas,
                     process_dt, path: str, table_paths: dict[str, str] | None = None) -> None:
    """Write the day's rows; a rerun on the same day replaces that day only (L3). With the
    paths of the tables, all four metrics are written."""
    rows = size_metric_rows(relations, namespaces, partitions, schemas, process_dt)
    if table_paths:
        spark = relations.sparkSession
        files = m.table_files(spark, table_paths)
        rows = rows.unionByName(storage_metric_rows(files, m.total_and_external(spark, table_paths, files), process_dt))
    write_metrics(rows, path, process_dt)
