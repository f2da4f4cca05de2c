"""Partitioned table writes, metrics, versions, compaction
and retention."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedwright.session import scratch_path


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str], truncate: str = "P",
                      fmt: str = "parquet", compression: str | None = None) -> None:
    """``Y`` overwrites the table, ``P`` replaces only the partitions
    present in ``df`` (dynamic overwrite), anything else appends.

    ``P`` without partition columns is refused: a dynamic overwrite of an
    unpartitioned table would replace all of it."""
    if (truncate or "").upper() == "P" and not partition_cols:
        raise ValueError("truncate P replaces partitions: name the partition columns")
    mode = {"Y": "overwrite", "P": "overwrite"}.get((truncate or "").upper(), "append")
    if partition_cols:
        # one writer per table partition instead of every task writing a file
        # into every partition; AQE splits a skewed (hot) partition value and
        # merges small ones (REBALANCE, unlike repartition, may be re-planned)
        df = df.hint("rebalance", *partition_cols)
    w = df.write.format(fmt).mode(mode).partitionBy(*partition_cols)
    w = w.option("partitionOverwriteMode", "dynamic" if (truncate or "").upper() == "P" else "static")
    if compression:
        w = w.option("compression", compression)
    w.save(path)


def observed(obs: Observation) -> dict:
    """What a write has observed; nothing when the plan was empty (the optimiser
    then removes the observation with the rest of the plan)."""
    from py4j.protocol import Py4JJavaError
    try:
        return obs.get
    except Py4JJavaError:
        return {}


def write_metrics(df: DataFrame, path: str, process_dt=None) -> None:
    """L3: idempotent daily metrics — the rows of each ``process_dt`` present in
    ``df`` replace that day's partition, other days stay. With ``process_dt``
    given, a rerun without rows for that day clears the day; the day's rows are counted on the write itself."""
    import uuid

    from feedwright.sources import storage
    seen = Observation(f"metrics-{uuid.uuid4().hex}")
    day = F.count_if(F.col("process_dt").cast("date") == F.lit(process_dt).cast("date"))
    write_partitioned(df.observe(seen, day.alias("n")) if process_dt is not None else df, path, ["process_dt"], truncate="P")
    if process_dt is not None and not observed(seen).get("n"):
        storage.delete(df.sparkSession, f"{path.rstrip('/')}/process_dt={process_dt}")


def parse_bucketing_clause(clause: str) -> tuple[list[str], int] | None:
    """``CLUSTERED BY (A, B) [SORTED BY (...)] INTO n BUCKETS`` -> (columns, n);
    an empty clause means no bucketing."""
    import re
    if not clause or not clause.strip():
        return None
    m = re.search(r"CLUSTERED\s+BY\s*\(([^)]*)\).*?INTO\s+(\d+)\s+BUCKETS", clause, re.I | re.S)
    if not m:
        raise ValueError(f"unreadable bucketing clause {clause!r}")
    return [c.strip().lower() for c in m.group(1).split(",") if c.strip()], int(m.group(2))


def write_bucketed_table(spark: SparkSession, df: DataFrame, table: str, buckets: int, cols: list[str],
                         partition_cols: list[str] | None = None, fmt: str = "parquet",
                         path: str | None = None) -> None:
    """L2 with the metadata's bucketing clause: a catalog table bucketed (and
    sorted) by the join key, so later joins on it skip the shuffle."""
    # one task per bucket writes one file per bucket (and partition), not tasks x buckets files
    df = df.repartition(buckets, *cols)
    w = df.write.format(fmt).mode("overwrite").bucketBy(buckets, *cols).sortBy(*cols)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


class VersionedTable:
    """L5 persistence: a small state table at a user-given path, one folder per version.

    ``save`` writes a new version beside the one being read, and ``_SUCCESS`` (written by the
    commit) makes it the current one; a failed write leaves the old version
    current, and the next save takes the number after it. Numbers are claimed by exclusive creation, so no two
    writers fill one folder; as each writes a whole state, the later one wins (``EventLog`` keeps the rows of both).
    The last ``keep`` versions stay.
    """

    def __init__(self, spark: SparkSession, path: str, schema, keep: int = 3):
        self.spark, self.path, self.schema, self.keep = spark, path.rstrip("/"), schema, keep

    def versions(self) -> list[int]:
        from feedwright.sources import storage
        found = [int(n[1:]) for n in storage.names(self.spark, self.path) if n[:1] == "v" and n[1:].isdigit()]
        return sorted(v for v in found if storage.exists(self.spark, f"{self.path}/v{v}/_SUCCESS"))

    def read(self) -> DataFrame:
        done = self.versions()
        if not done:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v{done[-1]}")

    def save(self, df: DataFrame) -> int:
        from feedwright.sources import storage
        done = self.versions()
        # folders of failed writes count too: their number isn't given again
        new = max([int(n[1:]) for n in storage.names(self.spark, self.path) if n[:1] == "v" and n[1:].isdigit()], default=0) + 1
        while not storage.create_new(self.spark, f"{self.path}/_claims/v{new}", ""):
            new += 1
        df.write.mode("errorifexists").parquet(f"{self.path}/v{new}")
        for v in done[:-(self.keep - 1)] if self.keep > 1 else done:
            storage.delete(self.spark, f"{self.path}/v{v}")
        return new


def new_version(spark: SparkSession, df: DataFrame, name: str) -> str:
    """A one-off version folder below the shared checkpoint root; see ``VersionedTable`` for durable state."""
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return path


def compact(spark: SparkSession, src_path: str, dst_path: str, files: int, compression: str = "zstd",
            fmt: str = "parquet") -> DataFrame:
    """Rewrite a raw partition into ``files`` compressed files (narrow
    ``coalesce``: no shuffle) at a new path, and return the new data. Choose
    ``files`` from the partition's bytes (for example bytes / 256 MB), never a
    constant: each output file is one task."""
    spark.read.format(fmt).load(src_path).coalesce(files).write.mode("errorifexists") \
        .option("compression", compression).format(fmt).save(dst_path)
    return spark.read.format(fmt).load(dst_path)


def retention_candidates(partitions: DataFrame, col: str, run_date: _dt.date, retention_days: int) -> DataFrame:
    """L8 selection: partitions older than ``run_date - retention``. Empty or 0
    retention keeps everything; -1 also selects the day just loaded (R12)."""
    if retention_days is None or retention_days == 0:
        return partitions.select(col).limit(0)
    cutoff = F.date_sub(F.lit(run_date), F.lit(int(retention_days)))
    c = F.col(col)
    text = c.cast("string")
    # a partition value that is no date is never a candidate
    day = F.coalesce(F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date"), text.try_cast("date")) \
        if dict(partitions.dtypes)[col] not in ("date", "timestamp", "timestamp_ntz") else c.cast("date")
    return partitions.select(col).distinct().where(day < cutoff)


def purge_partitions(spark: SparkSession, table: str, col: str, candidates: DataFrame) -> int:
    """L8 drop on a catalog table: one ``DROP PARTITION`` per expired partition
    (partition values are catalog metadata, not data)."""
    values = [r[0] for r in candidates.collect()]
    for v in values:
        lit = f"'{v}'" if isinstance(v, (str, _dt.date)) else str(v)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({col} = {lit})")
    return len(values)
